"""The operators against brute force, the libraries, and defined odd cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from energy_series.llm import (
    bpe,
    op1_fingerprints,
    op2_personal_data,
    op3_jaccard_join,
    op4_line_dedup,
    op5_toxicity,
    op6_token_counts,
    op7_decontamination,
    op8_token_files,
    op9_bpe,
    op10_licences,
    pfor,
    prefix_tree,
)

BYTES, WORDS = bpe.path("byte_bpe_50k.json"), bpe.path("word_bpe_49k.json")


@pytest.fixture
def docs(spark):
    """``docs([(doc_id, text), ...])`` with other columns whose names operators use themselves."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, words string, row string, key string"
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "w", "r", "k") for i, t in rows], schema)

    return make


PROSE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"


@pytest.fixture
def odd():
    """Nulls, empty and long texts, repeated rows, ties and odd characters."""
    return [
        (None, "no id here"), (0, None), (1, ""), (2, "  \n\t "), (3, PROSE), (3, PROSE), (4, PROSE.upper()),
        (5, PROSE + " more"), (6, "x" * 50_000), (7, "word " * 30_000), (8, "\x01\x02 é 漢字 🎉🎉 <|endoftext|> it's"), (9, "one"),
        (3, "another text of the same id"),
    ]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts_of(rows):
    return [t or "" for _, t in rows]


def shingle_set(text, size):
    words = re.findall(r"[^ \t-\r]+", text.translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_components(rows, size, num, den):
    sets = {i: shingle_set(t or "", size) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {(i, len(s), top(i)) for i, s in sets.items()}


def copies(seed, n=120):
    """Texts in families of near copies, some of them equal."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if i < 12 or rng.random() < 0.1:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 4, 9, 12, 60, 200]))
        else:
            words = list(rng.choice(rows)[1].split())
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "similarity"), [(3, (9, 10)), (5, (4, 5))])
def test_jaccard_join_equals_brute_force(docs, size, similarity):
    rows = copies(size)
    got = op3_jaccard_join.jaccard_components(docs(rows), size=size, similarity=similarity).collect()
    assert {tuple(r) for r in got} == brute_components(rows, size, *similarity)


def test_low_similarities_get_more_bands(docs):
    words = lambda i, side: [f"c{i}x{j}" for j in range(20)] + [f"{side}{i}x{j}" for j in range(10)]
    rows = [(2 * i + k, " ".join(words(i, "ab"[k]))) for i in range(150) for k in (0, 1)]
    got = op3_jaccard_join.jaccard_components(docs(rows), size=1, similarity=(1, 2)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i - i % 2) for i, _ in rows}
    assert op1_fingerprints.banded((1, 10), 32) is None


def test_jaccard_join_of_odd_rows(docs, odd):
    got = op3_jaccard_join.jaccard_components(docs(odd)).collect()
    assert len(got) == len(odd)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (0, 1, 2, 4, 5)} == {(0, 0), (1, 1), (2, 2), (4, 3), (5, 3)}
    kept = op3_jaccard_join.one_of_each(docs(odd))
    assert kept.columns == docs(odd).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 3, 3, 6, 7, 8, 9]
    assert op3_jaccard_join.jaccard_components(docs([])).count() == 0


def test_pipeline_keeps_one_row_of_each_group(spark, docs, odd):
    import corpus_pipeline

    other = " ".join(f"other{i}" for i in range(20))
    alone = " ".join(f"alone{i}" for i in range(20))
    rows = [*odd, (None, alone), (None, alone), (None, alone + " end"), (4, "a clean text that shares its id with a copy")]
    rows += [(50, other), (50, other), (50, other + " x"), (None, other)]
    # Two texts that link only through one without an id.
    chain = [f"c{i}" for i in range(24)]
    rows += [(60, " ".join(chain)), (None, " ".join([*chain, "d1", "d2", "d3"])), (61, " ".join([*chain, "d1", "d2", "d3", "d4", "d5", "d6"]))]
    got = corpus_pipeline.jaccard_stage(spark, docs(rows), "")
    assert got.columns == docs(rows).columns
    kept = sorted((str(r.doc_id), r.text or "") for r in got.collect())
    start = lambda t: t.split(" ")[0]
    families = {s: [i for i, t in kept if start(t) == s] for s in ("alpha", "ALPHA", "other0", "alone0", "c0")}
    assert families == {"alpha": ["3"], "ALPHA": [], "other0": ["50"], "alone0": ["None"], "c0": ["60"]}
    assert [r for r in kept if start(r[1]) not in families] == sorted((str(i), t or "") for i, t in rows if start(t or "") not in families)


def test_blocks_of_a_large_cluster_are_joined(docs, monkeypatch):
    from energy_series.llm import setjoin

    monkeypatch.setattr(setjoin, "BLOCK_SETS", 4)
    rows = copies(9, 60)
    got = op3_jaccard_join.jaccard_components(docs(rows)).collect()
    assert {tuple(r) for r in got} == brute_components(rows, 3, 9, 10)


def test_prefix_tree_finds_what_pairs_find():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1000, 40)
    sets = [np.unique(np.where(rng.random(40) < p, rng.integers(0, 1000, 40), base)) for p in rng.random(50) * 0.2]
    n = np.array([len(s) for s in sets])
    got = prefix_tree.spanning_links(np.concatenate(sets), n, None, (8, 10))

    def classes(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
        return root

    pairs = [
        (a, b)
        for a, b in itertools.combinations(range(len(sets)), 2)
        if 10 * len(np.intersect1d(sets[a], sets[b])) >= 8 * len(np.union1d(sets[a], sets[b]))
    ]
    assert classes(got) == classes(pairs)


def test_fingerprints(docs, odd):
    rows = sorted(((i, t or "") for i, t in odd), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = op1_fingerprints.edited_fingerprints(docs(odd)).collect()
    assert len(got) == len(rows)
    want = set()
    for (i, t), (_, n) in zip(rows, [*rows[1:], rows[0]], strict=True):
        half = len(t) // 2
        want.add((i, len(t), sha(t[: len(t) - half] + n[:half])))
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in got} == want
    marks = {r.doc_id: r.fingerprint for r in got if r.doc_id not in (None, 3)}
    assert marks[0] == marks[1] == marks[2] != marks[9]
    assert op1_fingerprints.edited_fingerprints(docs([])).count() == 0
    one = op1_fingerprints.edited_fingerprints(docs([(5, "a b c d e f g h")])).first()
    assert one.near_next == 1.0


def test_fingerprints_estimate_jaccard():
    import pyarrow as pa

    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    for cut in (30, 120, 300):
        a, b = " ".join(words[:-cut]), " ".join(words[cut:])
        x, y = op1_fingerprints.signatures(pa.array([a, b]))
        s, t = shingle_set(a, 5), shingle_set(b, 5)
        assert abs((x == y).mean() - len(s & t) / len(s | t)) < 0.15


def test_near_duplicates_by_bands(docs):
    rows = copies(4, 80)
    got = op1_fingerprints.near_duplicates(docs(rows)).collect()
    assert {tuple(r) for r in got} == brute_components(rows, 5, 4, 5)


STRANGE = [
    "<|endoftext|> a<|endoftext|>b <|startoftext|>", "", "  ", "a b  \x1c x \x85y", "ΑΣ ΣΟΣ İI é ẞ 12³½", "aaaaaaa  aaa\n\n b'LL 's'S don't",
    "漢字 🎉🎉🏳️‍🌈 ", "\x00\x01 a\tb", "a" * 3000, "hello</w> world", "''s 's'", "we'll'll 'llx 'r", "x 've", "<|", " ", "\n", "a \n b\n \nc  ",
]


def strange():
    rng = random.Random(1)
    return STRANGE + ["".join(rng.choice("ab'slrevetmd  \n\t1２.,!é漢\xa0<|") for _ in range(rng.randint(0, 40))) for _ in range(300)]


def test_token_counts_equal_the_library(docs, odd):
    library = Tokenizer.from_file(BYTES)
    some = strange()
    want = [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
    assert op6_token_counts.Counter(BYTES).count(some).tolist() == want
    got = op6_token_counts.token_counts(docs(odd)).collect()
    want = [(i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for (i, _), t in zip(odd, texts_of(odd), strict=True)]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_bpe_equals_the_library(docs, odd):
    library = Tokenizer.from_file(WORDS)
    some = strange()
    for text, (ids, n, decoded) in zip(some, op9_bpe.Encoder(WORDS).encode(some), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert (ids, n) == (" ".join(map(str, want)), len(want))
        assert decoded == library.decode(want, skip_special_tokens=False)
    assert op9_bpe.encoded(docs(odd)).count() == len(odd)
    assert op9_bpe.encoded(docs([])).count() == 0


def test_memory_that_forgets(monkeypatch):
    from energy_series.llm import pretokens

    counter = op6_token_counts.Counter(BYTES)
    counter.memory = pretokens.Memory(counter._learn, counter._forget, known=50)
    some = strange()
    want = [len(e.ids) for e in Tokenizer.from_file(BYTES).encode_batch(some, add_special_tokens=False)]
    assert [int(counter.count([t])[0]) for t in some] == want


@pytest.mark.parametrize("ids", [[], [7], [0, 2**32 - 1] * 700, list(range(5000)), [3] * 2049])
def test_token_file_round_trip(ids):
    data = pfor.encode(np.array(ids, np.uint32), np.array([len(ids)]))
    assert pfor.read(data).tolist() == ids
    assert pfor.read(data, 1, 1030).tolist() == ids[1:1030]
    assert pfor.lengths(data).tolist() == [len(ids)]


def test_token_files(docs, odd):
    library = Tokenizer.from_file(BYTES)
    at, want = 0, []
    for i, t in sorted(((i, t or "") for i, t in odd), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [tuple(r) for r in op8_token_files.token_files(docs(odd)).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert op8_token_files.token_files(docs([])).count() == 0


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def brute_spans(text):
    found = [(m.start(), k, m.end()) for k, (p, ok) in enumerate(BASE.values()) for m in re.finditer(p, text) if ok(m[0])]
    return ",".join(f"{list(BASE)[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_personal_data_equals_patterns(docs, odd):
    rng = random.Random(8)
    parts = ["a.b@c.de", "x@y.z_q@r.st", "@", "1.2.3.4", "001.255.0256.1", "1.2.3.4.5.6.7.8", "4465758382889437", "4465 7583-8288 9437", "+1 (414) 555-3519",
             "+1", "é", "漢", "\x01", "🎉", " ", "\n", "-", "12", "word", "."]
    rows = odd + [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))) for i in range(300)]
    got = op2_personal_data.report(docs(rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), sha(brute_spans(t or ""))) for i, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want


def test_terms_disclose_and_are_replaced(docs):
    rows = [(i, f"filler number{'abcdefgh'[i]} the wizardname writes to joe@x.org from home") for i in range(4)]
    rows += [(10 + i, f"other words from home {'pqrstuvw'[i]} and filler writes text") for i in range(8)] + [(99, None)]
    rows += [(200 + i, f"nothing to see here {i}") for i in range(400)]
    spans = {r.doc_id: r.spans for r in op2_personal_data.report(docs(rows)).collect()}
    at = rows[0][1].index("wizardname")
    assert f"term:{at}:{at + 10}" in spans[0] and "email" in spans[0] and spans[10] == ""
    assert "home" not in [rows[0][1][int(s):int(e)] for k, s, e in (x.split(":") for x in spans[0].split(",")) if k == "term"]
    clean = {r.doc_id: r.text for r in op2_personal_data.sanitised(docs(rows)).collect()}
    assert "joe@x.org" not in clean[0] and "wizardname" not in clean[0] and "<EMAIL>" in clean[0]
    assert clean[10] == rows[4][1] and clean[99] is None


def term_spans(rows, report):
    """The terms that a report has as spans, by doc_id."""
    texts = dict(rows)
    parts = {r.doc_id: [x.split(":") for x in r.spans.split(",") if x.startswith("term")] for r in report.collect()}
    return {i: [texts[i][int(s) : int(e)] for _, s, e in p] for i, p in parts.items()}


def test_terms_of_a_tiny_table_and_of_a_frequent_entity_disclose(docs):
    tiny = [(i, f"{'abc'[i] * 5} here the wizardname joe@x.org") for i in range(3)] + [(10 + i, f"here the {'pqrstu'[i] * 5}") for i in range(6)]
    found = term_spans(tiny, op2_personal_data.report(docs(tiny)))
    assert all(found[i] == ["wizardname"] for i in range(3)) and not any(found[10 + i] for i in range(6))
    word = lambda i: "".join("abcdefghij"[int(c)] for c in f"{i:05}")
    third = [(i, f"{word(i)} from this wizardname joe@x.org" if i % 3 == 0 else f"this came from {word(i)}") for i in range(300)]
    found = term_spans(third, op2_personal_data.report(docs(third)))
    assert all(found[i] == (["wizardname"] if i % 3 == 0 else []) for i in range(300))


def test_terms_are_spans_wherever_they_stand(docs):
    rows = [(i, f"Wizardname, {'abc'[i] * 5} sent this, é漢🎉 the WIZARDNAME wizardname joe@x.org\nwizardname\x01") for i in range(3)]
    rows += [(3, "a letter to wizardname and to wizardnames"), (3, "a letter to wizardname and to wizardnames"), (None, "wizardname")]
    rows += [(10 + i, f"{'pqrstu'[i] * 5} sent this letter to the town") for i in range(6)]
    clean = sorted((str(r.doc_id), r.text) for r in op2_personal_data.sanitised(docs(rows)).collect())
    name = re.compile(r"\bwizardname\b", re.I)
    assert clean == sorted((str(i), name.sub("<TERM>", t.replace("joe@x.org", "<EMAIL>"))) for i, t in rows)


def test_short_and_long_words_are_terms(docs):
    long = "Rindfleischetikettierungsüberwachungsaufgabenübertragungsgesetz"
    rows = [(i, f"{'abc'[i] * 5} of the Kim {long} for joe@x.org, 李 or Lee or so") for i in range(3)]
    rows += [(5, f"a text of the or for {long[:-1]}x so, by kim"), (6, "éjoe@x.org é"), (7, "éjoe@x.org é!")]
    rows += [(10 + i, f"{'pqrstu'[i] * 5} of the or for so on") for i in range(6)]
    found = term_spans(rows, op2_personal_data.report(docs(rows)))
    assert all(found[i] == ["Kim", long, "李", "Lee"] for i in range(3))
    assert found[5] == ["kim"] and found[6] == ["é"] and found[10] == []


LONG = " ".join(f"token{i}" for i in range(60)) + "."


def test_line_dedup(docs, odd):
    rows = [(i, f"Own sentence {'abcdefgh'[i]} of this document with many words inside it. {LONG} Tail {i}.") for i in range(6)]
    rows += [(20, LONG), (21, LONG), (30, "Order 17 was shipped to the customer on day 5."), (31, "Order 99 was shipped to the customer on day 6.")]
    kept = {r.doc_id: r.text for r in op4_line_dedup.clean(docs(rows)).collect()}
    assert sum(LONG in t for t in set(kept.values())) == 1
    assert all("Own sentence" in kept[i] for i in range(6))
    assert len({30, 31} & kept.keys()) == 1  # numbers are variable fields
    same = op4_line_dedup.clean(docs(odd))
    assert same.columns == docs(odd).columns
    assert op4_line_dedup.report(docs(odd)).count() == len(odd)
    assert op4_line_dedup.clean(docs([])).count() == 0
    copies_only = op4_line_dedup.report(docs([(1, LONG), (2, LONG), (3, LONG)])).collect()
    assert [r.n_dropped for r in copies_only] == [0, 0, 0]


def test_line_dedup_of_runs_of_short_records(docs):
    verse = "".join(f"Line {w} goes\n" for w in "abcdefghijklmnopqrst")
    han = "春眠不覚暁処処聞啼鳥夜来風雨声花落。知多少人在高楼望月明千里共嬋娟。"
    tabs = "one\ttwo\tthree\tfour\tfive\tsix\tseven\teight\tnine\n"
    rows = [(i, f"Own {'xyz'[i]} text here.\n{verse}Own end {'xyz'[i]}.\nYes.\n") for i in range(3)]
    rows += [(10 + i, f"{'甲乙丙'[i]}自分の文。{han}") for i in range(3)] + [(20 + i, f"{'uvw'[i]}\n\n{tabs}") for i in range(3)]
    rows += [(30, "1\n2\n3\n4\n5\n6\n7\n8\n9\n"), (31, "2\n4\n6\n8\n10\n12\n14\n16\n18\n20\n")]
    got = {r.doc_id: r.text for r in op4_line_dedup.clean(docs(rows)).collect()}
    for ids, passage in ((range(3), verse), (range(10, 13), han), (range(20, 23), tabs)):
        assert sum(passage in got[i] for i in ids) == 1
        for i in ids:
            assert got[i] in (dict(rows)[i], dict(rows)[i].replace(passage, ""))
    assert got[30] == rows[-2][1] and got[31] == rows[-1][1]


def brute_hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))
    hit, found = set(), set()
    for i, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(10, len(w))
        grams = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if n else set()
        for s in range(len(words) - n + 1):
            if tuple(words[s : s + n]) in grams:
                hit |= set(range(s, s + n))
                found.add(str(i))
    return len(words), len(hit), sorted(found)


def test_decontamination_equals_brute_force(spark, docs, odd):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("abcdefg", k=k))) for i, k in enumerate([3, 7, 10, 11, 25, 40])] + [(6, None), (7, "..."), (8, "É x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = odd + [(100 + i, " ".join(rng.choices("abcdefg", k=30)) + "; " + (rng.choice(items)[1] or "").upper() if i % 2 else "É X a b") for i in range(30)]
    got = op7_decontamination.report(docs(rows), bench).collect()
    want = []
    for i, t in rows:
        n, hit, found = brute_hits(t or "", items)
        want.append((str(i), n, hit, len(found), sha(",".join(found)), hit > 0))
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == sorted(want)
    kept = op7_decontamination.clean(docs(rows), bench)
    assert kept.columns == docs(rows).columns and kept.count() == sum(not w[5] for w in want)
    left = op7_decontamination.clean(docs(rows), bench, spans=True)
    assert left.count() == len(rows)
    assert not op7_decontamination.report(left.filter("doc_id >= 100"), bench.filter("item_id = 5")).filter("contaminated").count()
    assert op7_decontamination.report(docs(rows), bench.limit(0)).filter("contaminated").count() == 0


def test_toxicity_learns_and_bears_inserted_characters(docs, spark):
    rng = random.Random(6)
    plain = ["".join(rng.choices("aeioudlnrst", k=rng.randint(3, 9))) for _ in range(4000)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(plain, k=30)
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["blasted", "vermine"]) + rng.choice(["", ".", "x"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(1000, "my garden has a bla-sted stone"), (1001, "you v.e.r.m.i.n.e of a teacher"), (1002, ""), (None, None)]
    table = spark.createDataFrame([*labels, (None, None, None), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = op5_toxicity.scores(docs(rows), op5_toxicity.trained(docs(rows), table)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 50 and all(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert by_id[1000].predicted == by_id[1001].predicted == 1 and by_id[1002].predicted == 0
    nothing = op5_toxicity.scores(docs(rows), op5_toxicity.trained(docs(rows), table.limit(0)))
    assert {r.score for r in nothing.collect()} == {0.0}


def test_licences(docs):
    filler = [(100 + i, f"some plain words of line {i} that go on and on\nand a second line of text {i}") for i in range(50)]
    rows = [
        (1, "Licensed under the Apache License, Version 2.0."), (2, "Intro words here\nReleased under the MIT License. Thanks to all."),
        (3, "Use is governed by our own license terms and nothing else"), (4, None), (5, ""), (6, "All rights reserved.\nLicensed under CC BY-NC 4.0."),
        (7, "a permission is not a licence"), (7, "Licensed under CC BY 4.0"),
    ]
    both = docs(rows + filler)
    got = op10_licences.report(both, op10_licences.trained(both)).filter("doc_id < 10").collect()
    assert sorted((r.doc_id, r.licences, r.n_unknown) for r in got) == [
        (1, "apache-2.0", 0), (2, "mit", 0), (3, "", 1), (4, "", 0), (5, "", 0), (6, "cc-by-nc-4.0,proprietary", 0), (7, "", 1), (7, "cc-by-4.0", 0),
    ]


def test_wrapped_and_adjacent_notices(docs):
    filler = [(100 + i, f"some plain words of line {i} that go on and on\nand a second line of text {i}") for i in range(50)]
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met"
    gpl = (
        " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License"
        " as published by\n * the Free Software Foundation, either version 3 of the License, or"
    )
    mpl = "dnl This Source Code Form is subject to the terms of the Mozilla Public\ndnl License, v. 2.0. If a copy of the MPL was not distributed"
    narrow = "# Permission\n# is hereby\n# granted, free\n# of charge, to\n# any person\n# obtaining a\n# copy of this\n# software"
    rows = [
        (1, bsd), (2, gpl), (3, mpl), (4, narrow), (5, "Text (c) them. All rights\nreserved."),
        (6, "Intro. Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0. Released under the MIT License. More words here."),
        (7, "Licensed under CC BY-NC 4.0"), (8, "Released under the MIT License\nsee the file LICENSE for details"),
        (9, "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted"),
    ]
    both = docs(rows + filler)
    got = {r.doc_id: r for r in op10_licences.report(both, op10_licences.trained(both)).filter("doc_id < 10").collect()}
    assert [got[i].licences for i in range(1, 10)] == [
        "bsd", "gpl-3.0", "mpl-2.0", "mit", "proprietary", "cc-by-4.0,cc-by-nc-4.0,mit", "cc-by-nc-4.0", "mit", "",
    ]
    assert [got[i].n_unknown for i in (1, 3, 4, 5, 6, 7, 8, 9)] == [0, 0, 0, 0, 0, 0, 1, 1]
