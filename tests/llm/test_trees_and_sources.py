"""Source divergence, byte-level BPE and the Merkle manifest against brute force, the library, and odd cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken

from energy_series.llm import op11_source_divergence as divergence
from energy_series.llm import op12_byte_bpe as byte_bpe
from energy_series.llm import op13_merkle_manifest as merkle
from energy_series.llm import bpe

FILE = bpe.path(byte_bpe.VOCABULARY)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, kids string, key string, n long"


def table(spark, rows):
    """``(doc_id, text, lang, source)`` with more columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "t", "k", "y", 7) for r in rows], SCHEMA)


# Source divergence


def brute_divergence(rows, least, top):
    rows = [tuple(x or "" for x in r[1:]) for r in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[0].translate({c: c + 32 for c in range(65, 91)})) for r in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        mine = [(r[2], w) for r, w in zip(rows, words, strict=True) if r[1] == lang]
        documents = Counter(t for _, w in mine for t in set(w))
        kept = {t for t, k in documents.items() if k >= least}
        counts = defaultdict(Counter)
        for source, w in mine:
            counts[source].update(t for t in w if t in kept)
        whole = sum(counts.values(), Counter())

        def share(count, of, v=len(kept)):
            return 1 + 10**9 * (count + 2) // (sum(of.values()) + 2 * v)

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        for source in counts:
            others = []
            for other in counts:
                if other != source:
                    total = sum(apart(share(counts[source][t], counts[source]), share(counts[other][t], counts[other])) for t in kept)
                    others.append((total, other))
            found = [(share(counts[source][t], counts[source]), share(whole[t], whole), t) for t in kept if counts[source][t]]
            found = [(apart(p, q), t) for p, q, t in found if p > q]
            for part, items in (("pair", others), ("term", found)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(items, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, source, part, item, value, rank))
    return out


def some_sources(seed, n=400):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma's", "δέλτα", "漢字", "x1y", "É", "zeta", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1]  # copies in other sources and languages
        else:
            text = rng.choice([None, "", "7 8 -", " ".join(rng.choices(words, k=rng.randrange(1, 30)))])
        hot = rng.random() < 0.4
        rows.append((i, text, rng.choice(["en", "en", "de", None, ""]), "s0" if hot else rng.choice(["s1", "s2", "ß", "", None])))
    rows.append((1, "only source", "xx", "one"))
    return rows


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 10, 10), (2, 1, 3), (3, 10_000, 10)])
def test_divergence_equals_brute_force(spark, seed, least, top):
    rows = some_sources(seed)
    got = divergence.audit(table(spark, rows), least, top).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_divergence(rows, least, top)


def test_divergence_with_many_blocks_of_sources(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "HELD", 5)
    rows = [(i, f"a b{'c' * (i % 3)} d" * (1 + i % 5), "en", f"s{i % 9}") for i in range(120)]
    assert {tuple(r) for r in divergence.audit(table(spark, rows)).collect()} == brute_divergence(rows, 10, 10)


def test_divergence_of_long_repeated_and_no_rows(spark):
    assert divergence.audit(table(spark, [])).collect() == []
    rows = [(1, "word " * 100_000, "en", "a")] * 9 + [(1, "x" * 200_000 + " word", "en", "b")] * 3
    assert {tuple(r) for r in divergence.audit(table(spark, rows)).collect()} == brute_divergence(rows, 10, 10)


def test_counts_beyond_64_bits_times_the_scale(spark):
    df = spark.createDataFrame([(3 * 10**12, 10**13, 10**6)], "n long, total long, v long")
    got = df.select(divergence._share("n", "total")).first()[0]
    assert got == 1 + 10**9 * (3 * 10**12 + 2) // (10**13 + 2 * 10**6)


def test_copies_are_collapsed_before_they_are_cut(spark):
    rows = [(i, "same text", "en", f"s{i % 2}") for i in range(50)] + [(99, "same text", "de", "s0")]
    got = divergence.collapsed(table(spark, rows)).collect()
    assert sorted((r.lang, sorted(map(tuple, r.sources))) for r in got) == [("de", [("s0", 1)]), ("en", [("s0", 25), ("s1", 25)])]


# Byte-level BPE


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoding():
    with open(FILE, "rb") as f:
        return library({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def encode_all(encoder, texts):
    ids, n = encoder.encode(pa.array(texts, pa.string()))
    assert encoder.ranks.decode(ids).tobytes().decode() == "".join(t or "" for t in texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_ids_equal_the_library(encoding):
    rng = random.Random(5)
    parts = ["'", "'s", "'re", "'ve", "'ll", "'t", "'m", "'d", " ", "  ", "\n", "\t", " ", "́", "½", "a", "S", "re", "v", "23", "!", "é", "漢", "🎉", " the"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(20_000)]
    texts += [None, "", "x" * 50_000, "ab" * 30_000, " " * 70_000, "the" * 9_000 + " the", "'" * 999, "\n" * 999 + "a", "<|endoftext|>"]
    assert encode_all(byte_bpe._encoder(FILE), texts) == [encoding.encode_ordinary(t or "") for t in texts]


def test_classes_equal_the_library():
    """A slice that is a token stays whole, so a pair of characters is one token if they stay together."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for first, symbol in (("a", byte_bpe.LETTER), ("1", byte_bpe.NUMBER), ("!", byte_bpe.OTHER)):
        ranks = {bytes([b]): b for b in range(256)}
        for c in points:
            ranks.setdefault((first + chr(c)).encode(), len(ranks))
        own = library(ranks)
        together = [len(own.encode_ordinary(first + chr(c))) == 1 for c in points]
        assert ((byte_bpe.classes()[points] == symbol) == together).all()


def test_merges_keep_their_order_in_any_vocabulary(tmp_path):
    """Vocabularies in which a merge can make a pair of a lower rank than its own."""
    rng = random.Random(6)
    for trial in range(20):
        made, pool = [], [b"a", b"b", b"c"]
        while len(made) < 25:
            token = rng.choice(pool) + rng.choice(pool)
            if len(token) < 7 and token not in made:
                made.append(token)
                pool.append(token)
        rng.shuffle(made)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(made)}
        file = tmp_path / str(trial)
        file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
        texts, own = ["".join(rng.choices("abc", k=rng.randrange(1, 40))) for _ in range(200)], library(ranks)
        assert encode_all(byte_bpe.Encoder(str(file)), texts) == [own.encode_ordinary(t) for t in texts]


def test_scan_composes_in_order():
    machine, rng = byte_bpe.automaton(), np.random.default_rng(7)
    for n in (1, 255, 256, 257, 70_000):
        functions = machine.symbol[rng.integers(0, 16, n)]
        now, want = 0, []
        for f in functions.tolist():
            now = machine.composed[now * machine.size + f]
            want.append(now)
        assert machine.scan(functions).tolist() == want


def test_a_worker_that_forgets_gives_the_same_ids(encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 3)
    encoder = byte_bpe.Encoder(FILE)
    for text in ("one two three four five", "five six", "", "one two"):
        assert encode_all(encoder, [text]) == [encoding.encode_ordinary(text)]


def test_encoded_decoded_and_digests(spark, encoding):
    rows = [(None, "no id", "en", "s"), (1, None, "en", "s"), (2, "", "en", "s"), (3, "It's 漢字 🎉", "en", "s"), (3, "again", "en", "s"), (4, "word " * 40_000, "en", "s")]
    df = table(spark, rows)
    out = byte_bpe.encoded(df).collect()
    assert len(out) == len(rows)
    for (key, text, *_), row in zip(rows, out, strict=True):
        want = encoding.encode_ordinary(text or "")
        pieces = encoding.decode_tokens_bytes(want)
        assert (row.doc_id, row.n_tokens, row.ids) == (key, len(want), want)
        assert row.offsets == np.cumsum([0, *map(len, pieces)])[:-1].tolist()
    back = byte_bpe.decoded(byte_bpe.encoded(df)).collect()
    assert [(r.doc_id, r.text) for r in back] == [(i, t or "") for i, t, *_ in rows]
    for (key, text, *_), row in zip(rows, byte_bpe.digests(df).collect(), strict=True):
        want = np.array(encoding.encode_ordinary(text or ""), "<u4")
        assert tuple(row) == (key, len(want), hashlib.sha256(want.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    empty = table(spark, [])
    assert byte_bpe.encoded(empty).count() == byte_bpe.digests(empty).count() == 0
    lists = spark.createDataFrame([(1, None), (2, []), (3, [10**6, -1]), (4, [None])], "doc_id long, ids array<int>")
    assert [r.text for r in byte_bpe.decoded(lists).collect()] == ["", "", "�" * 2, "�"]


# Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_tree(nodes, fanout):
    """The root, and of each node its siblings on the way there."""
    ways, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owned = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for i in range(len(run)):
                for leaf in own[at + i]:
                    ways[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
            above.append(digest(*run))
            owned.append(sum(own[at : at + fanout], []))
        nodes, own = above, owned
    return nodes[0], ways


def brute_manifest(rows, fanout):
    groups = defaultdict(list)
    for i, text, lang, source in rows:
        lead = [field(i), field(source), field(lang), field(None if text is None else len(text))]
        leaf = claim = digest(*lead, field(text))
        if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None:
            claim = digest(*lead, field(text.translate({c: c + 32 for c in range(65, 91)})))
        groups[lang].append((i is not None, i or 0, leaf, claim, i))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = [brute_tree([leaf[2] for leaf in sorted(groups[k])], fanout) for k in names]
    root, tops = brute_tree([t[0] for t in trees], fanout) if trees else (None, [])
    out = []
    for k, (subroot, ways), top in zip(names, trees, tops, strict=True):
        for (_, _, leaf, claim, i), way in zip(sorted(groups[k]), ways, strict=True):
            node = claim
            for a, b in way + top:
                node = digest(a, node, b)
            out.append((i, leaf, subroot, root, digest(*[a + b for a, b in way + top]), node, node == root))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def some_leaves(n, langs, seed=1):
    rng = random.Random(seed)
    texts = [None, "", "Ab C", "É 漢", "Dup", "x" * 9_000]
    return [(rng.choice([None, i, i // 3]), rng.choice(texts), rng.choice(langs), rng.choice([None, "s", ""])) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 9, 600])
@pytest.mark.parametrize("langs", [["z"], [None, "", "b", "ß", "a"]])
def test_manifest_equals_brute_force(spark, n, langs):
    rows = some_leaves(n, langs)
    got = merkle.tamper_report(table(spark, rows)).collect()
    assert ordered(map(tuple, got)) == ordered(brute_manifest(rows, 8))


def test_manifest_of_many_groups_and_high_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_KEY", 4)  # most joins are salted
    rows = some_leaves(700, [f"l{i}" for i in range(60)] + ["hot"] * 60)
    out = merkle.manifest(table(spark, rows), fanout=2).collect()
    proofs = [(r.doc_id, r.leaf, r.subroot, r.root, digest(*[s.left + s.right for s in r.siblings])) for r in out]
    assert ordered(proofs) == ordered(r[:5] for r in brute_manifest(rows, 2))


def test_manifest_orders_leaves_by_number_and_splits_repeated_rows(spark):
    rows = [(i, "t", "en", "s") for i in (10, 9, 100, -1)] + [(5, "same", "en", "s")] * 200
    got = merkle.tamper_report(table(spark, rows).repartition(7)).collect()
    assert ordered(map(tuple, got)) == ordered(brute_manifest(rows, 8))
