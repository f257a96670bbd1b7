"""Meeting keys of shingle sets: linked sets always meet, unrelated ones don't."""

import numpy as np
import pytest

from energy_series.llm import op3_jaccard_join, setjoin

from test_operators import brute_components, docs  # noqa: F401

SIMILARITY = (9, 10)


def _random(rng, n):
    return rng.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)


def _keys(sets):
    flat = np.concatenate([np.asarray(s, np.uint64) for s in sets])
    return setjoin._by_parts(SIMILARITY)(flat, np.array([len(s) for s in sets])).to_pylist()


def _largest_cluster(keys):
    parent = list(range(len(keys)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = {}
    for i, some in enumerate(keys):
        for k in some:
            parent[top(i)] = top(first.setdefault(k, i))
    return max(np.bincount([top(i) for i in range(len(keys))]))


def test_unrelated_sets_do_not_meet_however_many():
    rng = np.random.default_rng(1)
    for size, count in ((10, 16000), (300, 4000), (1000, 2000), (1000, 4000)):
        flat = _random(rng, size * count)
        keys = setjoin._by_parts(SIMILARITY)(flat, np.full(count, size)).to_pylist()
        assert _largest_cluster(keys) <= 2, (size, count)
        assert sum(map(len, keys)) / count < size / 2


def test_linked_sets_meet():
    rng = np.random.default_rng(2)
    seen = 0
    for _ in range(3000):
        y = int(rng.integers(1, 400))
        less, more = (int(x) for x in rng.integers(0, y // 9 + 2, 2))
        base = _random(rng, y + more)
        a, b = base[:y], base[less:]
        if not len(b) or 10 * (y - less) < 9 * (y + more):
            continue
        seen += 1
        left, right = _keys([a, b])
        assert set(left) & set(right), (y, less, more)
    assert seen > 500


def test_sets_equal_in_empty_parts_alone_are_dealt_anew():
    rng = np.random.default_rng(3)
    pool = _random(rng, 4000)
    n = 30
    total, spare = setjoin._parts(30, 34, SIMILARITY)
    crowded = pool[(pool >> np.uint64(32)) % np.uint64(60) == 0][: n + 1]  # one part for every number of parts up to six
    assert total <= 6 and total - 1 > spare and len(crowded) == n + 1
    a, b = crowded[:n], crowded[1:]  # 29 of 31 are shared
    left, right = _keys([a, b])
    assert set(left) & set(right)


def test_empty_sets_and_no_sets_have_no_keys():
    assert _keys([[], np.uint64([5]), []])[0] == []
    assert setjoin._by_parts(SIMILARITY)(np.zeros(0, np.uint64), np.zeros(0, np.int64)).to_pylist() == []
    assert setjoin._by_parts(SIMILARITY)(np.zeros(0, np.uint64), np.zeros(3, np.int64)).to_pylist() == [[], [], []]


def _family(center, count, edits, rng):
    """Texts that each differ from ``center`` in a few words of their own."""
    out = []
    for _ in range(count):
        words = list(center)
        for _ in range(edits):
            words[rng.integers(len(words))] = f"x{rng.integers(10**9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_blocks_and_pivots_equal_brute_force(docs, monkeypatch, edits):
    monkeypatch.setattr(setjoin, "BLOCK_SETS", 4)
    monkeypatch.setattr(setjoin, "PIVOTS", 2)
    rng = np.random.default_rng(edits)
    center = [f"c{i}" for i in range(90)]
    half = [f"h{i}" for i in range(45)]
    texts = [" ".join(center), *_family(center, 40, edits, rng), *_family(center[:45] + half, 15, edits, rng)]
    rows = list(enumerate(texts))
    got = op3_jaccard_join.jaccard_components(docs(rows)).collect()
    assert {tuple(r) for r in got} == brute_components(rows, 3, 9, 10)


def test_a_group_of_near_copies_takes_no_pairs_of_blocks(docs, monkeypatch):
    """Sets that a pivot connects go to one block each, and the pivots to every block."""
    monkeypatch.setattr(setjoin, "BLOCK_SETS", 4)
    joined, plain = [], setjoin._joined

    def counted(sets, dealt, similarity):
        joined.append(dealt.count())
        return plain(sets, dealt, similarity)

    monkeypatch.setattr(setjoin, "_joined", counted)
    rng = np.random.default_rng(5)
    rows = list(enumerate(_family([f"c{i}" for i in range(200)], 64, 1, rng)))
    got = op3_jaccard_join.jaccard_components(docs(rows)).collect()
    assert {r.component_id for r in got} == {0}
    blocks = 64 // setjoin.BLOCK_SETS
    assert joined[0] <= 64 + setjoin.PIVOTS * blocks and sum(joined[1:]) == 0
