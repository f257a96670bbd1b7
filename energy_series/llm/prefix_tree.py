"""A Jaccard join of some sets in one prefix tree.

The sets' shingles get one global order, the rarest first. A tree stores the ordered sets
with common prefixes stored once. A probe walks the tree with the overlap it has so far,
shared by all sets below a node, and leaves a subtree when the shingles missed on
either side exceed what the lengths that remain below it allow.
"""

from __future__ import annotations

import numpy as np


class _Node:
    __slots__ = ("ranks", "children", "sets", "low", "high")

    def __init__(self, ranks: np.ndarray) -> None:
        self.ranks, self.children, self.sets, self.low, self.high = ranks, [], [], 0, 0


def _tree(ordered: list[np.ndarray], which: np.ndarray) -> _Node:
    """The compressed prefix tree of the sets ``which``, which are in lexicographic order."""
    root = _Node(np.zeros(0, np.int64))
    path = [(root, 0)]  # nodes from the root down to the last set, with the depth of their end
    last = np.zeros(0, np.int64)
    for i in which:
        new = ordered[i]
        short = min(len(last), len(new))
        differ = np.flatnonzero(last[:short] != new[:short])
        common = int(differ[0]) if len(differ) else short
        while path[-1][1] > common:
            node, depth = path.pop()
            above = path[-1][1]
            if above < common:  # the common prefix ends inside this node: cut it
                top = _Node(node.ranks[: common - above])
                node.ranks = node.ranks[common - above :]
                path[-1][0].children[-1] = top
                top.children.append(node)
                path.append((top, common))
        if len(new) > common:
            leaf = _Node(new[common:])
            path[-1][0].children.append(leaf)
            path.append((leaf, len(new)))
        path[-1][0].sets.append(int(i))
        last = new
    stack, order = [root], []
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.children
    for node in reversed(order):
        sizes = [len(ordered[i]) for i in node.sets]
        node.low = min([*sizes, *(c.low for c in node.children)], default=0)
        node.high = max([*sizes, *(c.high for c in node.children)], default=0)
    return root


def _probe(root: _Node, probe: np.ndarray, present: np.ndarray, upto: np.ndarray, num: int, den: int, sets: list) -> list[int]:
    """The stored sets whose similarity with ``probe`` reaches num / den.

    ``present`` marks the probe's ranks and ``upto`` counts those below each rank. Sets of
    x and y shingles are similar if they differ in at most ``(x + y) (den - num) / (den + num)``.
    """
    found = []
    x = len(probe)
    stack = [(root, 0, 0)]
    while stack:
        node, overlap, depth = stack.pop()
        if len(node.ranks):
            overlap += int(present[node.ranks].sum())
            depth += len(node.ranks)
            missed = depth - overlap + int(upto[node.ranks[-1] + 1]) - overlap
            if missed * (den + num) > (x + node.high) * (den - num):
                continue
            if node.high * den < x * num or x * den < node.low * num:
                continue
        for i in node.sets:
            if overlap * (den + num) >= num * (x + len(sets[i])):
                found.append(i)
        stack += [(c, overlap, depth) for c in node.children]
    return found


def spanning_links(
    shingles: np.ndarray, n: np.ndarray, second: np.ndarray | None, similarity: tuple[int, int]
) -> list[tuple[int, int]]:
    """Links that connect all sets that similar pairs connect.

    ``shingles`` holds the sets one after another, ``n`` their sizes. With ``second``, only
    pairs of one set with and one without that mark count. Sets without shingles link
    with nothing.
    """
    num, den = similarity
    if len(n) < 2 or not len(shingles):
        return []
    _, inverse, count = np.unique(shingles, return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    owner = np.repeat(np.arange(len(n)), n)
    alone = np.bincount(owner[count[inverse] == 1], minlength=len(n))
    order = np.lexsort((rank[inverse], owner))
    ranks = rank[inverse][order]
    ends = np.cumsum(n)
    ordered = [ranks[e - k : e] for e, k in zip(ends, n, strict=True)]
    fit = [int(i) for i in np.flatnonzero((n > 0) & (alone * num <= n * (den - num)))]
    key = {i: ordered[i].astype(">i8").tobytes() for i in fit}
    fit.sort(key=key.__getitem__)
    stored = [i for i in fit if second is None or not second[i]]
    probes = [i for i in fit if second is None or second[i]]
    if not stored or not probes:
        return []
    root = _tree(ordered, np.array(stored))
    parent = list(range(len(n)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    present = np.zeros(len(count), bool)
    for i in probes:
        present[ordered[i]] = True
        upto = np.concatenate([[0], np.cumsum(present)])
        for j in _probe(root, ordered[i], present, upto, num, den, ordered):
            a, b = top(i), top(j)
            if a != b:
                parent[a] = b
                links.append((i, j))
        present[ordered[i]] = False
    return links
