"""Pre-tokens of whole batches of texts, cut, told apart and put together in numpy.

``cut`` gives the places where the two patterns of ``bpe`` cut a text, from the classes of
its characters: letters, numbers, white space and others. Each pre-token has two 64-bit
hashes; a worker works out a distinct pre-token once and keeps what it found by them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import regex

from .shingles import mix, powers

OTHER, LETTER, NUMBER, SPACE = range(4)
KNOWN = 1 << 21  # pre-tokens that a worker remembers at a time; others are worked out again
HASHED = 1 << 16  # code points that are hashed at a time
_STEPS = np.array([0x9E3779B97F4A7C15, 0xD1342543DE82EF95], np.uint64)


@cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for plane in range(0, len(out), 1 << 16):  # one by one, for a worker's memory
        text = "".join(chr(c) for c in range(plane, plane + (1 << 16)) if not 0xD800 <= c <= 0xDFFF)
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
            out[[ord(c) for c in regex.findall(pattern, text)]] = kind
    return out


class Cut:
    """Pre-tokens of some texts: where each begins and ends in ``points``, the code points
    of all texts, and how many each text has. ``spaced`` chooses the pattern: byte-level
    (true), words (false), or anything between blanks (none)."""

    def __init__(self, texts: list[str], spaced: bool | None) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        self.points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        ends = np.cumsum(sizes)
        kind = _classes()[self.points] if spaced is not None else np.where(self.points == 32, np.uint8(SPACE), np.uint8(LETTER))
        starts = self._starts(kind, (ends - sizes)[sizes > 0], spaced)
        at = np.flatnonzero(starts)
        stop = np.append(at[1:], len(kind)) if len(at) else at
        if not spaced:
            words = kind[at] != SPACE
            at, stop = at[words], stop[words]
        self.begin, self.end = at, stop
        self.counts = np.diff(np.searchsorted(at, np.append(0, ends)))

    def _starts(self, kind: np.ndarray, heads: np.ndarray, spaced: bool | None) -> np.ndarray:
        """Marks the first character of every pre-token; with ``spaced``, one blank belongs to
        what follows it and other white space is a pre-token, else white space parts."""
        n, points = len(kind), self.points
        run = np.zeros(n + 1, bool)
        run[1:n] = kind[1:] != kind[:-1]
        run[heads] = True
        run[n:] = True
        head = np.zeros(n + 1, bool)
        head[heads] = True
        head[n:] = True
        starts = run[:n].copy()
        last = np.flatnonzero((kind == SPACE) & run[1:])  # the ends of white space
        last = last[~head[last + 1]]
        if spaced:
            starts[last] = True
            starts[last[points[last] == 32] + 1] = False
        elif spaced is None:
            return starts
        else:
            starts |= kind == NUMBER
        quote = np.flatnonzero((points == 39) & starts & run[:n] & run[1:])
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~head[quote + 1]]
        padded = np.append(points, [0, 0])
        first, second = padded[quote + 1], padded[quote + 2]
        two = (quote + 2 < n) & ~head[np.minimum(quote + 2, n)]
        short = np.isin(first, [ord(c) for c in "stmd"])
        long = two & np.any([(first == ord(a)) & (second == ord(b)) for a, b in ("re", "ve", "ll")], axis=0)
        for some, length in ((quote[short], 2), (quote[~short & long[: len(quote)]], 3)):
            starts[some + 1] = False
            after = some + length
            starts[after[after < n]] = True
        return starts

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of every pre-token."""
        sizes = self.end - self.begin
        if not len(sizes):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        firsts = np.cumsum(sizes) - sizes
        longest = int(sizes.max())
        scale = [powers(step, longest + 1)[1:] for step in _STEPS]
        found = [np.empty(len(sizes), np.uint64) for _ in _STEPS]
        # Some pre-tokens at a time: of one code point the arrays here take many bytes.
        cuts = np.searchsorted(firsts, np.arange(0, int(firsts[-1]) + 1, HASHED)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True):
            if a == b:
                continue
            n, first = sizes[a:b], firsts[a:b] - firsts[a]
            local = np.arange(int(n.sum())) - np.repeat(first, n)
            points = self.points[local + np.repeat(self.begin[a:b], n)] + np.uint64(1)
            for out, some in zip(found, scale, strict=True):
                out[a:b] = mix(np.add.reduceat(points * some[local], first) + n.astype(np.uint64))
        return found[0], found[1]

    def strings(self, which: np.ndarray) -> list[str]:
        data = self.points.tobytes()
        return [data[4 * b : 4 * e].decode("utf-32-le") for b, e in zip(self.begin[which].tolist(), self.end[which].tolist(), strict=True)]


class Memory:
    """Numbers distinct pre-tokens and hands new ones to ``learn``.

    ``learn`` gets new strings, whose numbers continue the numbers so far; ``forget`` says
    that all numbers so far are void.
    """

    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None], known: int = KNOWN) -> None:
        self.learn, self.forget, self.known = learn, forget, known
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        inside = np.minimum(at, max(len(self.keys) - 1, 0))
        return inside, self.keys[inside] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def number(self, cut: Cut) -> np.ndarray:
        """The number of every pre-token of ``cut``."""
        hashes, checks = cut.hashes()
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at, there = self._find(keys)
        if len(self.keys) + int((~there).sum()) > self.known and len(self.keys):
            self._clear()
            self.forget()
            at, there = self._find(keys)
        new = np.flatnonzero(~there)
        if len(new):
            self.learn(cut.strings(first[new]))
            numbers = np.arange(len(self.keys), len(self.keys) + len(new))
            where = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, where, keys[new])
            self.checks = np.insert(self.checks, where, checks[first[new]])
            self.numbers = np.insert(self.numbers, where, numbers)
            at, _ = self._find(keys)
        if len(keys) and not (self.checks[at][inverse] == checks).all():
            raise ValueError("two pre-tokens have one hash")
        return self.numbers[at][inverse] if len(keys) else np.zeros(0, np.int64)


class Ragged:
    """Rows of different lengths that grow, and are put together by their numbers."""

    def __init__(self, dtype: type) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.flat = np.zeros(0, self.dtype)
        self.ends = np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, len(self.flat) + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, flat.astype(self.dtype, copy=False)])

    def lengths(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of these numbers one after another, and their lengths."""
        n = self.lengths()[numbers]
        shift = (self.ends - self.lengths())[numbers] - (np.cumsum(n) - n)
        return self.flat[np.repeat(shift, n) + np.arange(int(n.sum()))], n


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of consecutive groups of so many values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
