"""Byte-level BPE by a rank file, with pre-tokens found by scans instead of a regular expression.

Every code point becomes one of eight symbols: its class and, for white space and for
apostrophes, what follows. A finite automaton over these symbols knows where a pre-token
begins. A symbol's transition function maps states to states, and functions compose
associatively, so the states of a whole batch come from a prefix scan: blocks are composed
side by side, the blocks' totals are scanned in the same way, and both are composed. The
functions that can occur are few and numbered; composing two is one look-up. The first
symbol of a text is a constant function, which makes texts independent of each other.

The slices between the boundaries are looked up by their bytes. Those that the worker does
not know are merged, all at once, pair by pair in the order of ranks, and remembered. Ids
equal those of the tiktoken library for the same ranks and pattern, without special tokens.
Each token's offset in the bytes of its text follows from the lengths of the tokens, and
decoding copies the vocabulary's bytes to those places.

Defined cases: a null text is empty, has no tokens and decodes to an empty text; texts are
encoded whole, whatever their length; every input row gives one row, also where ids repeat or
are null; columns of other names are not read; a null list of ids decodes to an empty text, and
an id that the file lacks to U+FFFD.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, common, pretokens, shingles

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CHUNK_BYTES = 1 << 21
KNOWN = 1 << 19  # slices, and KNOWN_BYTES of them, that a worker remembers at a time
KNOWN_BYTES = 1 << 26
BLOCK = 256

# Symbols. An apostrophe is SHORT or LONG if it could open a contraction of two or three
# characters; white space is BLANK (U+0020) or WHITE before something else, else MORE_WHITE.
LETTER, NUMBER, OTHER, SHORT, LONG, BLANK, WHITE, MORE_WHITE = range(8)
# States: within letters, numbers, others or white space; after a blank that what follows
# joins; with one or two characters of a contraction to come; with nothing to continue.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, JOINING, ONE_TO_COME, TWO_TO_COME, FREE = range(8)

_OPENS = {
    LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: ONE_TO_COME, LONG: TWO_TO_COME,
    BLANK: JOINING, WHITE: FREE, MORE_WHITE: IN_WHITE,
}
_CONTINUES = {(IN_LETTERS, LETTER): IN_LETTERS, (IN_NUMBERS, NUMBER): IN_NUMBERS, (IN_WHITE, MORE_WHITE): IN_WHITE}
_CONTINUES |= {(IN_OTHERS, s): IN_OTHERS for s in (OTHER, SHORT, LONG)}
_CONTINUES |= {(JOINING, LETTER): IN_LETTERS, (JOINING, NUMBER): IN_NUMBERS}
_CONTINUES |= {(JOINING, s): IN_OTHERS for s in (OTHER, SHORT, LONG)}
_CONTINUES |= {(TWO_TO_COME, s): ONE_TO_COME for s in range(8)} | {(ONE_TO_COME, s): FREE for s in range(8)}
_BEGINS = np.array([[(state, s) not in _CONTINUES for s in range(8)] for state in range(8)])


# Code points that the regex module's tables have as letters or numbers and the
# tables of the tiktoken library, which are older, do not have.
_UNKNOWN = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24
1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF
2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""


@cache
def classes() -> np.ndarray:
    """The symbol of every code point, whatever follows it."""
    to_symbol = np.zeros(4, np.int8)
    to_symbol[[pretokens.LETTER, pretokens.NUMBER, pretokens.OTHER, pretokens.SPACE]] = LETTER, NUMBER, OTHER, MORE_WHITE
    out = to_symbol[pretokens._classes()]
    for some in _UNKNOWN.split():
        ends = [int(x, 16) for x in some.split("-")]
        out[ends[0] : ends[-1] + 1] = OTHER
    return out


class Automaton:
    """The transition functions that occur, numbered, and their compositions."""

    def __init__(self) -> None:
        step = [tuple(_CONTINUES.get((state, s), _OPENS[s]) for state in range(8)) for s in range(8)]
        first = [(_OPENS[s],) * 8 for s in range(8)]  # whatever came before
        functions = [tuple(range(8))]
        number = {functions[0]: 0}
        generators = [*step, *first]
        for f in functions:  # grows while it is read, until closed under composition
            for g in generators:
                h = tuple(g[x] for x in f)
                if h not in number:
                    number[h] = len(functions)
                    functions.append(h)
        self.size = len(functions)
        self.symbol = np.array([number[g] for g in generators], np.int32)  # 8 + s for the first of a text
        composed = [[number.get(tuple(g[x] for x in f), 0) for g in functions] for f in functions]
        self.composed = np.array(composed, np.int32).ravel()
        self.result = np.array([f[FREE] for f in functions], np.int8)

    def scan(self, functions: np.ndarray) -> np.ndarray:
        """The composition of all functions up to each place."""
        n = len(functions)
        if n <= BLOCK:
            out, now = np.empty(n, np.int32), 0
            for i, f in enumerate(functions.tolist()):
                now = out[i] = self.composed[now * self.size + f]
            return out
        n_blocks = -(-n // BLOCK)
        steps = np.zeros((n_blocks, BLOCK), np.int32)  # filled up with the identity, number 0
        steps.ravel()[:n] = functions
        steps = np.ascontiguousarray(steps.T)
        within, now = np.empty_like(steps), np.zeros(n_blocks, np.int32)
        for i in range(BLOCK):
            now = within[i] = self.composed[now * self.size + steps[i]]
        before = np.append(np.int32(0), self.scan(now)[:-1])
        return self.composed[before * self.size + within].T.ravel()[:n]


@cache
def automaton() -> Automaton:
    return Automaton()


def symbols(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The symbol of every code point; ``heads`` are the places of the texts' first ones."""
    n = len(points)
    out = classes()[points]
    ends = np.append(heads[1:], n) - 1  # the last place of every text
    last = np.zeros(n + 2, bool)
    last[ends] = True
    solid = np.append(out[1:] != MORE_WHITE, False) & ~last[:n]
    white = np.flatnonzero((out == MORE_WHITE) & solid)
    quotes = np.flatnonzero((points == 39) & solid)
    out[white] = np.where(points[white] == 32, BLANK, WHITE)
    padded = np.append(points, [0, 0])
    one, two = padded[quotes + 1], np.where(last[quotes + 1], 0, padded[quotes + 2])
    out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    out[quotes[np.any([(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")], axis=0)]] = LONG
    return out


def boundaries(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin."""
    if not len(points):
        return np.zeros(0, np.int64)
    machine, symbol = automaton(), symbols(points, heads)
    functions = machine.symbol[symbol]
    functions[heads] = machine.symbol[8 + symbol[heads]]
    before = np.append(np.int8(FREE), machine.result[machine.scan(functions)][:-1])
    before[heads] = FREE
    return np.flatnonzero(_BEGINS[before, symbol])


class Ranks:
    """Tokens by rank, and the token that two tokens make."""

    def __init__(self, file: str) -> None:
        with open(file, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.none = max(self.ids.values()) + 1
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (self.ids[t[:i]] * self.none + self.ids[t[i:]], made)
            for t, made in self.ids.items()
            for i in range(1, len(t))
            if t[:i] in self.ids and t[i:] in self.ids
        ]
        self.keys, self.made = np.array(sorted(pairs), np.int64).reshape(-1, 2).T.copy()
        tokens = {i: t for t, i in self.ids.items()}
        self.tokens = [tokens.get(i, "�".encode()) for i in range(self.none)] + ["�".encode()]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair makes; ``none`` if the two do not merge."""
        keys = left * self.none + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.made[at], self.none)

    def merge(self, slices: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slices one after another, and how many each has."""
        whole = np.array([self.ids.get(s, -1) for s in slices], np.int64)
        rest = np.flatnonzero(whole < 0)
        data = [slices[i] for i in rest.tolist()]
        symbol = self.bytes[np.frombuffer(b"".join(data), np.uint8)]
        who = np.repeat(rest, [len(s) for s in data])
        found, owners = [whole[whole >= 0]], [np.flatnonzero(whole >= 0)]
        while len(symbol):
            inner = who[1:] == who[:-1]
            made = np.full(len(symbol), self.none)
            made[:-1][inner] = self.pair(symbol[:-1][inner], symbol[1:][inner])
            heads = np.flatnonzero(np.append(True, ~inner))
            low = np.minimum.reduceat(made, heads)
            sizes = np.diff(np.append(heads, len(symbol)))
            keep = np.repeat(low < self.none, sizes)
            found.append(symbol[~keep])
            owners.append(who[~keep])
            symbol, who, made, low = symbol[keep], who[keep], made[keep], np.repeat(low, sizes)[keep]
            at = self._in_order(symbol, who, low, _apart(np.flatnonzero(made == low)))
            symbol[at] = low[at]
            alive = np.ones(len(symbol), bool)
            alive[at + 1] = False
            symbol, who = symbol[alive], who[alive]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(found)[order], np.bincount(owner, minlength=len(slices))

    def _in_order(self, symbol: np.ndarray, who: np.ndarray, low: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The places that may merge at once. Merges go one by one, from the left; where one makes
        a pair of a lower rank than its own, only the first of its slice is taken now."""
        if not len(at):
            return at
        made, n = low[at], len(symbol)
        merged = np.zeros(n, bool)
        merged[at] = True
        left = np.maximum(at - 1, 0)
        has = (at > 0) & (who[left] == who[at])
        beside = np.where(merged[np.maximum(at - 2, 0)] & (at > 1), made, symbol[left])
        worse = has & (self.pair(beside, made) < made)
        right = np.minimum(at + 2, n - 1)
        has = (at + 2 < n) & (who[right] == who[at])
        worse |= has & (self.pair(made, symbol[right]) < made)
        if not worse.any():
            return at
        first = np.append(True, who[at[1:]] != who[at[:-1]])
        return at[first | ~np.isin(who[at], who[at[worse]])]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids one after another."""
        ids = np.where((ids >= 0) & (ids < self.none), ids, self.none)
        n = self.lengths[ids]
        offsets = np.cumsum(n) - n
        return self.flat[np.repeat(self.begins[ids] - offsets, n) + np.arange(int(n.sum()))]


def _apart(at: np.ndarray) -> np.ndarray:
    """Of places next to each other every other one, from the first."""
    if not len(at):
        return at
    head = np.append(True, np.diff(at) != 1)
    begin = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - begin) % 2 == 0]


class Slices(dict):
    """Numbers slices in the order of their first appearance; ``new`` lists those not merged yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class Encoder:
    """Encodes batches of texts and remembers what it merged."""

    def __init__(self, file: str) -> None:
        self.ranks = Ranks(file)
        self._forget()

    def _forget(self) -> None:
        self.slices, self.held = Slices(), 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.n = 0

    def _learn(self) -> None:
        new, self.slices.new = self.slices.new, []
        if not new:
            return
        ids, sizes = self.ranks.merge(new)
        base = int(self.ends[self.n - 1]) if self.n else 0
        self.flat = _room(self.flat, base + len(ids))
        self.ends = _room(self.ends, self.n + len(new))
        self.flat[base : base + len(ids)] = ids
        self.ends[self.n : self.n + len(new)] = base + np.cumsum(sizes)
        self.n += len(new)
        self.held += sum(map(len, new))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if len(self.slices) > KNOWN or self.held > KNOWN_BYTES:
            self._forget()
        data, offsets = shingles.utf8(texts)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        heads = np.searchsorted(leads, offsets[:-1][offsets[:-1] < offsets[1:]])
        begin = leads[boundaries(points, heads)]
        end = np.append(begin[1:], len(data))
        slices = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
        number = np.fromiter(map(self.slices.__getitem__, slices), np.int64, len(slices))
        self._learn()
        ends = self.ends[number]
        n = ends - np.where(number > 0, self.ends[number - 1], 0)
        total = np.cumsum(n)
        ids = self.flat[np.repeat(ends - total, n) + np.arange(int(total[-1]))].astype(np.int64)
        per_slice = np.append(0, total)
        return ids, np.diff(per_slice[np.searchsorted(begin, offsets)])


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or one of at least twice its size with the same beginning."""
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


@cache
def _encoder(file: str) -> Encoder:
    """One for each worker, whose tasks share what it remembers."""
    return Encoder(file)


def _strings(data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw, ends = data.tobytes(), np.cumsum(sizes)
    return [raw[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total, ends = np.append(0, np.cumsum(values)), np.cumsum(counts)
    return total[ends] - total[ends - counts]


def encoded(df: DataFrame, text: str = "text", key: str = "doc_id", file: str | None = None) -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and ``offsets``, the first byte of each token in its text, of every row."""
    file = file or bpe.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file)
        for batch in batches:
            for part in common.chunks(batch, "text", CHUNK_BYTES):
                ids, n = encoder.encode(part.column("text"))
                size = encoder.ranks.lengths[ids]
                before = np.cumsum(size) - size
                ends = np.append(0, np.cumsum(n)).astype(np.int32)
                first = np.append(before, 0)[np.minimum(ends[:-1], len(before))]
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(v, pa.int32()))
                    for v in (ids, before - np.repeat(first, n))
                ]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(n, pa.int64()), *lists], ["key", "n_tokens", "ids", "offsets"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return out.mapInArrow(run, f"key {kind}, n_tokens long, ids array<int>, offsets array<int>").withColumnRenamed("key", key)


def decoded(df: DataFrame, ids: str = "ids", key: str = "doc_id", file: str | None = None) -> DataFrame:
    """``key`` and ``text``, what the list of ids decodes to, of every row."""
    file = file or bpe.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _encoder(file).ranks
        for batch in batches:
            lists = batch.column("ids")
            n = np.array([0 if x is None else len(x) for x in lists.to_pylist()], np.int64)
            flat = lists.flatten().cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            known = np.where((flat >= 0) & (flat < ranks.none), flat, ranks.none)
            texts = _strings(ranks.decode(known), _sums(ranks.lengths[known], n))
            out = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), out], ["key", "text"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    return out.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def digests(df: DataFrame, text: str = "text", key: str = "doc_id", file: str | None = None) -> DataFrame:
    """``key``, ``n_tokens`` and the SHA-256 of every row's ids (as little-endian unsigned 32-bit
    integers) and of the bytes that they decode to."""
    file = file or bpe.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file)
        for batch in batches:
            for part in common.chunks(batch, "text", CHUNK_BYTES):
                ids, n = encoder.encode(part.column("text"))
                back = _strings(encoder.ranks.decode(ids), _sums(encoder.ranks.lengths[ids], n))
                words = _strings(ids.astype("<u4").view(np.uint8), 4 * n)
                columns = [pa.array([hashlib.sha256(x).hexdigest() for x in some], pa.string()) for some in (words, back)]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(n, pa.int64()), *columns], names)

    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return out.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
