"""BPE encoding and decoding with a pair occurrence index.

The words that a chunk has and the worker has not encoded yet are laid out as one
array of byte symbols with links to the neighbours. An index maps each pair that has a
merge to all its positions; active ranks are applied in ascending order, each to its
whole list, and the lists of the pairs that a merge makes are extended (positions that
a merge has used up are passed over when their list comes). Ids and decoded texts equal
those of the tokenizers library for the same file.

Defined cases: a null text is empty, has no tokens and decodes to an empty text; texts are
encoded whole; every input row gives one row, also where ids repeat or are null; columns
of other names are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, common, pretokens

VOCABULARY = "word_bpe_49k.json"
CHUNK_BYTES = 1 << 22
SLICE = 1 << 19  # characters that are cut, or encoded, at a time
KNOWN = 1 << 19  # words that a worker remembers at a time


def normalised(text: str) -> str:
    """NFC and the lower case of each character by itself. White space of any kind only
    parts words, so it need not become a blank first."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # at a word's end, too
    return text.lower()


class Index:
    """Places by the rank of the pair that begins there.

    The places of a rank are runs of one array; a run knows the run of its rank before it,
    so that a place takes a few bytes however many ranks and runs there are.
    """

    def __init__(self, n_ranks: int, most: int) -> None:
        """For at most so many places."""
        self.last = np.full(n_ranks, -1, np.int32)  # the newest run of each rank
        self.places = np.empty(most, np.int32)
        self.begin = np.zeros(most + 1, np.int32)  # of each run; it ends where the next begins
        self.previous = np.empty(most, np.int32)
        self.n_runs = 0
        self.ranks: list[int] = []  # a heap of those that have places

    def add(self, at: np.ndarray, rank: np.ndarray) -> None:
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        heads = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        rank, first, n = rank[heads], int(self.begin[self.n_runs]), self.n_runs + len(heads)
        before = self.last[rank]
        self.places[first : first + len(at)] = at
        self.begin[self.n_runs : n] = first + heads
        self.begin[n] = first + len(at)
        self.previous[self.n_runs : n] = before
        self.last[rank] = np.arange(self.n_runs, n)
        self.n_runs = n
        for r in rank[before < 0].tolist():
            heapq.heappush(self.ranks, r)

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and its places, ascending."""
        rank = heapq.heappop(self.ranks)
        run, self.last[rank] = int(self.last[rank]), -1
        runs = []
        while run >= 0:
            runs.append(self.places[self.begin[run] : self.begin[run + 1]])
            run = int(self.previous[run])
        return rank, np.unique(np.concatenate(runs))


def encode_words(vocabulary: bpe.Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after another, and how many each has."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    symbol, n = vocabulary.symbols(words)
    symbol = symbol.astype(np.int32)
    size = len(symbol)
    ends = np.cumsum(n)
    after = np.arange(1, size + 1, dtype=np.int32)
    after[ends - 1] = -1
    before = np.arange(-1, size - 1, dtype=np.int32)
    before[ends - n] = -1
    alive = np.ones(size, bool)
    index = Index(vocabulary.n_merges, 3 * size)  # a merge, of which each uses up a place, makes two pairs

    def add(at: np.ndarray) -> None:
        """Puts the pairs that begin at these positions into the index."""
        rank = vocabulary.ranks(symbol[at].astype(np.int64), symbol[after[at]])
        real = rank < vocabulary.n_merges
        index.add(at[real], rank[real])

    add(np.flatnonzero(after >= 0))
    while index.ranks:
        rank, at = index.pop()
        left, right = vocabulary.left[rank], vocabulary.right[rank]
        at = at[alive[at] & (symbol[at] == left) & (after[at] >= 0)]
        at = at[symbol[after[at]] == right]
        if left == right and len(at) > 1:  # of "a a a" the first two merge
            head = np.append(True, after[at[:-1]] != at[1:])
            begin = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        symbol[at] = vocabulary.made[rank]
        alive[gone] = False
        after[at] = after[gone]
        has = after[at] >= 0
        before[after[at[has]]] = at[has]
        changed = before[at]
        add(np.unique(np.concatenate([at[has], changed[changed >= 0]])))
    return symbol[alive], np.add.reduceat(alive, ends - n, dtype=np.int64)


def slices(texts: list[str], limit: int) -> Iterator[list[str]]:
    """Consecutive texts with about ``limit`` characters together, one text at least."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield texts[start:i]
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield texts[start:]


class Encoder:
    """Encodes texts and remembers the ids of their words.

    Words are told apart a slice of the texts at a time and encoded together, so that
    neither the arrays of a slice nor those of the index grow with a batch.
    """

    def __init__(self, file: str) -> None:
        self.vocabulary = bpe.vocabulary(file)
        self.decimal = {i: str(i) for i in self.vocabulary.tokens}
        self.ids = pretokens.Ragged(np.int32)
        self.waiting: list[str] = []  # words that have numbers, but no ids yet
        self.waiting_size = 0
        self.memory = pretokens.Memory(self._learn, self._forget, KNOWN)
        self._begin(str)

    def _begin(self, kept: Callable[[str], str]) -> None:
        self.kept = kept
        self.held: list[tuple] = []  # slices whose words have numbers
        self.rows: list[tuple[str, int, str]] = []

    def _learn(self, words: list[str]) -> None:
        for word in words:
            self.waiting.append(word)
            self.waiting_size += len(word)
            if self.waiting_size > SLICE:
                self._encode_waiting()

    def _encode_waiting(self) -> None:
        if self.waiting:
            self.ids.add(*encode_words(self.vocabulary, self.waiting))
            self.waiting, self.waiting_size = [], 0

    def _forget(self) -> None:
        self._finish()  # the slices so far use the numbers so far
        self.ids.clear()

    def _finish(self) -> None:
        """The rows of the slices that are held."""
        self._encode_waiting()
        decimal, token = self.decimal.__getitem__, self.vocabulary.tokens.__getitem__
        for size, owners, added, counts, number in self.held:
            flat, n = self.ids.gather(number)
            ids: list[list[int]] = [[] for _ in range(size)]
            flat, marks, at = flat.tolist(), iter(added), 0
            for i, end, following in zip(owners, np.cumsum(pretokens.sums(n, counts)).tolist(), [*owners[1:], -1], strict=True):
                ids[i] += flat[at:end]
                at = end
                if following == i:
                    ids[i].append(self.vocabulary.added[next(marks)[0]])
            self.rows += [(self.kept(" ".join(map(decimal, x))), len(x), self.kept(" ".join(map(token, x)))) for x in ids]
        self.held = []

    def encode(self, texts: list[str], kept: Callable[[str], str] = str) -> list[tuple[str, int, str]]:
        """Of each text: its ids in decimal, joined by blanks, their number, and the text
        that they decode to; of ids and text what ``kept`` makes of them."""
        self._begin(kept)
        for some in slices(texts, SLICE):
            pieces, added = self.vocabulary.plain(some)
            cut = pretokens.Cut([normalised(p) for p, _ in pieces], False)
            number = self.memory.number(cut)  # may finish the slices before
            self.held.append((len(some), [i for _, i in pieces], added, cut.counts, number))
        self._finish()
        rows = self.rows
        self._begin(str)
        return rows


@cache
def _encoder(file: str) -> Encoder:
    """One for each worker, whose tasks share what it remembers."""
    return Encoder(file)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(df: DataFrame, text: str = "text", key: str = "doc_id", file: str | None = None, digests: bool = False) -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and ``decoded`` of every row; with ``digests`` the
    SHA-256 of the ids in decimal, joined by blanks, and of the decoded text instead."""
    file = file or bpe.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file)
        for batch in batches:
            for part in common.chunks(batch, "text", CHUNK_BYTES):
                rows = encoder.encode(part.column("text").fill_null("").to_pylist(), _digest if digests else str)
                n = pa.array([r[1] for r in rows], pa.int64())
                if digests:
                    ids = pa.array([r[0] for r in rows], pa.string())
                else:
                    ids = pa.array([[int(i) for i in r[0].split()] for r in rows], pa.list_(pa.int32()))
                decoded = pa.array([r[2] for r in rows], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("key"), n, ids, decoded], names)

    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["key", "n_tokens", "ids", "decoded"]
    kind = df.schema[key].dataType.simpleString()
    types = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_tokens long, {types}")
    return out.withColumnRenamed("key", key)
