"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens; the pre-tokens that a batch has and the worker has not
counted yet are held as one ragged array of byte symbols. In every step each sequence
finds its lowest-ranked neighbouring pair and merges all its places, for all sequences at
once, until none has a pair in the vocabulary; the surviving symbols are counted. Counts
equal those of the tokenizers library for the same file, without added begin or end
tokens; the strings of special tokens inside a text are one token each, as the library's
default has it.

Defined cases: a null text is empty and has 0 bytes and 0 tokens; texts are counted
whole; every input row gives one row, also where ids repeat or are null; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, common, pretokens

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512


def merged_lengths(vocabulary: bpe.Vocabulary, words: list[str]) -> np.ndarray:
    """How many symbols each word has after all merges."""
    symbol, n = vocabulary.symbols(words)
    out = n.copy()
    who = np.repeat(np.arange(len(words)), n)
    while len(symbol):
        rank = np.full(len(symbol), vocabulary.n_merges, np.int64)
        joined = who[1:] == who[:-1]
        rank[:-1][joined] = vocabulary.ranks(symbol[:-1][joined], symbol[1:][joined])
        starts = np.flatnonzero(np.append(True, ~joined))
        low = np.minimum.reduceat(rank, starts)
        live = low < vocabulary.n_merges
        lengths = np.diff(np.append(starts, len(symbol)))
        out[who[starts]] = lengths
        keep = np.repeat(live, lengths)
        symbol, who, rank, low = symbol[keep], who[keep], rank[keep], np.repeat(low, lengths)[keep]
        first = rank == low
        # In a run such as "a a a" of one pair, only every other place merges.
        run = np.flatnonzero(first)
        if len(run):
            head = np.append(True, run[1:] != run[:-1] + 1)
            begin = run[np.maximum.accumulate(np.where(head, np.arange(len(run)), 0))]
            first[run[(run - begin) % 2 == 1]] = False
        at = np.flatnonzero(first)
        symbol[at] = vocabulary.made[rank[at]]
        alive = np.ones(len(symbol), bool)
        alive[at + 1] = False
        symbol, who = symbol[alive], who[alive]
    return out


class Counter:
    """Counts the tokens of texts and remembers the counts of their pre-tokens."""

    def __init__(self, file: str) -> None:
        self.vocabulary = bpe.vocabulary(file)
        self.memory = pretokens.Memory(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.merged = np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        self.merged = np.append(self.merged, merged_lengths(self.vocabulary, words))

    def count(self, texts: list[str]) -> np.ndarray:
        """The tokens of each text."""
        pieces, added = self.vocabulary.plain(texts)
        cut = pretokens.Cut([p for p, _ in pieces], True)
        number = self.memory.number(cut)
        each = pretokens.sums(self.merged[number], cut.counts)
        owner = np.array([i for _, i in pieces], np.int64)
        out = np.zeros(len(texts), np.int64)
        np.add.at(out, owner, each)
        np.add.at(out, np.array([i for _, i in added], np.int64), 1)
        return out


@cache
def _counter(file: str) -> Counter:
    """One for each worker, whose tasks share what it remembers."""
    return Counter(file)


def token_counts(df: DataFrame, text: str = "text", key: str = "doc_id", file: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row."""
    file = file or bpe.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(file)
        for batch in batches:
            for part in common.chunks(batch, "text"):
                texts = part.column("text").fill_null("")
                n = pa.array(counter.count(texts.to_pylist()), pa.int64())
                size = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("key"), size, n], ["key", "n_bytes", "n_tokens"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
