"""Document fingerprints by MinHash.

A document's shingles are its runs of five words (all words where it has fewer). Each
of 128 universal hash functions ``(a * x + b) mod 2^64`` gives the document its smallest
value over all shingles; the upper 32 bits of the 128 minima are the fingerprint, and
the share of equal places in two fingerprints estimates the Jaccard similarity of the
shingle sets. Near duplicates meet in a Spark shuffle by bands of the signature, and
their Jaccard similarity is verified on the sets themselves.

Defined cases: a null text is empty; an empty text, or one of white space alone, has the
fingerprint of all ones, so two of them are alike (1) and differ from every other text.
Very long texts are read whole. Rows that repeat a doc_id are rows of their own, in
the order of their texts; null ids come first. An empty table gives no rows. Other
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, setjoin, shingles

PERMUTATIONS = 128
SHINGLE = 5
ROWS = 4
EMPTY = np.uint32(0xFFFFFFFF)
MOST = 256
_RNG = np.random.default_rng(1)
_A = _RNG.integers(0, 1 << 63, MOST).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, MOST).astype(np.uint64)
#: More functions, for similarities that need more bands; the first stay as they are.
MORE = 4096
_RNG = np.random.default_rng(2)
_A = np.concatenate([_A, _RNG.integers(0, 1 << 63, MORE - MOST).astype(np.uint64) * np.uint64(2) + np.uint64(1)])
_B = np.concatenate([_B, _RNG.integers(0, 1 << 63, MORE - MOST).astype(np.uint64)])
MISS = 2e-11
_BLOCK = 1 << 15


def signatures(texts: pa.Array) -> np.ndarray:
    """One row of 128 minima (unsigned 32 bits) for each text."""
    return minima(*shingles.shingle_hashes(*shingles.word_hashes(*shingles.utf8(texts)), SHINGLE))


def minima(hashes: np.ndarray, n: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """The minima of documents with ``n`` shingles each, given one after another."""
    out = np.full((len(n), permutations), EMPTY, np.uint32)
    docs = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[docs]
    ends = starts + n[docs]
    i = 0
    while i < len(docs):  # blocks that stay in the processor's cache, of one document at least
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, "right")))
        block, at = hashes[starts[i] : ends[j - 1]], starts[i:j] - starts[i]
        value = np.empty_like(block)
        for p in range(permutations):
            np.multiply(block, _A[p], out=value)
            np.add(value, _B[p], out=value)
            out[docs[i:j], p] = np.minimum.reduceat(value, at) >> np.uint64(32)
        i = j
    return out


def _hex(rows: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in rows]


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``fingerprint`` (hex) and ``bands`` (one hash for each band) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, "_text"):
                sig = signatures(part.column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), pa.array(_hex(sig), pa.string()), band_hashes(sig)], ["_key", "fingerprint", "bands"]
                )

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        run, f"_key {kind}, fingerprint string, bands array<long>"
    )
    return out.withColumnRenamed("_key", key)


def band_hashes(sig: np.ndarray) -> pa.Array:
    """One hash for each band of four places."""
    rows, bands = ROWS, sig.shape[1] // ROWS
    weight = shingles.powers(np.uint64(0xD1342543DE82EF95), rows + 1)[1:]
    value = (sig.reshape(len(sig), bands, rows).astype(np.uint64) * weight).sum(axis=2, dtype=np.uint64)
    value = shingles.mix(value + np.arange(bands, dtype=np.uint64))
    offsets = np.arange(len(sig) + 1, dtype=np.int32) * bands
    return pa.ListArray.from_arrays(offsets, value.ravel().view(np.int64))


def banded(similarity: tuple[int, int], least: int) -> Callable[[np.ndarray, np.ndarray], pa.Array] | None:
    """Meeting keys by ``least`` bands or, if these miss a pair of this similarity with a chance above ``MISS``, by as many
    as it takes; None where there are too few functions for that, since keys by parts are exact."""
    num, den = similarity
    bands = least
    if num < den:
        bands = max(least, math.ceil(math.log(MISS) / math.log1p(-((num / den) ** ROWS)))) if num else MORE
    return (lambda hashes, n: band_hashes(minima(hashes, n, ROWS * bands))) if ROWS * bands <= MORE else None


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id``: the smallest key reachable by links.

    Two documents link when a band of their signatures is equal and the Jaccard
    similarity of their shingle sets, computed on the sets, reaches ``similarity`` (a
    fraction of whole numbers). Equal sets are one class, joined once for them all.
    """

    return setjoin.components_of(df, text, key, SHINGLE, similarity, banded(similarity, PERMUTATIONS // ROWS))


def edited_fingerprints(df: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and likenesses.

    The edited text is the text with its last ``n_chars div 2`` code points replaced by
    the first as many of the next document in ascending doc_id; after the last comes the
    first. Documents are dealt to ranges of ids, each with a copy of the first document
    of the following range, so every text is shuffled once and no window spans the table.
    """
    spark = df.sparkSession
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = 8 * common.partitions(spark)
    ranks = F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)
    splits = np.unique(np.array(docs.agg(ranks.alias("s")).first()["s"] or [], np.int64))

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pandas()
            low = ids.groupby(_ranges(batch.column("doc_id"), splits)).agg(["min", lambda x: x.isna().any()])
            low.columns = ["first", "none"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(low.index, pa.int32()),
                    pa.array(low["first"].astype("Int64"), pa.int64()),
                    pa.array(low["none"].astype(bool), pa.bool_()),
                ],
                ["bucket", "first", "none"],
            )

    low = docs.select("doc_id").mapInArrow(firsts, "bucket int, first long, none boolean")
    low = low.groupBy("bucket").agg(F.min("first").alias("first"), F.bool_or("none").alias("none"))
    rows = sorted(low.collect())  # one row for each range of ids
    heads = [None if r["none"] else r["first"] for r in rows]
    looks = {head: rows[i - 1]["bucket"] for i, head in enumerate(heads)}  # the range before the one it heads

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            again = [(i, looks[x]) for i, x in enumerate(ids.to_pylist()) if x in looks]
            own = pa.array(_ranges(ids, splits), pa.int32())
            yield pa.RecordBatch.from_arrays([own, pa.array(np.zeros(len(ids), bool)), *batch.columns], names)
            if again:
                more = batch.take(pa.array([i for i, _ in again]))
                to = pa.array([b for _, b in again], pa.int32())
                yield pa.RecordBatch.from_arrays([to, pa.array(np.ones(len(again), bool)), *more.columns], names)

    names = ["bucket", "copy", "doc_id", "text"]
    dealt = docs.mapInArrow(deal, "bucket int, copy boolean, doc_id long, text string")
    dealt = dealt.repartition(common.partitions(spark), "bucket")
    dealt = dealt.sortWithinPartitions("bucket", "copy", F.asc_nulls_first("doc_id"), "text")
    return dealt.mapInArrow(
        _edit,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _ranges(ids: pa.Array, splits: np.ndarray) -> np.ndarray:
    """The range of each id; a null is in the first."""
    low = np.iinfo(np.int64).min
    return np.searchsorted(splits, ids.fill_null(low).to_numpy(zero_copy_only=False), "right")


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []  # rows that wait for their next document
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text")), strict=True):
            if len(held) > 1 and size > common.CHUNK_BYTES:
                yield _compared(held + [row])
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield _compared(held + [None])


def _compared(rows: list[tuple | None]) -> pa.RecordBatch:
    """Results of all rows but the last, which is there as a next document alone."""
    texts = [r[3] if r else "" for r in rows]
    own = [i for i, r in enumerate(rows[:-1]) if not r[1]]
    edited = []
    for i in own:
        text = texts[i]
        half = len(text) // 2
        edited.append(text[: len(text) - half] + texts[i + 1][:half])
    sig = signatures(pa.array(texts, pa.large_string()))
    other = signatures(pa.array(edited, pa.large_string()))
    here, following = sig[own], sig[[i + 1 for i in own]]
    columns = [
        pa.array([rows[i][2] for i in own], pa.int64()),
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(_hex(here), pa.string()),
        pa.array(_hex(other), pa.string()),
        pa.array((here == other).mean(axis=1), pa.float64()),
        pa.array((here == following).mean(axis=1), pa.float64()),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays(columns, names)
