"""Token ids in binary files of patched frame-of-reference blocks (``pfor``).

Documents are dealt to ranges of ascending doc_id, encoded there in that order, and
written as files of about a million ids, each the ``data`` of a row of a Parquet table
with its place in the order (``part``, ``file``) and the doc_ids. Every document ends with an
end id. Reading gives every document's place in the sequence of all ids: sums of the
ranges' totals before it, of the files' within its range, and of the documents' within
its file.

The tokenizers library encodes each distinct pre-token of a partition once; texts are
put together from those ids, which equals encoding them whole. Strings of special tokens
inside a text are those tokens, as the library's default has it.

Defined cases: a null text is empty and has the end id alone; texts are encoded whole, and
a document is never cut between files; rows that repeat a doc_id follow each other in the
order of their texts; null ids come first; other columns are not read; an empty table
gives an empty table.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import bpe, common, pfor, pretokens

VOCABULARY = "byte_bpe_50k.json"
END = 2
FILE_IDS = 1 << 20
CHUNK_BYTES = 1 << 21
FILES = "part int, file int, n_ids long, n_docs long, doc_ids array<long>, data binary"


class Encoder:
    """Encodes texts and remembers the ids of their pre-tokens."""

    def __init__(self, file: str, end: int | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        self.vocabulary = bpe.vocabulary(file)
        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = self.vocabulary.added
        self.mark, self.mark_id = next(iter(self.added.items()))
        self.end = [] if end is None else [end]
        self.ids = pretokens.Ragged(np.uint32)
        self.memory = pretokens.Memory(self._learn, self.ids.clear)

    def _learn(self, words: list[str]) -> None:
        """Encodes many words in one call, parted by an added token, which cuts any text."""
        groups = [self.mark.join(words[i : i + 256]) for i in range(0, len(words), 256)]
        found = [e.ids for e in self.library.encode_batch_fast(groups, add_special_tokens=False)]
        ids = np.concatenate([np.array([*x, self.mark_id], np.uint32) for x in found])
        ends = np.flatnonzero(ids == self.mark_id)
        self.ids.add(ids[ids != self.mark_id], np.diff(ends, prepend=-1) - 1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        pieces, added = self.vocabulary.plain(texts)
        cut = pretokens.Cut([p for p, _ in pieces], True)
        ids, n = self.ids.gather(self.memory.number(cut))
        n = pretokens.sums(n, cut.counts)
        ends = np.cumsum(n)
        owner = np.array([i for _, i in pieces], np.int64)
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        where, what = [], []  # what follows each piece: an added token, or a text's end
        marks = iter(added)
        for end, closes in zip(ends.tolist(), last.tolist(), strict=True):
            more = self.end if closes else [self.added[next(marks)[0]]]
            where += [end] * len(more)
            what += more
        length = np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64)
        np.add.at(length, np.array([i for _, i in added], np.int64), 1)
        return np.insert(ids, where, np.array(what, np.uint32)), length + len(self.end)


@cache
def _encoder(file: str, end: int | None) -> Encoder:
    """One for each worker, whose tasks share what it remembers."""
    return Encoder(file, end)


def write_files(
    df: DataFrame, path: str, text: str = "text", key: str = "doc_id", file: str | None = None, end: int | None = END
) -> None:
    """Writes the token files of ``df`` to the folder ``path``."""
    file = file or bpe.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, end)
        part, number = TaskContext.get().partitionId(), 0
        keys: list = []
        held: list[np.ndarray] = []
        sizes: list[int] = []

        def made() -> pa.RecordBatch:
            data = pfor.encode(np.concatenate(held), np.array(sizes, np.int64))
            row = [[part], [number], [sum(sizes)], [len(keys)], [keys], [data]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array(v, t) for v, t in zip(row, types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["part", "file", "n_ids", "n_docs", "doc_ids", "data"])

        for batch in batches:
            for some in common.chunks(batch, "text", CHUNK_BYTES):
                ids, n = encoder.encode(some.column("text").to_pylist())
                if keys and sum(sizes) + len(ids) > FILE_IDS:
                    yield made()
                    number, keys, held, sizes = number + 1, [], [], []
                keys += some.column("key").to_pylist()
                held.append(ids)
                sizes += n.tolist()
        if keys:
            yield made()

    docs = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = common.partitions(df.sparkSession)
    dealt = docs.repartitionByRange(n, F.asc_nulls_first("key")).sortWithinPartitions(F.asc_nulls_first("key"), "text")
    dealt.mapInArrow(run, FILES).write.option("compression", "zstd").parquet(path)


def read_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids`` of every document
    of the files in ``path``."""
    files = spark.read.schema(FILES).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column("data")[i].as_py()
                n = pfor.lengths(data)
                ends = np.cumsum(n)
                everything = pfor.read(data)
                cut = [everything[e - k : e] for e, k in zip(ends, n, strict=True)]
                place = [np.repeat(batch.column(c)[i].as_py(), len(n)) for c in ("part", "file")]
                columns = [
                    pa.array(place[0], pa.int32()),
                    pa.array(place[1], pa.int32()),
                    pa.array(batch.column("doc_ids")[i].as_py(), pa.int64()),
                    pa.array(ends - n, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([zlib.crc32(c.astype("<u4").tobytes()) for c in cut], pa.int64()),
                ]
                if ids:
                    columns.append(pa.array([c.astype(np.int32) for c in cut], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["part", "file", "doc_id", "within", "n_tokens", "ids_crc32"] + ["ids"] * ids
    kinds = "part int, file int, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    docs = files.select("part", "file", "doc_ids", "data").mapInArrow(run, kinds)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("total"))  # one row for each range
    parts = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    order = Window.partitionBy("part").orderBy("file")
    here = files.select("part", "file", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("inside"))
    placed = here.join(parts, "part").select("part", "file", (F.col("before") + F.col("inside")).alias("offset"))
    out = docs.join(placed, ["part", "file"])
    return out.select("doc_id", (F.col("offset") + F.col("within")).alias("start"), *names[4:])


def token_files(df: DataFrame, **options) -> DataFrame:
    """Writes the files to a new folder of the shared one and reads them back."""
    path = f"{common.shared_folder(df.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_files(df, path, **options)
    return read_files(df.sparkSession, path, ids=False)
