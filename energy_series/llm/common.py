"""Tables, the shared folder, and batches of text for the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares; on one machine without that setting, a new one."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a new table in the shared folder: computed once, whichever executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield batch.slice(start)
