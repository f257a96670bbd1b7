"""Streaming ingest: compaction, last known values and idempotent upserts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..columns import KEYS, TS
from ..functions import time as t
from ..operators import ingest
from ..operators.ordered import carry_forward
from ..sources import tables

WATERMARK = "10 minutes"


def shared_folder(spark: SparkSession, name: str) -> str:
    """New folder below the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used in local mode only, when nothing is named.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="energy_series-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _compacted(
    samples: DataFrame, aggregates: list[Column], keys: Sequence[str], ts: str, watermark: str
) -> DataFrame:
    instant = samples.withColumn(ts, t.wall_to_instant(f"{ts} - {ingest.BACK_SHIFT}"))
    grouped = (
        instant.withWatermark(ts, watermark)
        .groupBy(*keys, F.window(ts, "5 minutes").alias("_window"))
        .agg(*aggregates)
    )
    values = [c for c in grouped.columns if c not in (*keys, "_window")]
    return grouped.select(*keys, t.instant_to_wall("_window.start").alias(ts), *values).select(
        *keys, ts, t.epoch_seconds(ts).alias("sample_epoch"), *values
    )


def compact_meter_stream(
    samples: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS, watermark: str = WATERMARK
) -> DataFrame:
    """Five-minute ``mains`` rows from a stream of samples.

    Unfinished buckets stay in the state store until the watermark passes them;
    samples that arrive after that are dropped.
    """
    return _compacted(samples, ingest.meter_aggregates(), keys, ts, watermark)


def compact_battery_stream(
    samples: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS, watermark: str = WATERMARK
) -> DataFrame:
    return _compacted(samples, ingest.battery_aggregates(), keys, ts, watermark)


def upsert_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "update",
    sequence: str | None = None,
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
    keys: Sequence[str] = (*KEYS, TS),
    ts: str = TS,
) -> StreamingQuery:
    """Upsert every micro-batch into a table, then stop when the input is read.

    The checkpoint remembers what has been read, and a batch that is repeated after
    a crash replaces its own rows, so re-delivery changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        shaped = transform(batch, batch_id) if transform else batch
        # A batch is used more than once below; it is read from the source only once.
        shaped.persist()
        try:
            tables.upsert(shaped, path, f"{checkpoint}/staging", batch_id, sequence, keys, ts)
        finally:
            shaped.unpersist()

    return (
        rows.writeStream.outputMode(output_mode)
        .option("checkpointLocation", f"{checkpoint}/query")
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )


class LastKnown:
    """Carries the last known device readings of each site from batch to batch.

    The state is a table with one row per site, written anew for each batch before
    the rows of the batch are: a repeated batch starts from the same state. The
    state of the batch before last is removed. Use it as ``transform`` of
    :func:`upsert_stream` on a stream of meter telegrams.
    """

    def __init__(self, spark: SparkSession, state: str, keys: Sequence[str] = KEYS, ts: str = TS):
        self.spark, self.state, self.keys, self.ts = spark, state.rstrip("/"), keys, ts

    def _path(self, batch_id: int) -> str:
        return f"{self.state}/batch={batch_id}"

    def __call__(self, telegrams: DataFrame, batch_id: int) -> DataFrame:
        fresh = ingest.meter_readings(telegrams, self.keys, self.ts)
        before = self._path(batch_id - 1)
        known = self.spark.read.schema(fresh.schema).parquet(before) if batch_id else None
        rows = fresh.withColumn("_fresh", F.lit(True))
        if known is not None:
            rows = rows.unionByName(known.withColumn("_fresh", F.lit(False)))
        values = [c for c in fresh.columns if c not in (*self.keys, self.ts)]
        filled = carry_forward(rows, values, self.keys, self.ts)
        newest = tables.newest_rows(filled.select(*fresh.columns), self.keys, self.ts)
        newest.write.mode("overwrite").parquet(self._path(batch_id))
        if batch_id > 1:
            tables.remove(self.spark, self._path(batch_id - 2))
        return ingest.meter_rows(filled.where("_fresh"), self.keys, self.ts)


def land_to_table(
    payloads: DataFrame,
    to_rows: Callable[[DataFrame, Sequence[str]], DataFrame],
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str = TS,
) -> StreamingQuery:
    """Incremental load of landed price or solar documents into their table.

    ``to_rows`` is :func:`~energy_series.sources.payloads.price_rows` or
    ``solar_rows``. When documents of one batch overlap, the one that landed last
    (by file time, then name) wins.
    """
    landed = F.struct("_metadata.file_modification_time", "_metadata.file_name")
    rows = to_rows(payloads.withColumn("_landed", landed), [*keys, "_landed"])
    return upsert_stream(rows, path, checkpoint, "append", "_landed", None, [*keys, ts], ts)
