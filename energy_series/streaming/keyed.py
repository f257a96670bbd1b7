"""Compaction with a clock of its own for each site, in keyed state with timers.

A watermark is one clock for all sites: a site whose clock is fast makes the samples of all
others late. Here every site's buckets, and the newest time that it has sent, are keyed state
that is kept from batch to batch. Each batch gives the rows of the buckets that it touched, so
a sink that replaces rows by key ends up with the compaction of all samples. A bucket leaves the
state once its own site is ``retention`` seconds further; a sample that comes after that is given out
as late, not dropped. A site that has been silent for ``expiry`` seconds of processing time is
forgotten by a timer.

A busy site is dealt to ``SLICES`` groups by its buckets, each with the clock of what it has seen.
The state holds whole numbers: maxima, sums and counts. It needs Spark's RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..columns import COUNTERS, KEYS, TS
from ..functions import time as t
from ..operators import ingest
from ..sources.buckets import BucketTable

# What keyed state needs. Without data no batch is run for timers, or a stream that
# reads what is available would never stop; they fire with the next batch.
NEEDED = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
SLICES = 8
RETENTION = 2 * 86_400
EXPIRY = 7 * 86_400
WRITER = "keyed"
_NONE = -(1 << 63)  # a maximum without any value


@dataclass(frozen=True)
class Compaction:
    """Columns of whole numbers whose maximum counts, and those whose mean does, cast to a type."""

    maxima: Sequence[str]
    means: Sequence[str]
    mean_type: str


METER = Compaction(COUNTERS, ("v1", "frq"), "int")
BATTERY = Compaction((), ("soc", "soh"), "double")


class _Buckets(StatefulProcessor):
    """The open buckets of one group, its clock and its timer."""

    def __init__(self, kind: Compaction, names: Sequence[str], retention: int, expiry: int) -> None:
        self.kind, self.names, self.retention, self.expiry = kind, list(names), retention, expiry
        self.greatest = [f"m_{c}" for c in kind.maxima]
        self.added = [f"{p}_{c}" for c in kind.means for p in "sn"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        values = ", ".join(f"{c} long" for c in (*self.greatest, *self.added))
        self.open = handle.getMapState("open", "bucket long", values)
        self.clock = handle.getValueState("clock", "newest long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        how = {c: "max" for c in ("moment", *self.greatest)} | {c: "sum" for c in self.added}
        batch = pd.concat([r.groupby("bucket", as_index=False).agg(how) for r in rows]).groupby("bucket", as_index=False).agg(how)
        held = self.clock.get()
        clock = max(int(batch["moment"].max()), held[0]) if held else int(batch["moment"].max())
        # What is late is measured by the clock before this batch: its own rows belong together.
        limit = held[0] - self.retention if held else None
        out = []
        for row in batch[["bucket", *self.greatest, *self.added]].itertuples(index=False):
            bucket, values = int(row[0]), [int(x) for x in row[1:]]
            late = limit is not None and bucket < limit
            if not late:
                before = self.open.getValue((bucket,))
                if before is not None:
                    n = len(self.greatest)
                    values = [max(a, b) if i < n else a + b for i, (a, b) in enumerate(zip(values, before, strict=True))]
                self.open.updateValue((bucket,), tuple(values))
            out.append((*key, bucket, late, *values))
        for bucket in [k[0] for k in self.open.keys() if k[0] < clock - self.retention]:
            self.open.removeKey((bucket,))
        self.clock.update((clock,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1000 * self.expiry)
        yield pd.DataFrame(out, columns=self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.open.clear()
        self.clock.clear()
        yield pd.DataFrame([], columns=self.names)

    def close(self) -> None:
        pass


def compact_by_site(
    samples: DataFrame, kind: Compaction, keys: Sequence[str] = KEYS, ts: str = TS, retention: int = RETENTION, expiry: int = EXPIRY
) -> DataFrame:
    """Rows of the five minutes that each batch of a stream touched, and whether they are ``late``.

    A late row sums up the late samples of its batch alone. Samples without key or time belong to no
    row and are left out; ``retention`` and ``expiry`` are seconds.
    """
    whole = [F.coalesce(F.col(c).cast("long"), F.lit(_NONE)).alias(f"m_{c}") for c in kind.maxima]
    for c in kind.means:
        whole += [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(f"s_{c}"), F.col(c).isNotNull().cast("long").alias(f"n_{c}")]
    bucket = ingest.compaction_bucket(ts).alias("_bucket")
    rows = samples.dropna(subset=[*keys, ts]).select("*", bucket)
    rows = rows.select(*keys, t.epoch_seconds("_bucket").alias("bucket"), t.epoch_seconds(ts).alias("moment"), *whole)
    rows = rows.withColumn("_slice", F.expr(f"pmod(bucket div 300, {SLICES})"))

    kinds = [samples.schema[c].dataType.simpleString() for c in keys]
    given = ", ".join(f"{c} {k}" for c, k in zip(keys, kinds, strict=True))
    values = ", ".join(f"{c} long" for c in [*[f"m_{c}" for c in kind.maxima], *[f"{p}_{c}" for c in kind.means for p in "sn"]])
    schema = StructType.fromDDL(f"{given}, _slice long, bucket long, late boolean, {values}")
    touched = rows.groupBy(*keys, "_slice").transformWithStateInPandas(
        _Buckets(kind, schema.names, retention, expiry), schema, "Update", "ProcessingTime"
    )
    start = t.from_epoch("bucket")
    return touched.select(
        *keys,
        start.alias(ts),
        F.col("bucket").alias("sample_epoch"),
        *[F.when(F.col(f"m_{c}") != _NONE, F.col(f"m_{c}")).alias(c) for c in kind.maxima],
        *[F.when(F.col(f"n_{c}") > 0, (F.col(f"s_{c}") / F.col(f"n_{c}")).cast(kind.mean_type)).alias(c) for c in kind.means],
        "late",
    )


def keyed_stream(
    samples: DataFrame,
    kind: Compaction,
    table: BucketTable,
    checkpoint: str,
    retention: int = RETENTION,
    expiry: int = EXPIRY,
) -> StreamingQuery:
    """Samples to five-minute rows in a bucket table, then stop when all is read.

    Late rows go to ``late`` below ``checkpoint``, one folder for each batch; a repeated batch
    replaces its own. Use :mod:`~energy_series.streaming.repair` where they must reach the table.
    """
    work = checkpoint.rstrip("/")
    rows = compact_by_site(samples, kind, table.keys, table.ts, retention, expiry)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            table.upsert(batch.where("NOT late").drop("late"), WRITER, batch_id, unique=True)
            late = batch.where("late").drop("late")
            if not late.isEmpty():
                late.write.mode("overwrite").parquet(f"{work}/late/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = rows.writeStream.outputMode("update").option("checkpointLocation", f"{work}/query")
    conf = samples.sparkSession.conf
    usual = {name: conf.get(name, None) for name in NEEDED}
    try:  # a query keeps the settings that it starts with
        for name, value in NEEDED.items():
            conf.set(name, value)
        return writer.trigger(availableNow=True).foreachBatch(store).start()
    finally:
        for name, value in usual.items():
            conf.unset(name) if value is None else conf.set(name, value)
