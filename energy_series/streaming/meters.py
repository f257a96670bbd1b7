"""Meter telegrams to the compacted table in one stream; rows of any age reach it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..columns import KEYS, TS
from ..functions import time as t
from ..operators import ingest
from ..operators.ordered import carry_forward
from ..sources import tables


def meter_pipeline(
    telegrams: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = KEYS, ts: str = TS
) -> StreamingQuery:
    """Telegrams to five-minute ``mains`` rows in the table at ``path``, then stop when all is read.

    The result equals ``compact_meter(translate_meter(all telegrams))`` in whatever order
    they arrive: there is no watermark, and what a silent device keeps is its last reading
    by sample time. Two tables below ``checkpoint`` serve that: ``readings``, the
    telegrams' readings by site and time, and ``known``, the last known reading of each
    device at the end of each day with telegrams. A batch stores its readings, then works
    anew on each site's rows from the five minutes of the site's oldest new telegram on
    (for a batch on time, a day's partition is read) and stores the rows that changed.

    A telegram that repeats a site and time replaces the former. Telegrams without site
    or time are kept apart in ``rejects``. Each batch may be repeated after a crash: what was
    being published is published first, and the rest is computed from the tables.
    """
    work = checkpoint.rstrip("/")
    readings, known, rejects = f"{work}/readings", f"{work}/known", f"{work}/rejects"
    stores = {readings: f"{work}/staging/readings", known: f"{work}/staging/known", path: f"{work}/staging/rows"}
    unkeyed = F.lit(False)
    for c in (*keys, ts):
        unkeyed = unkeyed | F.col(c).isNull()

    def put(rows: DataFrame, into: str, batch_id: int) -> None:
        tables.upsert(rows, into, stores[into], batch_id, keys=[*keys, ts], ts=ts)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for table, staging in stores.items():
            tables.resume(spark, table, staging, batch_id, ts)
        batch.persist()
        try:
            bad = batch.where(unkeyed)
            if not bad.isEmpty():
                bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            fresh = ingest.meter_readings(batch.where(~unkeyed), keys, ts)
            oldest = fresh.agg(F.min(ingest.compaction_bucket(ts))).first()[0]
            if oldest is None:
                return
            put(fresh, readings, batch_id)
            since = fresh.groupBy(*keys).agg(F.min(ingest.compaction_bucket(ts)).alias("_since"))
            filled = _filled(fresh, since, oldest)
            filled.persist()
            try:
                day = t.bucket_start(ts, "d").alias(ts)
                values = [c for c in fresh.columns if c not in (*keys, ts)]
                last = F.max_by(F.struct(*values), F.col(ts)).alias("_row")
                put(filled.groupBy(*keys, day).agg(last).select(*keys, ts, "_row.*"), known, batch_id)
                again = filled.where(ingest.compaction_bucket(ts) >= F.col("_since"))
                rows = ingest.compact_meter(ingest.meter_rows(again, keys, ts), keys, ts)
                put(_changed(rows, oldest), path, batch_id)
            finally:
                filled.unpersist()
        finally:
            batch.unpersist()

    def _filled(fresh: DataFrame, since: DataFrame, oldest) -> DataFrame:
        """Rows of the batch's sites from the day of ``_since`` on, silent devices filled."""
        spark = fresh.sparkSession
        names, values = fresh.columns, [c for c in fresh.columns if c not in (*keys, ts)]
        from_day = t.bucket_start("_since", "d")
        recent = F.col(tables.PARTITION) >= F.lit(oldest.date())
        rows = tables.stored(spark, readings, fresh).where(recent).join(since, list(keys))
        rows = rows.where(F.col(ts) >= from_day).select(*names)
        if tables.exists(spark, known):
            earlier = tables.stored(spark, known, fresh).join(since, list(keys)).where(F.col(ts) < from_day)
            # A seed stands at the start of an earlier day, before every row that it fills.
            rows = rows.unionByName(tables.newest_rows(earlier.select(*names), keys, ts))
        filled = carry_forward(rows, values, keys, ts).join(since, list(keys))
        return filled.where(F.col(ts) >= from_day)

    def _changed(rows: DataFrame, oldest) -> DataFrame:
        spark = rows.sparkSession
        if not tables.exists(spark, path):
            return rows
        dated = F.col(tables.PARTITION) >= F.lit(oldest.date())
        before = tables.stored(spark, path, rows).where(dated).select(*rows.columns)
        return rows.subtract(before)

    return (
        telegrams.writeStream.outputMode("append")
        .option("checkpointLocation", f"{work}/query")
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
