"""Telegrams of any age to five-minute rows; a late one repairs what it changes and no more.

Samples, rungs of own readings (see :mod:`~energy_series.operators.ladder`) and results are
bucket tables. A batch stores its samples and works anew on the days of the sites that they
fall on. Where that changes the last reading of a device on a day, the site's following days
are worked on too, up to the day of that device's next own reading. Each of these days starts
from the readings that the rungs know before it. Clocks play no part: a site whose clock is
years off costs its own days alone, and nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..columns import KEYS, TS
from ..operators import ingest, ladder
from ..sources import tables
from ..sources.buckets import MANY_CHANGES, BucketTable, Places

WRITER = "stream"


@dataclass(frozen=True)
class Kind:
    """What telegrams hold: their samples, the columns whose last value stays known, the five-minute rows."""

    samples: Callable[[DataFrame, Sequence[str], str], DataFrame]
    carried: Sequence[str]
    compacted: Callable[[DataFrame, Sequence[str], str], DataFrame]


METER = Kind(
    ingest.meter_readings,
    ingest._READINGS,
    lambda rows, keys, ts: ingest.compact_meter(ingest.meter_rows(rows, keys, ts), keys, ts),
)
BATTERY = Kind(ingest.translate_battery, (), ingest.compact_battery)


class Repair:
    """The tables of one stream, and what a batch does to them."""

    def __init__(
        self, spark: SparkSession, kind: Kind, path: str, work: str, keys: Sequence[str] = KEYS, ts: str = TS, buckets: int = 64
    ) -> None:
        self.kind, self.keys, self.ts, self.work = kind, list(keys), ts, work.rstrip("/")
        self.held: list[DataFrame] = []
        # A sample counts for the day of the five minutes that it closes.
        self.day = f"CAST({ts} - {ingest.BACK_SHIFT} AS DATE)"

        def table(at: str, period: str, moment: str | None = None) -> BucketTable:
            return BucketTable(spark, at, keys, ts, period, buckets, moment)

        self.samples = table(f"{self.work}/samples", "day", f"{ts} - {ingest.BACK_SHIFT}")
        self.rungs = {
            rule: table(f"{self.work}/rungs-{rule}", period)
            for rule, period in (("d", "month"), ("month", "year"), ("year", "ever"))
        }
        self.rows = table(path, "day")

    def tables(self) -> list[BucketTable]:
        return [self.samples, self.rows, *(self.rungs.values() if self.kind.carried else ())]

    def _held(self, df: DataFrame) -> DataFrame:
        """Kept by the executors while the batch is worked on; lost parts are computed again."""
        self.held.append(df.persist())
        return df

    def store(self, batch: DataFrame, batch_id: int) -> None:
        keys, ts = self.keys, self.ts
        keyed = F.lit(True)
        for c in (*keys, ts):
            keyed = keyed & F.col(c).isNotNull()
        self._held(batch)
        try:
            bad = batch.where(~keyed)
            if not bad.isEmpty():
                bad.write.mode("overwrite").parquet(f"{self.work}/rejects/batch={batch_id}")
            fresh = self.kind.samples(batch.where(keyed), keys, ts)
            if fresh.isEmpty():
                return
            self.samples.upsert(fresh, WRITER, batch_id)
            days = fresh.select(*keys, F.expr(f"CAST({self.day} AS TIMESTAMP_NTZ)").alias(ts)).distinct()
            days = self._held(days)
            places = self.rows.places(days)
            if self.kind.carried:
                days, places = self._climb(days, places, batch_id)
            self.rows.upsert(self._changed(self._worked(days, places), places), WRITER, batch_id, unique=True)
        finally:
            while self.held:
                self.held.pop().unpersist()
        for table in self.tables():
            if table.version() % MANY_CHANGES == 0:
                table.compact()

    def _of(self, days: DataFrame, places: Places) -> DataFrame:
        """The samples of some sites' days."""
        rows = self.samples.read(places)
        on = [*self.keys, "_day"]
        rows = rows.withColumn("_day", F.expr(f"CAST({self.day} AS TIMESTAMP_NTZ)"))
        return rows.join(days.select(*self.keys, F.col(self.ts).alias("_day")), on, "left_semi")

    def _climb(self, days: DataFrame, places: Places, batch_id: int) -> tuple[DataFrame, Places]:
        """Works the rungs of some days anew; these days and those that show the readings changed."""
        keys, ts, cols, on = self.keys, self.ts, self.kind.carried, [*self.keys, self.ts]
        daily = self.rungs["d"]
        now = ladder.rungs(self._of(days, places), cols, "_day", keys, ts)
        done = daily.version_of(WRITER, batch_id)  # a repeated batch compares with what it found at first
        before = daily.version() if done is None else done - 1
        old = daily.read(daily.widened(places), version=before, like=now)
        daily.upsert(now, WRITER, batch_id, unique=True)
        finer = daily
        for rule in ("month", "year"):
            upper = self.rungs[rule]
            spans = days.select(*keys, F.expr(f"CAST(trunc({ts}, '{rule}') AS TIMESTAMP_NTZ)").alias(ts)).distinct()
            # A month's daily rungs are one part of their table, a year's monthly ones too.
            rows = finer.read(finer.widened(places))
            start = F.expr(f"CAST(trunc({ts}, '{rule}') AS TIMESTAMP_NTZ)")
            rows = rows.withColumn("_start", start).join(spans.withColumnRenamed(ts, "_start"), [*keys, "_start"], "left_semi")
            upper.upsert(ladder.wider(rows.drop("_start"), cols, rule, keys, ts), WRITER, batch_id, unique=True)
            finer = upper

        was = old.select(*on, *[F.col(c)["value"].alias(f"_old_{c}") for c in cols])
        now = daily.read(daily.widened(places)).join(days, on, "left_semi").join(was, on, "left")
        after = ladder.next_after(days, self.steps(places), cols, keys, ts)
        ends = after.select(*on, *[F.expr(f"CAST({c} - {ingest.BACK_SHIFT} AS DATE)").alias(f"_next_{c}") for c in cols])
        never = F.lit("9999-12-31").cast("date")
        until = [F.when(~F.col(f"{c}.value").eqNullSafe(F.col(f"_old_{c}")), F.coalesce(F.col(f"_next_{c}"), never)) for c in cols]
        spans = now.join(ends, on).select(*keys, F.col(ts).alias("_from"), F.greatest(F.lit(None).cast("date"), *until).alias("_until"))
        spans = spans.where("_until IS NOT NULL")
        # Only months that a span touches are read for the days after it.
        held = daily.log().where("part IS NOT NULL").select("part", "bucket").distinct()
        reach = spans.select(daily.bucket(), F.trunc("_from", "month").alias("_low"), F.col("_until"))
        months = held.join(reach, "bucket").where("part BETWEEN _low AND _until").select("part", "bucket").distinct()
        months = {tuple(row) for row in months.collect()}
        if not months:
            return days, places
        later = daily.read(months, like=now).select(*on).join(spans, keys)
        later = later.where(f"{ts} > _from AND CAST({ts} AS DATE) <= _until").select(*on)
        worked = self._held(days.unionByName(later).distinct())
        return worked, self.rows.places(worked)

    def steps(self, places: Places) -> dict[str, DataFrame]:
        """The rungs that tell what stands before and after some days: three parts for each bucket and day."""
        return {rule: table.read(table.widened(places)) for rule, table in self.rungs.items()}

    def _worked(self, days: DataFrame, places: Places) -> DataFrame:
        """Five-minute rows of some sites' days."""
        rows, keys, ts = self._of(days, places), self.keys, self.ts
        if self.kind.carried:
            seeds = ladder.known_before(days, self.steps(places), self.kind.carried, keys, ts)
            seeds = seeds.select(*keys, F.col(ts).alias("_day"), *[F.col(c).alias(f"_seed_{c}") for c in self.kind.carried])
            upto = Window.partitionBy(*keys, "_day").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
            rows = rows.join(seeds, [*keys, "_day"], "left")
            shown = {c: F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_seed_{c}")) for c in self.kind.carried}
            rows = rows.withColumns(shown)
        return self.kind.compacted(rows, keys, ts)

    def _changed(self, rows: DataFrame, places: Places) -> DataFrame:
        """Rows that the table does not hold as they are."""
        on = [*self.keys, self.ts]
        rest = [c for c in rows.columns if c not in on]
        there = self.rows.read(places, like=rows).select(*on, F.struct(*rest).alias("_there"))
        found = rows.join(there, on, "left")
        return found.where(~F.struct(*rest).eqNullSafe(F.col("_there"))).select(*rows.columns)


def repair_stream(
    telegrams: DataFrame, kind: Kind, path: str, checkpoint: str, keys: Sequence[str] = KEYS, ts: str = TS, buckets: int = 64
) -> StreamingQuery:
    """Telegrams to the five-minute rows of the bucket table at ``path``, then stop when all is read.

    The result equals the batch translation and compaction of all telegrams, in whatever
    order they arrive; of telegrams with one site and time the last batch's counts. Telegrams without
    site or time are kept apart in ``rejects`` below ``checkpoint``. A batch may be repeated after a
    crash: each table takes it once, and the rest is computed from the tables.
    """
    work = checkpoint.rstrip("/")

    def store(batch: DataFrame, batch_id: int) -> None:
        Repair(batch.sparkSession, kind, path, work, keys, ts, buckets).store(batch, batch_id)

    return (
        telegrams.writeStream.outputMode("append")
        .option("checkpointLocation", f"{work}/query")
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )


def compacted_rows(spark: SparkSession, path: str, keys: Sequence[str] = KEYS, ts: str = TS, buckets: int = 64) -> BucketTable:
    """The table that :func:`repair_stream` keeps at ``path``."""
    return BucketTable(spark, path, keys, ts, "day", buckets)


__all__ = ["BATTERY", "METER", "Kind", "Repair", "compacted_rows", "repair_stream"]
