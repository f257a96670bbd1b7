"""Sums by quarter hour, hour, day, month and year, kept up by what changes.

Each level is a bucket table. An update compares quarter hours with those that are stored and
stores the ones that differ; of the hours, days, months and years that hold these, the sums are
worked anew from the level below, and no others. Frames of any rule read one level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import energy as e
from ..functions import time as t
from ..operators.grid import densify, label_buckets, resample
from ..sources.buckets import BucketTable
from . import trend

# A level and the period that one part of its table covers; the level above it sums up such parts.
LEVELS = {"15min": "day", "h": "month", "d": "year", "month": "ever", "year": "ever"}
WRITER = "pyramid"
ENERGY = tuple(c for cols in trend.FRAMES.values() for c in cols)
_WHOLE = "decimal(28,0)"  # holds the money of a region's years of quarter hours


@dataclass(frozen=True)
class Pyramid:
    """Sums of ``columns`` by ``keys``, one table for each level below ``path``."""

    spark: SparkSession
    path: str
    columns: Sequence[str]
    keys: Sequence[str] = KEYS
    ts: str = TS
    buckets: int = 64

    def level(self, rule: str) -> BucketTable:
        rule = t.rule_name(rule)
        return BucketTable(self.spark, f"{self.path.rstrip('/')}/{rule}", self.keys, self.ts, LEVELS[rule], self.buckets)

    def update(self, quarters: DataFrame, batch: int) -> int:
        """Store the quarter hours that differ and repair the levels above; how many differed.

        ``quarters`` holds every quarter hour that may have changed, such as all of a site. A batch that
        was cut off is repeated as a whole: levels that have it already are left as they are.
        """
        on, cols = [*self.keys, self.ts], list(self.columns)
        base = self.level("15min")
        quarters = quarters.select(*on, *cols)
        done = base.version_of(WRITER, batch)
        if done is None:
            there = base.read(base.places(quarters), like=quarters).select(*on, F.struct(*cols).alias("_there"))
            found = quarters.join(there, on, "left").where(~F.struct(*cols).eqNullSafe(F.col("_there")))
            done = base.upsert(found.select(*on, *cols), WRITER, batch, unique=True)
        # What the batch changed, from its own files, also when it is repeated.
        changed = base.change(done)
        rows, below = changed.select(*on).persist(), base
        try:
            for rule in list(LEVELS)[1:]:
                upper = self.level(rule)
                spans = rows.select(*self.keys, t.bucket_start(self.ts, rule).alias("_start")).distinct()
                places = below.places(spans, "_start") if rule != "h" else base.places(rows)
                whole = below.read(places).withColumn("_start", t.bucket_start(self.ts, rule))
                whole = whole.join(spans, [*self.keys, "_start"], "left_semi")
                sums = whole.groupBy(*self.keys, "_start").agg(*[self._sum(c, whole).alias(c) for c in cols])
                upper.upsert(sums.withColumnRenamed("_start", self.ts).select(*on, *cols), WRITER, batch, unique=True)
                below = upper
            return rows.count()
        finally:
            rows.unpersist()

    def _sum(self, column: str, rows: DataFrame):
        kind = rows.schema[column].dataType.simpleString()
        return F.sum(column).cast(kind)

    def read(self, rule: str, **window) -> DataFrame:
        """The sums of one level, labelled by the start of their buckets."""
        return self.level(rule).read(**window)


def energy_pyramid(spark: SparkSession, path: str, **options) -> Pyramid:
    """The pyramid of energy and money."""
    return Pyramid(spark, path, ENERGY, **options)


def energy_rows(tables: trend.Tables, keys: Sequence[str] = KEYS, ts: str = TS, **options) -> DataFrame:
    """Quarter hours for :func:`energy_pyramid`, from the stored tables of the sites that changed."""
    quarters = trend.energy_quarters(tables, keys, ts=ts, **options)
    return quarters.select(*keys, ts, *[F.col(c).cast(_WHOLE if c in trend._MONEY else "bigint").alias(c) for c in ENERGY])


def energy_table(pyramid: Pyramid, rule: str) -> DataFrame:
    """The table of :func:`~.trend.trend_table` from one level."""
    rows = pyramid.read(rule)
    shown = [(e.euro(c) if c in trend._MONEY else e.kwh(c)).alias(c) for c in ENERGY]
    return label_buckets(rows.select(*pyramid.keys, pyramid.ts, *shown), rule, pyramid.ts)


def charge_pyramid(spark: SparkSession, path: str, **options) -> Pyramid:
    """The pyramid of the battery's quarter-hour means: their sum and how many there are."""
    return Pyramid(spark, path, ("soc_sum", "soc_n"), **options)


def charge_rows(battery: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Quarter hours for :func:`charge_pyramid`."""
    readings = e.numeric(battery.select(*keys, ts, "soc"), keep=(*keys, ts))
    means = resample(readings, "15min", means=["soc"], keys=keys, ts=ts, dense=False)
    return means.select(*keys, ts, F.col("soc").alias("soc_sum"), F.col("soc").isNotNull().cast("bigint").alias("soc_n"))


def charge_table(pyramid: Pyramid, rule: str) -> DataFrame:
    """The mean of the quarter-hour means from one level, null in buckets without a sample."""
    rows, ts = pyramid.read(rule), pyramid.ts
    means = rows.select(*pyramid.keys, ts, F.expr("soc_sum / nullif(soc_n, 0)").alias("soc"))
    dense = densify(means, rule, null=["soc"], keys=pyramid.keys, ts=ts)
    return label_buckets(dense, rule, ts).withColumn("soc", e.percent("soc"))


def frames(energy: Pyramid, charge: Pyramid, rule: str) -> dict[str, DataFrame]:
    """The result frames of :func:`~.trend.energy_trend`, all from one level."""
    table = energy_table(energy, rule)
    cut = {name: trend.frame_of(table, name, energy.keys, energy.ts) for name in trend.FRAMES}
    return {**cut, "SOC": charge_table(charge, rule)}
