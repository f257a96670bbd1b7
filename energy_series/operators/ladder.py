"""Last and next own readings of any moment, from a few summary rows.

A rung sums up a key's readings over a day, a month or a year: for each column the first and
the last time with a reading and the last reading itself. What a column shows before a day
is the last reading among the rungs of earlier days of its month, earlier months of its year and
earlier years, at most 30 + 11 rows and one for each year; the next reading is found in the
rungs after it in the same way. Rungs hold own readings only, nothing that was carried, so a
late row changes the rung of its own day, month and year and no other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import time as t

RULES = ("d", "month", "year")
_WIDER = {"d": "month", "month": "year"}


def rungs(readings: DataFrame, cols: Sequence[str], day: str, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """One row for each key and day (an SQL expression of type DATE), ``ts`` its first instant."""

    def summed(c: str) -> Column:
        own = F.when(F.col(c).isNotNull(), F.col(ts))
        return F.struct(F.min(own).alias("first"), F.max(own).alias("last"), F.max_by(c, own).alias("value")).alias(c)

    start = F.expr(f"CAST({day} AS TIMESTAMP_NTZ)").alias("_day")
    return readings.groupBy(*keys, start).agg(*[summed(c) for c in cols]).withColumnRenamed("_day", ts)


def wider(finer: DataFrame, cols: Sequence[str], rule: str, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """The rungs of months or years from those of days or months."""

    def summed(c: str) -> Column:
        return F.struct(
            F.min(f"{c}.first").alias("first"), F.max(f"{c}.last").alias("last"), F.max_by(f"{c}.value", f"{c}.last").alias("value")
        ).alias(c)

    start = t.bucket_start(ts, rule).alias("_start")
    return finer.groupBy(*keys, start).agg(*[summed(c) for c in cols]).withColumnRenamed("_start", ts)


def _beside(points: DataFrame, steps: dict[str, DataFrame], later: bool, keys: Sequence[str], ts: str) -> DataFrame:
    """The points with each rung that lies on one side of them and in their next wider period."""
    found = None
    for rule in RULES:
        rung = steps[rule].withColumnRenamed(ts, "_at")
        on = [*keys]
        mine = points.withColumn("_own", t.bucket_start(ts, rule))
        if rule in _WIDER:
            mine = mine.withColumn("_in", t.bucket_start(ts, _WIDER[rule]))
            rung = rung.withColumn("_in", t.bucket_start("_at", _WIDER[rule]))
            on.append("_in")
        side = F.col("_at") > F.col("_own") if later else F.col("_at") < F.col("_own")
        some = mine.join(rung, on).where(side).drop("_own", "_in", "_at")
        found = some if found is None else found.unionByName(some)
    return found


def known_before(points: DataFrame, steps: dict[str, DataFrame], cols: Sequence[str], keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """The last reading of each column before the days ``ts`` of ``points``; ``steps`` holds the rungs by rule."""
    points = points.select(*keys, ts)
    beside = _beside(points, steps, False, keys, ts).groupBy(*keys, ts)
    last = beside.agg(*[F.max_by(f"{c}.value", f"{c}.last").alias(c) for c in cols])
    return points.join(last, [*keys, ts], "left")


def next_after(points: DataFrame, steps: dict[str, DataFrame], cols: Sequence[str], keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """The time of the next own reading of each column after the days ``ts`` of ``points``."""
    points = points.select(*keys, ts)
    first = _beside(points, steps, True, keys, ts).groupBy(*keys, ts).agg(*[F.min(f"{c}.first").alias(c) for c in cols])
    return points.join(first, [*keys, ts], "left")
