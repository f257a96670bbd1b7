"""Dense time grids: resampling and timelines.

A series is first aggregated to buckets (partial aggregation before the only
shuffle of raw rows). Everything after that runs on the bucket table, whose size
per site is bounded by the calendar: 35,040 quarter hours a year. Windows over a
whole site are used on bucket tables only, never on raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import time as t


def densify(
    buckets: DataFrame,
    rule: str,
    zero: Sequence[str] = (),
    null: Sequence[str] = (),
    carry: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    drop_first: bool = False,
) -> DataFrame:
    """Add the empty buckets between the first and the last one of each key.

    ``buckets`` holds one row per key and bucket start. Each row produces itself
    and the empty buckets up to its successor, so no grid has to be built and
    joined. Columns in ``zero`` become 0 in an empty bucket, ``null`` become NULL,
    ``carry`` repeat the last value that was present.
    ``drop_first`` removes the first bucket of a key that has more than one.
    """
    ordered = Window.partitionBy(*keys).orderBy(ts)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    looked = buckets.select(
        *keys,
        ts,
        *zero,
        *null,
        *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in carry],
        F.lead(ts).over(ordered).alias("_next"),
        *([F.lag(ts).over(ordered).isNull().alias("_first")] if drop_first else []),
    )
    return fill_slots(looked, rule, zero, null, carry, keys, ts, drop_first)


def fill_slots(
    looked: DataFrame,
    rule: str,
    zero: Sequence[str] = (),
    null: Sequence[str] = (),
    repeat: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    drop_first: bool = False,
) -> DataFrame:
    """Second half of :func:`densify`, for rows that know the ``_next`` bucket of their key."""
    width = t.step(rule)
    upto = f"coalesce(_next - {width}, {ts})"
    slots = looked.select(
        "*", F.expr(f"posexplode(sequence({ts}, {upto}, {width}))").alias("_pos", "_slot")
    )
    if drop_first:
        slots = slots.where(~(F.col("_first") & (F.col("_pos") == 0) & F.col("_next").isNotNull()))
    own = F.col("_pos") == 0
    types = dict(looked.dtypes)
    return slots.select(
        *keys,
        F.col("_slot").alias(ts),
        *[F.when(own, F.col(c)).otherwise(F.lit(0).cast(types[c])).alias(c) for c in zero],
        *[F.when(own, F.col(c)).alias(c) for c in null],
        *repeat,
    )


def label_buckets(df: DataFrame, rule: str, ts: str = TS) -> DataFrame:
    return df.withColumn(ts, t.bucket_label(ts, rule))


def resample(
    df: DataFrame,
    rule: str,
    sums: Sequence[str] = (),
    means: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    carry_means: bool = False,
    dense: bool = True,
) -> DataFrame:
    """Dense resample: an empty bucket sums to 0 and has no mean.

    With ``carry_means`` an empty bucket repeats the last known mean.
    """
    grouped = df.groupBy(*keys, t.bucket_start(ts, rule).alias(ts)).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        *[F.avg(c).alias(c) for c in means],
    )
    if dense:
        filled = {"carry": means} if carry_means else {"null": means}
        grouped = densify(grouped, rule, zero=sums, keys=keys, ts=ts, **filled)
    return label_buckets(grouped, rule, ts)


def timeline_bounds(as_of, period: int, timeframe: str, year: int | None = None):
    """First and one-past-last epoch second of a timeline, as columns.

    A timeline has a step of 15 minutes and ends before ``as_of``, or before the
    end of ``year``.
    """
    end = t.wall(f"{year + 1:04d}-01-01 00:00:00") if year is not None else t.wall(as_of)
    return _bounds(end, period, timeframe)


def _bounds(end: str, period: int, timeframe: str):
    if timeframe not in t.TIMEFRAME_SECONDS:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    stop = t.epoch_seconds(end)
    back = stop - F.lit(t.TIMEFRAME_SECONDS[timeframe] * period)
    return F.floor(back / t.QUARTER_SECONDS) * t.QUARTER_SECONDS, stop


def timeline(
    anchors: DataFrame,
    period: int,
    timeframe: str,
    anchor: str = "latest",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Quarter-hour epochs of a timeline per key that ends before its ``anchor`` time."""
    start, stop = _bounds(anchor, period, timeframe)
    return anchors.select(
        *keys, F.explode(F.sequence(start, stop - 1, F.lit(t.QUARTER_SECONDS))).alias("epoch")
    )
