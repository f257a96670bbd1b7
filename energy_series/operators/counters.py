"""Cumulative counters: deltas per bucket and per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import energy as e
from ..functions import time as t
from .grid import densify, label_buckets
from .ordered import SLICE

_SUB_HOUR = ("1min", "5min", "15min")


def slice_readings(
    df: DataFrame,
    cols: Sequence[str],
    rule: str,
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    holes: bool = True,
) -> DataFrame:
    """One row per key and time slice (``ts`` is its start): the steps inside it, its
    first and its last reading.

    A step between two neighbouring readings counts when both are present, so a
    missing reading loses the step before and the step after it; this needs the
    rows of a slice in order. ``holes=False`` states that no reading is missing:
    then the steps telescope to last - first, rows are combined before the shuffle
    and no raw row is sorted.
    """
    rows = df.withColumn("_slice", t.bucket_start(ts, rule))
    ends = [
        aggregate(c, ts).alias(f"{name}_{c}")
        for name, aggregate in (("_first", F.min_by), ("_last", F.max_by))
        for c in cols
    ]
    if holes:
        inside = Window.partitionBy(*keys, "_slice").orderBy(ts)
        rows = rows.withColumns({f"_step_{c}": F.col(c) - F.lag(c).over(inside) for c in cols})
        steps = [F.sum(f"_step_{c}").alias(f"_in_{c}") for c in cols]
        grouped = rows.groupBy(*keys, "_slice").agg(*steps, *ends)
    else:
        grouped = rows.groupBy(*keys, "_slice").agg(*ends)
        telescoped = {f"_in_{c}": F.col(f"_last_{c}") - F.col(f"_first_{c}") for c in cols}
        grouped = grouped.withColumns(telescoped)
    return grouped.withColumnRenamed("_slice", ts)


def consumption(c: str, came_from: Column) -> Column:
    """Steps inside a slice plus the step from the last reading before it."""
    nothing = F.lit(0)
    step = F.coalesce(F.col(f"_first_{c}") - came_from, nothing)
    return (F.coalesce(F.col(f"_in_{c}"), nothing) + step).alias(c)


def slice_deltas(
    cols: Sequence[str], keys: Sequence[str] = KEYS, ts: str = TS
) -> list[Column]:
    """Consumption per slice, the step from the slice before it included."""
    across = Window.partitionBy(*keys).orderBy(ts)
    return [consumption(c, F.lag(f"_last_{c}").over(across)) for c in cols]


def bucket_delta(
    df: DataFrame,
    cols: Sequence[str],
    rule: str,
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    holes: bool = True,
    drop_first: bool = True,
    dense: bool = True,
) -> DataFrame:
    """Counter readings to consumption per bucket.

    Each step between two neighbouring readings goes to the bucket of the later
    one. Counters that go down give negative steps. ``holes=False`` states that no
    counter is ever NULL and takes the cheaper plan. The first bucket of a key is
    dropped unless it is the only one, as it usually is incomplete.
    """
    rule = t.rule_name(rule)
    slice_rule = rule if rule in _SUB_HOUR else SLICE
    slices = slice_readings(df, cols, slice_rule, keys, ts, holes)
    buckets = slices.select(*keys, ts, *slice_deltas(cols, keys, ts))
    if slice_rule != rule:
        buckets = buckets.groupBy(*keys, t.bucket_start(ts, rule).alias(ts)).agg(
            *[F.sum(c).alias(c) for c in cols]
        )
    if dense:
        buckets = densify(buckets, rule, zero=cols, keys=keys, ts=ts, drop_first=drop_first)
    return label_buckets(buckets, rule, ts)


def _label_groups(df, value, label, keys, ts, aggregate: Column, value_name: str):
    return (
        df.groupBy(*keys, label.alias("label"))
        .agg(aggregate.alias(value_name), F.min(ts).alias("starts"))
        .withColumn(value_name, e.at_least_zero(F.col(value_name)))
    )


def label_delta(
    df: DataFrame, value: str, label: Column, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Last minus first reading of each label, never below zero.

    ``starts`` is the first time of the label and gives the order of the labels.
    """
    spread = F.max_by(value, ts) - F.min_by(value, ts)
    return _label_groups(df, value, label, keys, ts, spread, value)


def label_sum(
    df: DataFrame, value: str, label: Column, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Sum per label without its last sample, never below zero."""
    total = F.sum(value) - F.max_by(value, ts)
    return _label_groups(df, value, label, keys, ts, total, value)
