"""First pass: each stored table to a dense quarter-hour series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import COUNTERS, KEYS, MARKET, TS
from ..functions import energy as e
from ..operators.counters import bucket_delta
from ..operators.grid import densify, label_buckets, resample
from ..operators.ordered import carry_forward
from ..functions import time as t


def _in_kwh(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: e.kwh(c) for c in cols})


def _scanned(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str) -> DataFrame:
    return e.numeric(df.select(*keys, ts, *cols), keep=(*keys, ts))


def production_wh(
    df: DataFrame, rule: str = "15min", keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    return resample(_scanned(df, ["solar"], keys, ts), rule, sums=["solar"], keys=keys, ts=ts)


def production_quarters(
    df: DataFrame, rule: str = "15min", keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Solar production in kWh; slots without a sample are 0."""
    return _in_kwh(production_wh(df, rule, keys, ts), ["solar"])


def mains_wh(
    df: DataFrame,
    rule: str = "15min",
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    cols: Sequence[str] = COUNTERS,
    holes: bool = True,
) -> DataFrame:
    return bucket_delta(_scanned(df, cols, keys, ts), cols, rule, keys, ts, holes=holes)


def mains_quarters(
    df: DataFrame,
    rule: str = "15min",
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    cols: Sequence[str] = COUNTERS,
    holes: bool = True,
) -> DataFrame:
    """Energy per slot in kWh from the cumulative meters, without the first slot."""
    return _in_kwh(mains_wh(df, rule, keys, ts, cols, holes), cols)


def battery_quarters(
    df: DataFrame, rule: str = "15min", keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Mean state of charge in %, NULL in slots without a sample."""
    mean = resample(_scanned(df, ["soc"], keys, ts), rule, means=["soc"], keys=keys, ts=ts)
    return mean.withColumn("soc", e.percent("soc"))


def battery_mean_of_means(
    df: DataFrame, rule: str, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Mean of the quarter-hour means, NULL in buckets without a sample.

    Battery rows keep their own grid: they are not joined with the energy series.
    """
    rule = t.rule_name(rule)
    quarters = resample(
        _scanned(df, ["soc"], keys, ts), "15min", means=["soc"], keys=keys, ts=ts, dense=False
    )
    means = quarters.groupBy(*keys, t.bucket_start(ts, rule).alias(ts)).agg(
        F.avg("soc").alias("soc")
    )
    dense = densify(means, rule, null=["soc"], keys=keys, ts=ts)
    return label_buckets(dense, rule, ts).withColumn("soc", e.percent("soc"))


def price_quarters(
    df: DataFrame, rule: str = "15min", keys: Sequence[str] = MARKET, ts: str = TS
) -> DataFrame:
    """Mean price per slot; empty slots repeat the last known price.

    An empty ``rule`` keeps the rows as they are and only fills missing prices.
    """
    rows = _scanned(df, ["price"], keys, ts)
    if not rule:
        return carry_forward(rows, ["price"], keys, ts, slice_rule="d")
    exact = rows.withColumn("price", F.col("price").cast(e.PRICE_TYPE))
    mean = resample(exact, rule, means=["price"], keys=keys, ts=ts, carry_means=True)
    return mean.withColumn("price", F.col("price").cast("double"))
