"""Spot price classification per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import MARKET, TS
from ..functions import energy as e
from ..functions import time as t

BANDS = ("past", "low", "high", "lowest", "highest")


def day_limit(mean: Column, middle: Column, median: bool = False, minimum: bool = False) -> Column:
    """Price limit of a day: its mean, its median, or the smaller of the two."""
    mean, middle = mean.cast("double"), middle.cast("double")
    if minimum:
        return F.when(mean < middle, mean).otherwise(middle)
    return middle if median else mean


def daily_statistics(
    df: DataFrame, price: str = "price", keys: Sequence[str] = MARKET, ts: str = TS
) -> DataFrame:
    """Mean and median price of each day."""
    return df.groupBy(*keys, t.bucket_start(ts, "d").alias("day")).agg(
        F.avg(F.col(price).cast(e.PRICE_TYPE)).cast("double").alias("mean_price"),
        F.median(F.col(price).cast("double")).alias("median_price"),
    )


def price_bands(
    df: DataFrame,
    as_of,
    lowq: int = 18,
    highq: int = 18,
    median: bool = False,
    minimum: bool = False,
    price: str = "price",
    keys: Sequence[str] = MARKET,
    ts: str = TS,
) -> DataFrame:
    """Split prices into past, low, high, the N lowest and the N highest of the day.

    Prices before ``as_of`` are past and in no other band. The others are low up to
    the day limit (inclusive) or high above it, unless they are among the ``lowq``
    cheapest or ``highq`` dearest slots of their whole day; of equal prices the
    earliest slot is taken. A short day can have a slot in both selections.
    All windows share one partitioning, a day of one market.
    """
    day = [*keys, "_day"]
    whole = Window.partitionBy(*day)
    cheap = Window.partitionBy(*day).orderBy(F.col(price).asc_nulls_last(), F.col(ts))
    dear = Window.partitionBy(*day).orderBy(F.col(price).desc_nulls_last(), F.col(ts))
    value = F.col(price).cast("double")
    limit = day_limit(
        F.avg(F.col(price).cast(e.PRICE_TYPE)).over(whole),
        F.median(value).over(whole) if median or minimum else F.lit(None),
        median,
        minimum,
    )
    flagged = df.withColumn("_day", t.bucket_start(ts, "d")).select(
        *keys,
        ts,
        value.alias("_price"),
        limit.alias("_limit"),
        (F.row_number().over(cheap) <= lowq).alias("_cheap"),
        (F.row_number().over(dear) <= highq).alias("_dear"),
    )
    p = F.col("_price")
    ahead = F.expr(f"{ts} >= {t.wall(as_of)}")
    plain = ahead & ~F.col("_cheap") & ~F.col("_dear")
    return flagged.select(
        *keys,
        ts,
        F.when(~ahead, p).alias("past"),
        F.when(plain & (p <= F.col("_limit")), p).alias("low"),
        F.when(plain & (p > F.col("_limit")), p).alias("high"),
        F.when(ahead & F.col("_cheap"), p).alias("lowest"),
        F.when(ahead & F.col("_dear"), p).alias("highest"),
    )
