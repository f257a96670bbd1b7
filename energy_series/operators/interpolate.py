"""Linear interpolation of a counter onto a regular timeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import KEYS
from ..functions import time as t


def interpolate(
    samples: DataFrame,
    start: Column,
    stop: Column,
    value: str = "y",
    epoch: str = "epoch",
    keys: Sequence[str] = KEYS,
    step_seconds: int = t.QUARTER_SECONDS,
) -> DataFrame:
    """Value of each key at ``start, start+step, ...`` before ``stop``.

    ``start`` must be a multiple of the step. Outside the samples the value stays
    flat. Samples are first reduced to the first and last one of each interval
    ``(grid point before, grid point]``, which is all a grid point can see, and
    that reduction is combined before the shuffle. Each interval then produces the
    grid points up to the next one that holds samples.
    """
    x, y = F.col(epoch), F.col(value)
    cells = (
        samples.where(y.isNotNull())
        .groupBy(*keys, F.ceil(x / step_seconds).cast("bigint").alias("_cell"))
        .agg(
            F.min(x).alias("_x_first"),
            F.min_by(y, x).cast("double").alias("_y_first"),
            F.max(x).alias("_x0"),
            F.max_by(y, x).cast("double").alias("_y0"),
        )
    )
    ordered = Window.partitionBy(*keys).orderBy("_cell")
    spans = cells.select(
        *keys,
        "_cell",
        "_x0",
        "_y0",
        "_y_first",
        F.lag("_cell").over(ordered).isNull().alias("_opens"),
        F.lead("_cell").over(ordered).alias("_next_cell"),
        F.lead("_x_first").over(ordered).alias("_x1"),
        F.lead("_y_first").over(ordered).alias("_y1"),
    )
    grid_first = (start / step_seconds).cast("bigint")
    grid_last = F.floor((stop - 1) / step_seconds).cast("bigint")
    low = F.when(F.col("_opens"), grid_first).otherwise(F.greatest(F.col("_cell"), grid_first))
    high = F.least(F.coalesce(F.col("_next_cell") - 1, grid_last), grid_last)
    points = (
        spans.withColumns({"_low": low, "_high": high})
        .where(F.col("_low") <= F.col("_high"))
        .select("*", F.explode(F.sequence("_low", "_high")).alias("_point"))
        .withColumn(epoch, F.col("_point") * step_seconds)
    )
    slope = (F.col("_y1") - F.col("_y0")) / (F.col("_x1") - F.col("_x0"))
    at = (
        F.when(F.col("_point") < F.col("_cell"), F.col("_y_first"))
        .when(F.col("_x1").isNull(), F.col("_y0"))
        .otherwise(slope * (F.col(epoch) - F.col("_x0")) + F.col("_y0"))
    )
    return points.select(*keys, epoch, at.alias(value))


def with_fallback(
    samples: DataFrame,
    sites: DataFrame,
    year: int,
    value: str = "y",
    epoch: str = "epoch",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Give every key of ``sites`` without samples two zero readings a year apart."""
    zeros = (
        sites.select(*keys)
        .distinct()
        .join(samples.select(*keys).distinct(), list(keys), "left_anti")
        .select(
            *keys,
            F.explode(
                F.array(*[t.epoch_seconds(t.wall(f"{y:04d}-01-01")) for y in (year, year + 1)])
            ).alias(epoch),
            F.lit(0).cast(dict(samples.dtypes)[value]).alias(value),
        )
    )
    return samples.select(*keys, epoch, value).unionByName(zeros)
