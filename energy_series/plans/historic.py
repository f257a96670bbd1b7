"""Consumption per label from one interpolated counter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import energy as e
from ..functions import time as t
from ..operators.counters import label_delta, label_sum
from ..operators.grid import timeline_bounds
from ..operators.interpolate import interpolate, with_fallback
from ..operators.shape import tail
from ..sources.tables import range_scan

FALLBACK_YEAR = 2019  # fixed value: year of the zero readings when no year is asked for


def historic_series(
    df: DataFrame,
    counter: str,
    as_of,
    period: int,
    timeframe: str,
    grouping: str,
    year: int | None = None,
    from_start_of_year: bool = False,
    include_today: bool = True,
    dif: bool = True,
    sites: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """The last ``period`` labels of a counter, in thousands.

    The counter is cut to whole units, interpolated onto the quarter-hour
    timeline of the period and grouped by the formatted time. With ``sites`` every
    site listed there gets a series, zero when it has no reading in the range.
    """
    rows = range_scan(df, as_of, period, timeframe, from_start_of_year, include_today, year, ts)
    samples = rows.select(
        *keys, t.epoch_seconds(ts).alias("epoch"), F.col(counter).cast("bigint").alias("y")
    )
    if sites is not None:
        samples = with_fallback(samples, sites, year or FALLBACK_YEAR, keys=keys)
    start, stop = timeline_bounds(as_of, period, timeframe, year)
    points = interpolate(samples, start, stop, keys=keys).withColumn(
        ts, t.from_epoch("epoch")
    )
    grouped = (label_delta if dif else label_sum)(
        points, "y", t.strftime(ts, grouping), keys, ts
    )
    return tail(grouped, period, keys, "starts").withColumn("y", e.kwh("y"))
