"""Order-dependent operators on raw rows, safe for very long series.

One site may hold a large share of all rows, so nothing here puts a whole site
into one window. Rows are cut into time slices: a window runs inside each
``(keys, slice)``, a small table with one row per slice is combined over the
whole site (its size is bounded by the calendar), and the result is joined back
on ``(keys, slice)``, for which the rows are already partitioned.

The tables are keyed by site and second, so a slice of an hour holds at most
3,600 rows of a site.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import time as t

SLICE = "h"


def _slice_windows(keys: Sequence[str], ts: str):
    inside = Window.partitionBy(*keys, "_slice").orderBy(ts)
    across = Window.partitionBy(*keys).orderBy("_slice")
    return inside, across


def carry_forward(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    slice_rule: str = SLICE,
) -> DataFrame:
    """Replace NULLs by the last known value of the key; leading NULLs stay."""
    rows = df.withColumn("_slice", t.bucket_start(ts, slice_rule))
    inside, across = _slice_windows(keys, ts)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in cols})
    last_known = rows.groupBy(*keys, "_slice").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_in_{c}") for c in cols]
    )
    incoming = last_known.select(
        *keys,
        "_slice",
        *[F.last(f"_in_{c}", ignorenulls=True).over(before).alias(f"_in_{c}") for c in cols],
    )
    return (
        filled.join(incoming, [*keys, "_slice"], "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"_in_{c}")) for c in cols})
        .select(*df.columns)
    )


def row_delta(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    slice_rule: str = SLICE,
) -> DataFrame:
    """Replace counter readings by the step from the row before; the first step is NULL."""
    rows = df.withColumn("_slice", t.bucket_start(ts, slice_rule))
    inside, across = _slice_windows(keys, ts)
    stepped = rows.withColumns(
        {
            "_opens": F.lag(ts).over(inside).isNull(),
            **{f"_before_{c}": F.lag(c).over(inside) for c in cols},
        }
    )
    ends = rows.groupBy(*keys, "_slice").agg(*[F.max_by(c, ts).alias(f"_in_{c}") for c in cols])
    incoming = ends.select(
        *keys, "_slice", *[F.lag(f"_in_{c}").over(across).alias(f"_in_{c}") for c in cols]
    )
    before = {
        c: F.when(F.col("_opens"), F.col(f"_in_{c}")).otherwise(F.col(f"_before_{c}")) for c in cols
    }
    return (
        stepped.join(incoming, [*keys, "_slice"], "left")
        .withColumns({c: F.col(c) - before[c] for c in cols})
        .select(*df.columns)
    )


def running_total(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    slice_rule: str = SLICE,
) -> DataFrame:
    """Replace increments by their running total per key (increments to counters)."""
    rows = df.withColumn("_slice", t.bucket_start(ts, slice_rule))
    inside, across = _slice_windows(keys, ts)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumns({c: F.sum(c).over(upto) for c in cols})
    totals = rows.groupBy(*keys, "_slice").agg(*[F.sum(c).alias(f"_in_{c}") for c in cols])
    incoming = totals.select(
        *keys, "_slice", *[F.sum(f"_in_{c}").over(before).alias(f"_in_{c}") for c in cols]
    )
    return (
        summed.join(incoming, [*keys, "_slice"], "left")
        .withColumns({c: F.col(c) + F.coalesce(F.col(f"_in_{c}"), F.lit(0)) for c in cols})
        .select(*df.columns)
    )
