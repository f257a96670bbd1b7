"""Holes in a series and the requests that fill them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import time as t


def latest_point(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Newest time per key, the high-water mark of an incremental load."""
    return df.groupBy(*keys).agg(F.max(ts).alias("latest"))


def gaps(
    df: DataFrame, rule: str = "15min", keys: Sequence[str] = KEYS, ts: str = TS, as_of=None
) -> DataFrame:
    """Stretches longer than one step of ``rule`` without a sample.

    With ``as_of``, the stretch after the newest sample of a key ends there.

    Two samples in the same step-wide cell cannot be that far apart, so only the
    first and last sample of each cell matter: rows are combined before the shuffle.
    """
    rule = t.rule_name(rule)
    if rule in ("month", "year"):
        raise ValueError("gaps needs a step of fixed length")
    cells = df.groupBy(*keys, t.bucket_start(ts, rule).alias("_cell")).agg(
        F.min(ts).alias("_from"), F.max(ts).alias("gap_start")
    )
    ordered = Window.partitionBy(*keys).orderBy("_cell")
    wide = "(gap_end - gap_start)"
    closing = F.lit(None).cast("timestamp_ntz") if as_of is None else F.expr(t.wall(as_of))
    return (
        cells.select(*keys, "gap_start", F.lead("_from").over(ordered).alias("_next"))
        .select(*keys, "gap_start", F.coalesce("_next", closing).alias("gap_end"))
        .where(f"{wide} > {t.step(rule)}")
        .withColumn("missing", F.expr(f"({wide} - {t.MICROSECOND}) DIV {t.step(rule)}"))
    )


def backfill_plan(
    holes: DataFrame,
    as_of,
    keys: Sequence[str] = KEYS,
    first_lookback_hours: int = 24,
    next_lookback_hours: int = 2,
) -> DataFrame:
    """Request windows that cross each hole.

    Attempt 0 starts at the newest point before the hole and looks back further
    than the rest. While a request ends before the data goes on, the next one
    starts one more day after that point, but never after ``as_of``. A request
    covers whole days, from the day of ``start - lookback`` to the day after ``start``.
    """
    hops = "greatest(datediff(CAST(gap_end AS DATE), CAST(gap_start AS DATE)) - 1, 0)"
    attempts = holes.select(
        *keys, "gap_start", "gap_end", F.expr(f"explode(sequence(0, {hops}))").alias("attempt")
    )
    start = f"least(gap_start + make_dt_interval(attempt), {t.wall(as_of)})"
    lookback = f"IF(attempt = 0, {int(first_lookback_hours)}, {int(next_lookback_hours)})"
    return attempts.withColumn("start_at", F.expr(start)).select(
        *keys,
        "gap_start",
        "gap_end",
        "attempt",
        "start_at",
        t.bucket_start(f"start_at - make_dt_interval(0, {lookback})", "d").alias("request_from"),
        t.bucket_start(f"start_at + {t.step('d')}", "d").alias("request_to"),
    )
