"""Output shaping: column selection, tails, previews and axis labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import KEYS, TS
from ..functions import time as t


def sorted_columns(df: DataFrame, first: Sequence[str] = (*KEYS, TS)) -> DataFrame:
    """Alphabetical columns after the identifying ones."""
    lead = [c for c in first if c in df.columns]
    return df.select(*lead, *sorted(c for c in df.columns if c not in lead))


def without(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*cols)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def in_time_order(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Global order, for output only."""
    return df.orderBy(*keys, ts)


def preview(df: DataFrame, rows: int = 16) -> DataFrame:
    return df.limit(rows)


def tail(df: DataFrame, periods: int, keys: Sequence[str] = KEYS, order: str = TS) -> DataFrame:
    """The last ``periods`` rows of each key of a bucketed table."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= periods)
        .drop("_rank")
    )


def tick_labels(
    df: DataFrame, fmt: str, ticks: int = 40, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Add ``tick``: formatted time on every k-th row of a bucketed table, else ''.

    ``k`` is chosen per key so that about ``ticks`` labels remain.
    """
    ordered = Window.partitionBy(*keys).orderBy(ts)
    every = F.greatest(
        F.floor(F.count(F.lit(1)).over(Window.partitionBy(*keys)) / ticks), F.lit(1)
    )
    shown = (F.row_number().over(ordered) - 1) % every == 0
    return df.withColumn("tick", F.when(shown, t.strftime(ts, fmt)).otherwise(F.lit("")))
