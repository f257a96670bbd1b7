"""Stored tables: scans, ranges and the keyed upsert.

Tables are parquet folders partitioned by ``sample_date``. Scans always filter
that column next to the time, so partitions are pruned before files are listed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..columns import KEYS, TS
from ..functions import time as t

PARTITION = "sample_date"
MARGIN_HOURS = 2  # fixed value: a window is read two hours wider on both sides
RETENTION_SECONDS = 20 * 366 * 86400  # fixed value: twenty years


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    schema = f"{schemas.TABLES[name]}, {PARTITION} date" if name in schemas.TABLES else None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def between(df: DataFrame, low: str | None, high: str | None, ts: str = TS) -> DataFrame:
    """Closed time range (SQL bounds), repeated on the partition column when there is one."""
    limits = [(">=", low), ("<=", high)]
    tests = [f"{ts} {op} {bound}" for op, bound in limits if bound]
    if PARTITION in df.columns:
        tests += [f"{PARTITION} {op} CAST({bound} AS DATE)" for op, bound in limits if bound]
    return df.where(" AND ".join(tests)) if tests else df


def window_scan(
    df: DataFrame, as_of, hours: int, ts: str = TS, margin_hours: int = MARGIN_HOURS
) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of``, read wider by the margin on both sides."""
    end = t.wall(as_of)
    low = f"{end} - INTERVAL '{int(hours + margin_hours)}' HOUR"
    return between(df, low, f"{end} + INTERVAL '{int(margin_hours)}' HOUR", ts)


def range_scan(
    df: DataFrame,
    as_of,
    period: int,
    timeframe: str,
    from_start_of_year: bool = False,
    include_today: bool = True,
    year: int | None = None,
    ts: str = TS,
    rollover: bool = False,
) -> DataFrame:
    """Rows of the last ``period + 1`` periods (``rollover`` as in :func:`~energy_series.functions.time.periods_before`).

    ``from_start_of_year`` moves the start to January 1. ``include_today=False``
    leaves out the last 24 hours. ``year`` overrides all of it with a calendar
    year, closed on both ends.
    """
    if year is not None:
        return between(df, t.wall(f"{year:04d}-01-01"), t.wall(f"{year + 1:04d}-01-01"), ts)
    low = t.periods_before(as_of, period + 1, timeframe, rollover)
    if from_start_of_year:
        low = f"CAST(trunc(CAST({low} AS DATE), 'year') AS TIMESTAMP_NTZ)"
    high = None if include_today else t.periods_before(as_of, 1, "day")
    return between(df, low, high, ts)


def retained(df: DataFrame, as_of, seconds: int = RETENTION_SECONDS, ts: str = TS) -> DataFrame:
    """Rows young enough to keep when a table is rewritten."""
    return between(df, f"{t.wall(as_of)} - INTERVAL '{int(seconds)}' SECOND", None, ts)


def last_write_wins(
    df: DataFrame, sequence: str, keys: Sequence[str] = (*KEYS, TS)
) -> DataFrame:
    """One row per key, the one with the highest ``sequence``.

    Older copies are discarded before the shuffle, so many copies of one key do
    not meet in one task. The sequence is not part of the result; rows with an equal one
    are told apart by their values, and a row without one loses to any other.
    """
    rest = [c for c in df.columns if c not in (*keys, sequence)]
    order = F.struct(F.col(sequence).isNotNull(), F.col(sequence), F.struct(*rest))
    newest = F.max_by(F.struct(*rest), order).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of this library."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def write_table(df: DataFrame, path: str, ts: str = TS, mode: str = "overwrite") -> None:
    """Write a partitioned table, replacing only the partitions ``df`` has rows for.

    Rows are brought together by date; adaptive execution merges small dates and
    splits large ones, so files get a sensible size whatever a date holds. Within a
    file rows are ordered by site, which lets scans skip row groups.
    """
    dated = df.withColumn(PARTITION, F.col(ts).cast("date"))
    ids = [c for c in df.columns if c.endswith("_id")]
    (
        dated.hint("rebalance", PARTITION)
        .sortWithinPartitions(PARTITION, *ids, ts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table that :func:`upsert` keeps, with the columns of ``like`` and its dates."""
    layout = like.withColumn(PARTITION, F.lit(None).cast("date")).schema
    return spark.read.schema(layout).parquet(path)


def _staged(staging: str, batch: int | str) -> str:
    return f"{staging.rstrip('/')}/batch={batch}"


def resume(spark: SparkSession, path: str, staging: str, batch: int | str, ts: str = TS) -> bool:
    """Publish what a batch staged before it was cut off; False if there is nothing."""
    staged = _staged(staging, batch)
    if not exists(spark, f"{staged}/_SUCCESS"):
        return False
    write_table(spark.read.parquet(staged).drop(PARTITION), path, ts)
    remove(spark, staged)
    return True


def upsert(
    rows: DataFrame,
    path: str,
    staging: str,
    batch: int | str,
    sequence: str | None = None,
    keys: Sequence[str] = (*KEYS, TS),
    ts: str = TS,
) -> None:
    """Insert rows into a table, replacing rows with the same key.

    Only partitions of dates that occur in ``rows`` are read and rewritten; those
    dates, at most one value per calendar day, are listed on the driver so that the
    scan lists no other folder. The merged partitions are first written to
    ``staging/batch=<batch>``; when a crash interrupts the publication, repeating the
    same batch publishes that copy again instead of reading a half-replaced table.
    The copy is removed afterwards. Repeating a finished batch changes nothing.
    Within one batch the highest ``sequence`` wins, and of rows with an equal one or
    without any the one with the greatest values. Rows with a NULL in a key belong to no
    partition and are an error; readers keep them apart as rejects.
    """
    spark = rows.sparkSession
    if resume(spark, path, staging, batch, ts):
        return
    dated = rows.withColumn(PARTITION, F.col(ts).cast("date"))
    unkeyed = F.max(F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys)))
    found = dated.groupBy(PARTITION).agg(unkeyed).collect()
    days = [day for day, _ in found]
    if not days:
        return
    if None in days or any(bad for _, bad in found):
        raise ValueError("rows with a NULL key cannot be stored")
    rest = [c for c in dated.columns if c != sequence]
    if sequence:
        dated = last_write_wins(dated, sequence, keys)
    else:
        dated = last_write_wins(dated.withColumn("_none", F.lit(0)), "_none", keys)
    dated = dated.select(*rest)
    merged = dated
    if exists(spark, path):
        touched = stored(spark, path, dated.drop(PARTITION)).where(F.col(PARTITION).isin(days))
        kept = touched.join(dated.select(*keys), list(keys), "left_anti")
        merged = kept.unionByName(dated)
    merged.write.mode("overwrite").parquet(_staged(staging, batch))
    resume(spark, path, staging, batch, ts)


def create_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Create an empty table of a known layout and return it."""
    empty = spark.createDataFrame([], f"{schemas.TABLES[name]}, {PARTITION} date")
    empty.write.mode("ignore").partitionBy(PARTITION).parquet(path)
    return read_table(spark, name, path)


def write_rows_json(df: DataFrame, path: str) -> None:
    """Dump of fetched rows for inspection."""
    df.write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """Report as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def newest_rows(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """The newest row of each key."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), ts).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


__all__ = [
    "between", "create_table", "exists", "last_write_wins", "newest_rows", "range_scan", "read_table",
    "remove", "resume", "retained", "stored", "upsert", "window_scan", "write_report",
    "write_rows_json", "write_table",
]
