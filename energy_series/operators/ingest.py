"""Raw telegrams to table rows, and compaction to five-minute rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import COUNTERS, KEYS, TS
from ..functions import energy as e
from ..functions import time as t
from .ordered import carry_forward

# Fixed values of the compacted tables.
COMPACT_RULE = "5min"
BACK_SHIFT = "INTERVAL '5' SECOND"
HEALTH = 1000
QUEUE_AHEAD_SECONDS = 900

_READINGS = (*COUNTERS, "ev_voltage", "pv_voltage", "ev_frequency", "pv_frequency")


def meter_readings(telegrams: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Device readings in Wh, V and Hz; a silent device leaves NULLs.

    The EV and PV meters are wired the wrong way round: what they call export
    flows into the home. Outgoing energy is negative.
    """
    return telegrams.select(
        *keys,
        ts,
        e.truncated(F.col("p1.energy_export_kwh"), -1000).alias("exp"),
        e.truncated(F.col("p1.energy_import_kwh"), 1000).alias("imp"),
        e.truncated(F.col("pv.energy_import_kwh"), -1000).alias("gen"),
        e.truncated(F.col("pv.energy_export_kwh"), 1000).alias("gep"),
        e.truncated(F.col("ev.energy_import_kwh"), -1000).alias("evn"),
        e.truncated(F.col("ev.energy_export_kwh"), 1000).alias("evp"),
        F.col("ev.voltage_v").alias("ev_voltage"),
        F.col("pv.voltage_v").alias("pv_voltage"),
        F.col("ev.frequency_hz").alias("ev_frequency"),
        F.col("pv.frequency_hz").alias("pv_frequency"),
    )


def meter_rows(readings: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Readings to ``mains`` rows: tenths of the mean voltage and frequency."""
    return readings.select(
        *keys,
        ts,
        t.epoch_seconds(ts).alias("sample_epoch"),
        *COUNTERS,
        e.truncated(
            e.mean_of_present(F.col("ev_voltage"), F.col("pv_voltage")), 10, "int"
        ).alias("v1"),
        e.truncated(
            e.mean_of_present(F.col("ev_frequency"), F.col("pv_frequency")), 10, "int"
        ).alias("frq"),
    )


def translate_meter(telegrams: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Telegrams to ``mains`` rows; a silent device keeps its last known reading."""
    readings = meter_readings(telegrams, keys, ts)
    return meter_rows(carry_forward(readings, _READINGS, keys, ts), keys, ts)


def translate_battery(telegrams: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """State of charge in centi-percent, the mean of two batteries."""
    first, second = (F.col(f"{b}.sessy.state_of_charge") * F.lit(10000) for b in ("b1", "b2"))
    return telegrams.select(
        *keys,
        ts,
        t.epoch_seconds(ts).alias("sample_epoch"),
        ((first + second) / F.lit(2)).cast("int").alias("soc"),
        F.lit(HEALTH).alias("soh"),
    )


def compaction_bucket(ts: str = TS) -> Column:
    """Five-minute bucket of a sample, moved back so it counts for the period it closes."""
    return t.bucket_start(f"{ts} - {BACK_SHIFT}", COMPACT_RULE)


def meter_aggregates() -> list[Column]:
    return [
        *[F.max(c).alias(c) for c in COUNTERS],
        F.avg("v1").cast("int").alias("v1"),
        F.avg("frq").cast("int").alias("frq"),
    ]


def battery_aggregates() -> list[Column]:
    return [F.avg("soc").alias("soc"), F.avg("soh").alias("soh")]


def _stamped(compacted: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    rest = [c for c in compacted.columns if c not in (*keys, ts)]
    return compacted.select(*keys, ts, t.epoch_seconds(ts).alias("sample_epoch"), *rest)


def compact_meter(samples: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Five-minute ``mains`` rows: highest counter readings, mean voltage and frequency.

    The counters of outgoing energy are negative, so their highest reading is the
    earliest of the bucket.
    """
    grouped = samples.groupBy(*keys, compaction_bucket(ts).alias(ts)).agg(*meter_aggregates())
    return _stamped(grouped, keys, ts)


def compact_battery(samples: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    grouped = samples.groupBy(*keys, compaction_bucket(ts).alias(ts)).agg(*battery_aggregates())
    return _stamped(grouped, keys, ts)


def compaction_remainder(samples: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Samples newer than the newest bucket label of their key: the unfinished bucket."""
    newest = samples.groupBy(*keys).agg(F.max(compaction_bucket(ts)).alias("_newest"))
    # Such samples lie in the five minutes from the label on or start the next ones,
    # so the join is on site and five minutes and a busy site does not meet in one task.
    reach = newest.select(
        *keys,
        "_newest",
        F.expr(f"explode(array(_newest, _newest + {t.step(COMPACT_RULE)}))").alias("_part"),
    )
    return (
        samples.withColumn("_part", t.bucket_start(ts, COMPACT_RULE))
        .join(reach, [*keys, "_part"], "inner")
        .where(t.epoch_seconds(ts) > t.epoch_seconds("_newest"))
        .select(*samples.columns)
    )


def not_in_future(df: DataFrame, as_of, epoch: str = "sample_epoch") -> DataFrame:
    """Keep rows up to and including the running quarter hour."""
    return df.where(F.col(epoch) < t.epoch_seconds(t.wall(as_of)) + QUEUE_AHEAD_SECONDS)
