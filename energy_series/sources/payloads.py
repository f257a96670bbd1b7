"""Landed JSON payloads to table rows.

Each reader takes a DataFrame whose payload is already parsed (``spark.read.json``
or ``readStream.json`` with a schema of :mod:`energy_series.schemas`) or a text
column to parse. Items that cannot be used are kept apart, not dropped silently.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..columns import KEYS, MARKET, TS
from ..functions import energy as e
from ..functions import time as t

PAYLOADS = {
    "prices": schemas.PRICE_PAYLOAD,
    "solar": schemas.SOLAR_PAYLOAD,
    "meter": schemas.METER_TELEGRAM,
    "battery": schemas.BATTERY_TELEGRAM,
    "charger": schemas.CHARGER_MINUTES,
}

# Joules in a kWh, and seconds that turn a minute total into watts.
JOULE_PER_KWH = 3_600_000
SECONDS_PER_MINUTE = 60


def read_json(spark: SparkSession, kind: str, path: str, whole_files: bool = False) -> DataFrame:
    """Batch read of landed files; ``whole_files`` when one file is one document."""
    reader = spark.read.schema(_with_keys(kind)).option("multiLine", whole_files)
    return reader.json(path)


def stream_json(spark: SparkSession, kind: str, path: str, whole_files: bool = False) -> DataFrame:
    """Streaming read of a landing folder."""
    reader = spark.readStream.schema(_with_keys(kind)).option("multiLine", whole_files)
    return reader.json(path)


def _with_keys(kind: str) -> str:
    key = {"prices": "market_id string, ", "solar": "site_id string, "}.get(kind, "")
    return key + PAYLOADS[kind]


def parsed(df: DataFrame, kind: str, text: str = "payload") -> DataFrame:
    """Parse a text column and replace it by the fields of the payload."""
    doc = F.from_json(text, PAYLOADS[kind]).alias("_doc")
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, doc).select(*rest, "_doc.*")


def _both_days() -> Column:
    """The items of today and tomorrow in a price document."""
    info = F.get("data.viewer.homes", F.lit(0))["currentSubscription"]["priceInfo"]
    nothing = F.expr("CAST(array() AS array<struct<startsAt: string, total: string>>)")
    return F.concat(F.coalesce(info["today"], nothing), F.coalesce(info["tomorrow"], nothing))


def price_document_rejects(payloads: DataFrame, keys: Sequence[str] = MARKET) -> DataFrame:
    """The documents without any item, such as those that could not be parsed, for a quarantine table."""
    return payloads.where(F.size(_both_days()) == 0).select(*keys)


def _price_items(payloads: DataFrame, keys: Sequence[str]) -> DataFrame:
    items = payloads.select(*keys, F.explode(_both_days()).alias("item"))
    return items.select(
        *keys,
        F.col("item.startsAt").alias("starts_at"),
        F.col("item.total").alias("total"),
        t.parse_wall("item.startsAt").alias(TS),
        F.nanvl(F.col("item.total").try_cast("double"), F.lit(None)).alias("price"),
    )


def _usable_price() -> Column:
    return F.col(TS).isNotNull() & F.col("price").isNotNull()


def price_rows(payloads: DataFrame, keys: Sequence[str] = MARKET) -> DataFrame:
    """``prices`` rows from price documents: today and tomorrow, usable items only."""
    return (
        _price_items(payloads, keys)
        .where(_usable_price())
        .select(*keys, TS, t.epoch_seconds(TS).alias("sample_epoch"), "price")
    )


def price_rejects(payloads: DataFrame, keys: Sequence[str] = MARKET) -> DataFrame:
    """The items :func:`price_rows` leaves out, for a quarantine table; documents without
    items are :func:`price_document_rejects`."""
    return _price_items(payloads, keys).where(~_usable_price()).select(*keys, "starts_at", "total")


def solar_rows(payloads: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``production`` rows from solar documents; a missing value is 0 Wh."""
    items = _solar_items(payloads, keys).where(F.col(TS).isNotNull())
    return items.select(
        *keys, TS, t.epoch_seconds(TS).alias("sample_epoch"), value_or_zero("value").alias("solar")
    )


def value_or_zero(text: str) -> Column:
    """Whole number of a text; absent, unreadable or not a number is 0."""
    return F.coalesce(F.nanvl(F.col(text).try_cast("double"), F.lit(0.0)), F.lit(0.0)).try_cast("bigint")


def _solar_items(payloads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items of solar documents; a document without items is one item without fields."""
    items = payloads.select(*keys, F.explode_outer("energy.values").alias("item"))
    return items.select(
        *keys,
        F.col("item.date").alias("date"),
        F.col("item.value").alias("value"),
        t.parse_wall("item.date").alias(TS),
    )


def solar_rejects(payloads: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The items and whole documents :func:`solar_rows` leaves out, for a quarantine table."""
    return _solar_items(payloads, keys).where(F.col(TS).isNull()).select(*keys, "date", "value")


# Why an item is not a row.
NO_ITEMS, NO_TIME, NO_AMOUNT = "no items", "no time", "no amount"


def dealt(payloads: DataFrame, kind: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every item of price or solar documents, and every document without items, in one scan.

    ``opens`` marks the first entry of a document, ``reason`` says why an entry is a reject and is null
    for a row; ``date`` and ``amount`` are the texts, ``value`` is the price or the Wh of a row.
    """
    items = {"prices": _both_days(), "solar": F.col("energy.values")}[kind]
    entries = payloads.select(*keys, F.posexplode_outer(items).alias("_pos", "item"))
    when, what = {"prices": ("startsAt", "total"), "solar": ("date", "value")}[kind]
    entries = entries.select(
        *keys,
        F.coalesce(F.col("_pos") == 0, F.lit(True)).alias("opens"),
        F.col("_pos").isNull().alias("_none"),
        F.col(f"item.{when}").alias("date"),
        F.col(f"item.{what}").alias("amount"),
        t.parse_wall(f"item.{when}").alias(TS),
    )
    if kind == "prices":
        value, unusable = F.nanvl(F.col("amount").try_cast("double"), F.lit(None)), F.col("value").isNull()
    else:
        value, unusable = value_or_zero("amount").cast("double"), F.lit(False)
    reason = F.when(F.col("_none"), NO_ITEMS).when(F.col(TS).isNull(), NO_TIME).when(unusable, NO_AMOUNT)
    return entries.withColumn("value", value).withColumn("reason", reason).drop("_none")


def counts() -> list[Column]:
    """Documents, items, rows and rejects by reason of :func:`dealt` entries; whatever comes in is a
    row or a reject: ``n_items + n_no_items = n_rows + n_no_items + n_no_time + n_no_amount``."""

    def number(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    reason = F.col("reason")
    return [
        number(F.col("opens"), "n_documents"),
        number(~reason.eqNullSafe(F.lit(NO_ITEMS)), "n_items"),
        number(reason.isNull(), "n_rows"),
        *[number(reason == r, f"n_{r.replace(' ', '_')}") for r in (NO_ITEMS, NO_TIME, NO_AMOUNT)],
    ]


def land(payloads: DataFrame, kind: str, path: str, keys: Sequence[str] = KEYS) -> dict[str, int]:
    """Write rows and rejects of documents below ``path`` in one scan, and count them on the way.

    The folders ``rejected=false`` and ``rejected=true`` hold the entries of :func:`dealt`; the counts are
    observed while they are written, so they are those of what was written.
    """
    seen = Observation(f"land-{uuid.uuid4().hex}")
    entries = dealt(payloads, kind, keys).withColumn("rejected", F.col("reason").isNotNull())
    entries.observe(seen, *counts()).write.mode("overwrite").partitionBy("rejected").parquet(path)
    return dict(seen.get)


def _charger_time() -> Column:
    """The minute of a total; NULL where its date does not exist."""
    zero = F.lit(0)
    return F.call_function(
        "try_make_timestamp_ntz",
        "yr", "mon", "dom", F.coalesce("hr", zero), F.coalesce("min", zero), zero,
    )


def charger_rejects(totals: DataFrame) -> DataFrame:
    """The documents :func:`charger_rows` leaves out, for a quarantine table."""
    return totals.where(_charger_time().isNull())


def charger_rows(totals: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Charger minute totals in joule to kWh and mean watt; absent hour or minute is 0."""
    energy = ("exp", "imp", "gen", "gep", "h1b", "h1d")
    at = _charger_time()
    return totals.where(at.isNotNull()).select(
        *keys,
        at.alias(TS),
        *[(F.col(c) / JOULE_PER_KWH).alias(f"{c}_kwh") for c in energy],
        *[(F.col(c) / SECONDS_PER_MINUTE).alias(f"{c}_w") for c in energy],
        e.scaled("v1", 0.1).alias("volt"),
        e.scaled("frq", 0.01).alias("hertz"),
    )
