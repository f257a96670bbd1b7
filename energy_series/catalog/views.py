"""The domain tables, derived from the star-schema and event test tables.

``events`` plays the meters of eight sites on two markets, ``orders`` the two
tariffs, ``lineitem`` long counters. Every view reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import COUNTERS, TS
from ..functions import energy as e
from ..functions import time as t
from ..operators.ordered import running_total
from ..plans.trend import Tables

# Market of a site.
MARKET_OF_SITE = "CASE WHEN site_id < '4' THEN 'NL' ELSE 'BE' END"


SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def with_site(events: DataFrame) -> DataFrame:
    return events.select(
        (F.col("user_id") % 8).cast("string").alias("site_id"),
        F.col("ts").alias(TS),
        F.col("event_type").alias("kind"),
        F.col("event_id").alias("id"),
        "value",
        F.round(F.col("value") * 100).cast("bigint").alias("wh"),
    )


def site_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_site(read(spark, sf_dir, "events"))


def _when(kind: str, sign: int = 1):
    return F.when(F.col("kind") == kind, F.col("wh") * sign).otherwise(F.lit(0))


def mains_increments(events: DataFrame) -> DataFrame:
    return events.select(
        "site_id",
        TS,
        _when("purchase", -1).alias("exp"),
        _when("click").alias("imp"),
        _when("error", -1).alias("gen"),
        _when("view").alias("gep"),
        _when("signup", -1).alias("evn"),
        F.when((F.col("kind") == "signup") & (F.col("id") % 3 == 0), F.col("wh"))
        .otherwise(F.lit(0))
        .alias("evp"),
        (2200 + F.col("id") % 100).cast("int").alias("v1"),
        (500 + F.col("id") % 5).cast("int").alias("frq"),
    )


def mains(events: DataFrame, cols=COUNTERS) -> DataFrame:
    """Cumulative meters; only the counters in ``cols`` are accumulated."""
    return running_total(mains_increments(events).select("site_id", TS, *cols), cols)


def production(events: DataFrame) -> DataFrame:
    ev = events.where("kind = 'view'")
    return ev.select("site_id", TS, (F.col("wh") * (1 + F.col("id") % 2)).alias("solar"))


def prices(events: DataFrame) -> DataFrame:
    """One price per market and quarter hour that has an event."""
    market = F.expr(MARKET_OF_SITE).alias("market_id")
    price = (F.max("value") / 1000).cast("decimal(9,5)").cast("double")
    return events.groupBy(market, t.bucket_start(TS, "15min").alias(TS)).agg(price.alias("price"))


def sites(events: DataFrame) -> DataFrame:
    """The market of each site."""
    return events.select("site_id", F.expr(MARKET_OF_SITE).alias("market_id")).distinct()


def battery(events: DataFrame, *more: str) -> DataFrame:
    ev = events.where("kind = 'error'")
    return ev.select(
        "site_id", TS, F.least("wh", F.lit(10000)).alias("soc"), F.lit(1000).alias("soh"), *more
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    ev = site_events(spark, sf_dir)
    return Tables(mains(ev), production(ev), prices(ev), battery(ev), sites(ev))


def meter_telegrams(events: DataFrame, *more: str) -> DataFrame:
    """One telegram per event. A device is silent for one kind of event."""

    def device(silent: str, shift: int):
        counter = F.col("id") * 7 + shift
        return F.when(
            F.col("kind") != silent,
            F.struct(
                (counter / 8).alias("energy_import_kwh"),
                ((counter + 3) / 16).alias("energy_export_kwh"),
                (220 + F.col("id") % 40 / 4).alias("voltage_v"),
                (49 + F.col("id") % 8 / 4).alias("frequency_hz"),
            ),
        )

    return events.select(
        "site_id",
        TS,
        device("click", 1).alias("ev"),
        device("view", 2).alias("pv"),
        device("error", 3).alias("p1"),
        *more,
    )


def battery_telegrams(events: DataFrame, *more: str) -> DataFrame:
    def unit(shift: int):
        charge = ((F.col("id") * 5 + shift) % 1024) / 1024
        return F.struct(F.struct(charge.alias("state_of_charge")).alias("sessy"))

    return events.select("site_id", TS, unit(1).alias("b1"), unit(2).alias("b2"), *more)


def meter_samples(events: DataFrame, *more: str) -> DataFrame:
    """Raw ``mains`` samples without history, as a stream would deliver them."""
    n = F.col("id")
    return events.select(
        "site_id",
        TS,
        (-n * 3).alias("exp"),
        (n * 5).alias("imp"),
        (-n * 2).alias("gen"),
        (n * 4).alias("gep"),
        (-n).alias("evn"),
        (n * 6).alias("evp"),
        (2200 + n % 100).cast("int").alias("v1"),
        (500 + n % 5).cast("int").alias("frq"),
        *more,
    )


def tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import and export per tariff and month, in cents."""
    o = read(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    part = F.col("o_orderkey") % 4

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, cents)), F.lit(0))

    return o.groupBy(
        (F.col("o_custkey") % 4).cast("string").alias("site_id"),
        t.strftime("o_orderdate", "%Y-%m").alias("label"),
    ).agg(
        total(part == 0).alias("ilo"),
        total(part == 1).alias("ihi"),
        total(part == 2).alias("xlo"),
        total(part == 3).alias("xhi"),
        total(F.col("o_orderstatus") == "P").alias("own"),
    )


def account_months(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cents bought and sold per customer and month; months without orders are missing."""
    o = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("site_id"),
        t.strftime("o_orderdate", "%Y-%m").alias("label"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        (F.col("o_orderkey") % 2 == 1).alias("sold"),
    )
    value = F.sum("cents").alias("v")
    used, sold = (o.where(c).groupBy("site_id", "label").agg(value) for c in ("NOT sold", "sold"))
    return used, sold


def counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running total of shipped quantity per return flag, one reading per day."""
    daily = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("site_id"), F.col("l_shipdate").alias(TS))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("y"))
    )
    return running_total(daily, ["y"], slice_rule="year")


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price responses as text, one per day.

    Even hours are listed under today, odd hours under tomorrow. Every third day
    has no tomorrow branch, and the first slot of an hour with a price that ends in
    3 has unreadable text instead of a number.
    """
    p = prices(site_events(spark, sf_dir))
    broken = (F.minute(TS) == 0) & (F.round(F.col("price") * 100000).cast("bigint") % 10 == 3)
    stamp = F.concat(t.strftime(TS, "%Y-%m-%dT%H:%M:%S"), F.lit(".000+01:00"))
    item = F.struct(
        stamp.alias("startsAt"),
        F.when(broken, F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("total"),
    )
    even = F.hour(TS) % 2 == 0
    days = p.groupBy("market_id", t.bucket_start(TS, "d").alias("day")).agg(
        F.collect_list(F.when(even, item)).alias("today"),
        F.collect_list(F.when(~even, item)).alias("tomorrow"),
    )
    tomorrow = F.when(F.dayofmonth("day") % 3 != 0, F.col("tomorrow"))
    info = F.struct(F.col("today"), tomorrow.alias("tomorrow")).alias("priceInfo")
    home = F.struct(F.struct(info).alias("currentSubscription"))
    doc = F.struct(F.struct(F.struct(F.array(home).alias("homes")).alias("viewer")).alias("data"))
    return days.select("market_id", F.to_json(doc).alias("payload"))


def solar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solar responses as text, one per site and quarter hour of samples."""
    p = production(site_events(spark, sf_dir))
    slot = t.bucket_start(TS, "15min")
    value = F.when(F.sum("solar") % 5 != 0, F.sum("solar") + 0.75)
    slots = p.groupBy("site_id", slot.alias(TS)).agg(value.alias("value"))
    item = F.struct(t.strftime(TS, "%Y-%m-%d %H:%M:%S").alias("date"), F.col("value"))
    days = slots.groupBy("site_id", t.bucket_start(TS, "d").alias("day")).agg(
        F.collect_list(item).alias("values")
    )
    doc = F.struct(F.struct("values").alias("energy"))
    return days.select("site_id", F.to_json(doc).alias("payload"))


def charger_totals(events: DataFrame) -> DataFrame:
    """Charger minute totals; hour and minute are absent when they are zero."""
    hour, minute = F.hour(TS), F.minute(TS)
    n = F.col("id")
    return events.select(
        "site_id",
        F.year(TS).alias("yr"),
        F.month(TS).alias("mon"),
        F.dayofmonth(TS).alias("dom"),
        F.when(hour != 0, hour).alias("hr"),
        F.when(minute != 0, minute).alias("min"),
        (n * 60).alias("exp"),
        (n * 120).alias("imp"),
        (n * 30).alias("gen"),
        (n * 90).alias("gep"),
        (n * 15).alias("h1b"),
        (n * 45).alias("h1d"),
        (2200 + n % 300).cast("int").alias("v1"),
        (4950 + n % 100).cast("int").alias("frq"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a text column to coerce: the number inside ``props`` or other text."""
    text = F.regexp_extract("props", r"(\d+)", 1)
    ev = read(spark, sf_dir, "events")
    reading = F.when(F.col("event_id") % 7 == 0, F.lit("bad")).otherwise(text)
    return ev.select("event_id", F.col("ts").alias(TS), reading.alias("reading"), "value", "props")


def numbered_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_events(spark, sf_dir).select(
        "id", t.epoch_seconds(TS).alias("epoch"), e.scaled("wh", 0.5).alias("half")
    )
