"""Registered queries: every operator on the views over the test tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import COUNTERS, TS
from ..functions import energy as e
from ..functions import time as t
from ..operators import counters, gaps, grid, ingest, interpolate, join, ordered, prices, shape, tariff
from ..plans import bands, historic, pyramid, quarter, trend
from ..sources import buckets, payloads, tables
from ..streaming import compaction, keyed, meters, repair
from . import views as v

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BANDS_AS_OF = "2024-01-15 12:00:00"
OPEN_UNTIL = "2024-02-05 00:00:00"
TREND_AS_OF = "2024-01-31 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *cols: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _ev(spark, sf_dir) -> DataFrame:
    return v.site_events(spark, sf_dir)


# --- quarter-hour series ------------------------------------------------------


@query
def mains_15min(spark, sf_dir):
    return quarter.mains_quarters(v.mains(_ev(spark, sf_dir)))


@query
def mains_steps(spark, sf_dir):
    """Step of every reading from the one before it."""
    steps = ordered.row_delta(v.mains(_ev(spark, sf_dir)), COUNTERS)
    return steps.withColumns({c: F.col(c).cast("double") for c in COUNTERS})


@query
def mains_hourly(spark, sf_dir):
    return quarter.mains_quarters(v.mains(_ev(spark, sf_dir)), "h")


@query
def mains_daily(spark, sf_dir):
    quarters = quarter.mains_wh(v.mains(_ev(spark, sf_dir), ["imp"]), cols=["imp"])
    return grid.resample(quarters, "d", sums=["imp"]).withColumn("imp", e.kwh("imp"))


@query
def mains_monthly_complete(spark, sf_dir):
    return quarter.mains_quarters(v.mains(_ev(spark, sf_dir)), "month", holes=False)


@query
def mains_holes(spark, sf_dir):
    """Every 11th import reading is missing."""
    readings = v.mains(_ev(spark, sf_dir), ["imp", "exp"])
    second = t.epoch_seconds(TS)
    holed = readings.withColumn("imp", F.when(second % 11 != 0, F.col("imp")))
    return quarter.mains_quarters(holed, cols=["imp", "exp"])


@query
def production_hourly(spark, sf_dir):
    return quarter.production_quarters(v.production(_ev(spark, sf_dir)), "h")


@query
def battery_15min(spark, sf_dir):
    return _rounded(quarter.battery_quarters(v.battery(_ev(spark, sf_dir))), "soc")


@query
def battery_soc_daily(spark, sf_dir):
    return _rounded(quarter.battery_mean_of_means(v.battery(_ev(spark, sf_dir)), "d"), "soc")


@query
def prices_ffill(spark, sf_dir):
    return quarter.price_quarters(v.prices(_ev(spark, sf_dir)))


@query
def prices_raw_fill(spark, sf_dir):
    """Fill without resampling; prices of hours divisible by 5 are missing."""
    p = v.prices(_ev(spark, sf_dir))
    holed = p.withColumn("price", F.when(F.hour(TS) % 5 != 0, F.col("price")))
    return quarter.price_quarters(holed, "")


# --- energy and money ---------------------------------------------------------


def _quarters(spark, sf_dir) -> DataFrame:
    return trend.energy_quarters(v.tables(spark, sf_dir), holes=False)


@query
def series_join(spark, sf_dir):
    """The three resampled series joined slot by slot."""
    source = v.tables(spark, sf_dir)
    joined = join.energy_join(
        join.with_market(quarter.mains_wh(source.mains, holes=False), source.sites),
        quarter.production_wh(source.production),
        quarter.price_quarters(source.prices),
        price_keys=["market_id"],
    )
    return joined.drop("market_id")


@query
def energy_quarters(spark, sf_dir):
    q = _quarters(spark, sf_dir)
    money = ("sell_euro", "own_use_euro", "dyn_buy_euro", "ev_cost")
    return q.withColumns({c: e.euro(c) for c in money})


@query
def trend_pv_day(spark, sf_dir):
    return trend.frame(_quarters(spark, sf_dir), "PV", "d")


@query
def trend_home_hour(spark, sf_dir):
    return trend.frame(_quarters(spark, sf_dir), "HOME", "h")


@query
def trend_ev_day(spark, sf_dir):
    return trend.frame(_quarters(spark, sf_dir), "EV", "d")


@query
def trend_euro_month(spark, sf_dir):
    return trend.frame(_quarters(spark, sf_dir), "EURO", "month")


@query
def trend_evcost_year(spark, sf_dir):
    return trend.frame(_quarters(spark, sf_dir), "EVcost", "year")


@query
def trend_table_day(spark, sf_dir):
    return trend.trend_table(v.tables(spark, sf_dir), "d", holes=False)


@query
def trend_table_day_holes(spark, sf_dir):
    """The same by the path that allows for missing readings, the default."""
    return trend.trend_table(v.tables(spark, sf_dir), "d")


@query
def trend_totals(spark, sf_dir):
    return trend.totals(_quarters(spark, sf_dir))


@query
def trend_presets(spark, sf_dir):
    frames = trend.trend_preset(v.tables(spark, sf_dir), "hours", TREND_AS_OF, holes=False)
    return frames["HOME"]


def _pyramid(spark, make, name, rows):
    """A pyramid of two batches; the first lacks some samples, the second repairs what they change."""
    built = make(spark, compaction.shared_folder(spark, name), buckets=4)
    for batch, some in enumerate(rows):
        built.update(some, batch)
    return built


@query
def trend_pyramid_day(spark, sf_dir):
    """trend_table_day from the level of days."""
    whole = v.tables(spark, sf_dir)
    partly = dataclasses.replace(whole, mains=whole.mains.where(F.second(TS) % 7 != 0))
    rows = [pyramid.energy_rows(some) for some in (partly, whole)]
    return pyramid.energy_table(_pyramid(spark, pyramid.energy_pyramid, "trend_pyramid_day", rows), "d")


@query
def battery_soc_pyramid(spark, sf_dir):
    """battery_soc_daily from the level of days."""
    battery = v.battery(_ev(spark, sf_dir))
    rows = [pyramid.charge_rows(some) for some in (battery.where(F.second(TS) % 7 != 0), battery)]
    table = pyramid.charge_table(_pyramid(spark, pyramid.charge_pyramid, "battery_soc_pyramid", rows), "d")
    return _rounded(table, "soc")


@query
def monthly_report(spark, sf_dir):
    report = trend.monthly_report(v.tables(spark, sf_dir), TREND_AS_OF, holes=False)
    return _rounded(report, "soc")


@query
def tick_labels(spark, sf_dir):
    hours = quarter.production_wh(v.production(_ev(spark, sf_dir)), "h")
    return shape.tick_labels(hours, trend.PRESETS["hours"][3])


# --- prices -------------------------------------------------------------------


@query
def price_day_statistics(spark, sf_dir):
    return _rounded(
        prices.daily_statistics(v.prices(_ev(spark, sf_dir))), "mean_price", "median_price"
    )


@query
def price_bands_mean(spark, sf_dir):
    return prices.price_bands(v.prices(_ev(spark, sf_dir)), BANDS_AS_OF)


@query
def price_bands_median(spark, sf_dir):
    return prices.price_bands(v.prices(_ev(spark, sf_dir)), BANDS_AS_OF, median=True)


@query
def price_bands_minimum(spark, sf_dir):
    return prices.price_bands(
        v.prices(_ev(spark, sf_dir)), BANDS_AS_OF, lowq=30, highq=70, median=True, minimum=True
    )


@query
def price_bands_two_days(spark, sf_dir):
    as_of = dt.datetime.fromisoformat(BANDS_AS_OF)
    return bands.price_window(v.prices(_ev(spark, sf_dir)), as_of)


# --- scans and ranges -----------------------------------------------------------


def _orders(spark, sf_dir) -> DataFrame:
    o = v.read(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.col("o_orderdate").alias(TS))


@query
def window_scan(spark, sf_dir):
    return tables.window_scan(_ev(spark, sf_dir), "2024-01-20 12:00:00", 48)


@query
def range_periods(spark, sf_dir):
    return tables.range_scan(_orders(spark, sf_dir), "1998-05-31 10:00:00", 2, "month")


@query
def range_periods_rollover(spark, sf_dir):
    """The same window where February runs over into March."""
    return tables.range_scan(_orders(spark, sf_dir), "1998-05-31 10:00:00", 2, "month", rollover=True)


@query
def range_start_of_year(spark, sf_dir):
    return tables.range_scan(
        _orders(spark, sf_dir), "1998-06-15 10:00:00", 2, "month", from_start_of_year=True
    )


@query
def range_not_today(spark, sf_dir):
    return tables.range_scan(
        _orders(spark, sf_dir), "1998-06-15 10:00:00", 30, "day", include_today=False
    )


@query
def range_year(spark, sf_dir):
    return tables.range_scan(_orders(spark, sf_dir), "1998-06-15", 2, "month", year=1997)


@query
def retention(spark, sf_dir):
    return tables.retained(_orders(spark, sf_dir), "2018-01-01 06:00:00")


@query
def numeric_coerce(spark, sf_dir):
    readings = shape.without(v.scored_events(spark, sf_dir), ["props", "not_there"])
    return e.numeric(readings, keep=[TS])


@query
def future_filter(spark, sf_dir):
    ev = _ev(spark, sf_dir).withColumn("sample_epoch", t.epoch_seconds(TS))
    return ingest.not_in_future(ev, "2024-01-20 12:00:00")


# --- timelines, interpolation, labels --------------------------------------------


@query
def timeline(spark, sf_dir):
    newest = gaps.latest_point(_ev(spark, sf_dir))
    return grid.timeline(newest, 2, "day")


@query
def quarter_ceil(spark, sf_dir):
    slots = v.numbered_slots(spark, sf_dir)
    return slots.select(
        "id",
        "epoch",
        t.quarter_ceil("epoch").alias("next_quarter"),
        t.quarter_end("epoch", 15).alias("quarter_end"),
        t.floor_to_step("epoch").alias("quarter_start"),
    )


@query
def interp_counter(spark, sf_dir):
    samples = v.counter(spark, sf_dir).withColumn("epoch", t.epoch_seconds(TS))
    start, stop = grid.timeline_bounds("2001-12-10 12:00:00", 400, "day")
    return _rounded(interpolate.interpolate(samples, start, stop), "y", digits=6)


@query
def label_delta(spark, sf_dir):
    m = v.mains(_ev(spark, sf_dir), ["imp"])
    return counters.label_delta(m, "imp", t.strftime(TS, "%m-%d %Hh"))


@query
def label_sum(spark, sf_dir):
    label = t.strftime(TS, "%Y-%m-%d")
    return counters.label_sum(v.production(_ev(spark, sf_dir)), "solar", label)


@query
def historic_series(spark, sf_dir):
    """Listed sites without a reading fall back to zeros."""
    items = v.read(spark, sf_dir, "lineitem")
    sites = items.select(F.explode(F.array("l_returnflag", "l_linestatus")).alias("site_id"))
    series = historic.historic_series(
        v.counter(spark, sf_dir), "y", "2001-06-15 12:00:00", 12, "month", "%Y-%m", sites=sites
    )
    return _rounded(series, "y", digits=6)


@query
def historic_year(spark, sf_dir):
    series = historic.historic_series(
        v.counter(spark, sf_dir), "y", "2001-06-15", 53, "day", "%Y-%m-%d", year=1999
    )
    return _rounded(series, "y", digits=6)


@query
def tail_periods(spark, sf_dir):
    hours = quarter.production_wh(v.production(_ev(spark, sf_dir)), "h")
    return shape.tail(hours, 50)


# --- tariffs ----------------------------------------------------------------------


@query
def contract(spark, sf_dir):
    return tariff.contract(*v.account_months(spark, sf_dir))


@query
def distract(spark, sf_dir):
    return tariff.distract(*v.account_months(spark, sf_dir))


@query
def distract_signed(spark, sf_dir):
    return tariff.distract(*v.account_months(spark, sf_dir), allow_negatives=True)


@query
def contract_aligned(spark, sf_dir):
    return tariff.contract_aligned(*v.account_months(spark, sf_dir))


@query
def distract_aligned(spark, sf_dir):
    return tariff.distract_aligned(*v.account_months(spark, sf_dir))


def _arrays(spark, sf_dir):
    """Arrays of one value per month of a customer (no longer than the calendar), of unequal length."""

    def as_array(series: DataFrame, name: str) -> DataFrame:
        months = F.array_sort(
            F.collect_list(F.struct("label", F.col("v").cast("double").alias("v")))
        )
        return series.groupBy("site_id").agg(months["v"].alias(name))

    used, sold = v.account_months(spark, sf_dir)
    both = as_array(used, "a").join(as_array(sold, "b"), "site_id", "full")
    nothing = F.array().cast("array<double>")
    return both.withColumns({c: F.coalesce(c, nothing) for c in ("a", "b")})


@query
def contract_arrays(spark, sf_dir):
    added = tariff.contract_arrays(F.col("a"), F.col("b"))
    return _arrays(spark, sf_dir).select("site_id", F.posexplode(added).alias("i", "v"))


@query
def distract_arrays(spark, sf_dir):
    less = tariff.distract_arrays(F.col("a"), F.col("b"), allow_negatives=True)
    return _arrays(spark, sf_dir).select("site_id", F.posexplode(less).alias("i", "v"))


@query
def zip_shortest(spark, sf_dir):
    used, sold = v.account_months(spark, sf_dir)
    return tariff.zip_shortest(
        used.withColumnRenamed("v", "use"), sold.withColumnRenamed("v", "expo")
    )


@query
def balance_single(spark, sf_dir):
    return tariff.balance_single(v.tariff(spark, sf_dir))


@query
def balance_dual(spark, sf_dir):
    return tariff.balance_dual(v.tariff(spark, sf_dir))


@query
def balance_dual_accumulated(spark, sf_dir):
    return tariff.balance_dual(v.tariff(spark, sf_dir), accumulate=True)


@query
def year_month_matrix(spark, sf_dir):
    used, sold = v.account_months(spark, sf_dir)
    months = used.withColumnRenamed("v", "use").join(
        sold.withColumnRenamed("v", "expo"), ["site_id", "label"], "full"
    )
    return tariff.year_month_matrix(months)


# --- ingest -------------------------------------------------------------------------


@query
def meter_translate(spark, sf_dir):
    rows = ingest.translate_meter(v.meter_telegrams(_ev(spark, sf_dir)))
    return rows.withColumns({c: F.col(c).cast("double") for c in (*COUNTERS, "v1", "frq")})


@query
def carry_last_known(spark, sf_dir):
    readings = _ev(spark, sf_dir).select(
        "site_id",
        TS,
        F.when(F.col("kind") == "click", F.col("wh")).cast("double").alias("click"),
        F.when(F.col("id") % 50 == 0, F.col("value")).alias("rare"),
    )
    return ordered.carry_forward(readings, ["click", "rare"])


@query
def battery_translate(spark, sf_dir):
    return ingest.translate_battery(v.battery_telegrams(_ev(spark, sf_dir)))


@query
def compact_meter(spark, sf_dir):
    return ingest.compact_meter(v.meter_samples(_ev(spark, sf_dir)))


@query
def compact_battery(spark, sf_dir):
    return _rounded(ingest.compact_battery(v.battery(_ev(spark, sf_dir))), "soc", "soh")


@query
def compaction_remainder(spark, sf_dir):
    return ingest.compaction_remainder(v.meter_samples(_ev(spark, sf_dir)))


@query
def price_json_rows(spark, sf_dir):
    return payloads.price_rows(payloads.parsed(v.price_documents(spark, sf_dir), "prices"))


@query
def price_json_rejects(spark, sf_dir):
    return payloads.price_rejects(payloads.parsed(v.price_documents(spark, sf_dir), "prices"))


@query
def solar_json_rows(spark, sf_dir):
    return payloads.solar_rows(payloads.parsed(v.solar_documents(spark, sf_dir), "solar"))


def _landed(spark, telegrams, kind):
    """Telegrams written as the files that a gateway lands, and read by the file source."""
    folder = compaction.shared_folder(spark, f"landed_{kind}")
    telegrams.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(folder)
    return payloads.read_json(spark, kind, folder)


@query
def landed_meter_files(spark, sf_dir):
    rows = ingest.translate_meter(_landed(spark, v.meter_telegrams(_ev(spark, sf_dir)), "meter"))
    return rows.withColumns({c: F.col(c).cast("double") for c in (*COUNTERS, "v1", "frq")})


@query
def landed_battery_files(spark, sf_dir):
    return ingest.translate_battery(_landed(spark, v.battery_telegrams(_ev(spark, sf_dir)), "battery"))


@query
def price_dump(spark, sf_dir):
    """Price rows dumped as JSON and read back."""
    folder = compaction.shared_folder(spark, "price_dump")
    rows = payloads.price_rows(payloads.parsed(v.price_documents(spark, sf_dir), "prices"))
    tables.write_rows_json(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


@query
def report_file(spark, sf_dir):
    """The table of days written as a report and read back."""
    folder = compaction.shared_folder(spark, "report_file")
    report = trend_table_day(spark, sf_dir)
    tables.write_report(report, folder)
    return spark.read.schema(report.schema).option("header", True).csv(folder)


@query
def created_table(spark, sf_dir):
    """A table made from its known layout, filled and read."""
    folder = compaction.shared_folder(spark, "created_table")
    tables.create_table(spark, "battery", f"{folder}/battery")
    rows = ingest.compact_battery(v.battery(_ev(spark, sf_dir)))
    tables.upsert(rows, f"{folder}/battery", f"{folder}/staging", 0)
    stored = tables.read_table(spark, "battery", f"{folder}/battery").drop(tables.PARTITION)
    return _rounded(stored, "soc", "soh")


@query
def payload_accounting(spark, sf_dir):
    """Documents and items of both kinds, and the rows and rejects that they became."""
    views = {"prices": (v.price_documents, "market_id"), "solar": (v.solar_documents, "site_id")}
    found = [
        payloads.dealt(payloads.parsed(documents(spark, sf_dir), kind), kind, [key])
        .groupBy(F.lit(kind).alias("kind"), F.col(key).alias("source"))
        .agg(*payloads.counts())
        for kind, (documents, key) in views.items()
    ]
    return found[0].unionByName(found[1])


@query
def charger_units(spark, sf_dir):
    return payloads.charger_rows(v.charger_totals(_ev(spark, sf_dir)))


@query
def upsert_last_wins(spark, sf_dir):
    writes = _ev(spark, sf_dir).select(
        "site_id", t.bucket_start(TS, "15min").alias(TS), "kind", "wh", F.col("id").alias("seq")
    )
    return tables.last_write_wins(writes, "seq")


@query
def upsert_merge(spark, sf_dir):
    """Two batches in one table: the second replaces, adds and repeats rows."""
    writes = _ev(spark, sf_dir).select(
        "site_id", t.bucket_start(TS, "15min").alias(TS), "kind", "wh", F.col("id").alias("seq")
    )
    shared = compaction.shared_folder(spark, "upsert_merge")
    later = F.col("seq") % 3 == 0
    for batch, rows in enumerate((writes.where(~later), writes.where(later).unionAll(writes.where(later)))):
        tables.upsert(rows, f"{shared}/table", f"{shared}/staging", batch, "seq")
    return spark.read.parquet(f"{shared}/table").select("site_id", TS, "kind", "wh")


@query
def upsert_buckets(spark, sf_dir):
    """The batches of upsert_merge in a table of change files."""
    writes = _ev(spark, sf_dir).select(
        "site_id", t.bucket_start(TS, "15min").alias(TS), "kind", "wh", F.col("id").alias("seq")
    )
    table = buckets.BucketTable(spark, compaction.shared_folder(spark, "upsert_buckets"), buckets=4)
    later = F.col("seq") % 3 == 0
    for batch, rows in enumerate((writes.where(~later), writes.where(later).unionAll(writes.where(later)))):
        table.upsert(rows, "query", batch, "seq")
    return table.read().select("site_id", TS, "kind", "wh")


@query
def bucket_window(spark, sf_dir):
    """Two sites' samples of ten days, from the files of a bucket table that can hold them."""
    table = buckets.BucketTable(spark, compaction.shared_folder(spark, "bucket_window"), buckets=4)
    ev = _ev(spark, sf_dir)
    for batch, rows in enumerate((ev.where("id % 5 <> 0"), ev.where("id % 5 = 0"))):
        slots = rows.groupBy("site_id", t.bucket_start(TS, "15min").alias(TS)).agg(F.max("wh").alias("wh"))
        table.upsert(slots, "query", batch, unique=True)
    return table.read(low="2024-01-10 00:00:00", high="2024-01-19 23:45:00", sites=["2", "5"])


@query
def stream_compact(spark, sf_dir):
    """The compaction as a stream over the event file, upserted into a table."""
    shared = compaction.shared_folder(spark, "stream_compact")
    events = (
        spark.readStream.schema(v.SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    rows = compaction.compact_meter_stream(v.meter_samples(v.with_site(events)))
    compaction.upsert_stream(rows, f"{shared}/mains", f"{shared}/work").awaitTermination()
    return spark.read.parquet(f"{shared}/mains").drop(tables.PARTITION)


@query
def stream_meter_pipeline(spark, sf_dir):
    """Telegrams in three deliveries, each over the whole time, to compacted rows."""
    shared = compaction.shared_folder(spark, "stream_meter_pipeline")
    telegrams = v.meter_telegrams(_ev(spark, sf_dir).withColumn("delivery", F.col("id") % 3), "delivery")
    for delivery in range(3):
        part = telegrams.where(F.col("delivery") == delivery).drop("delivery")
        part.write.mode("append").parquet(f"{shared}/landed")
        landed = spark.readStream.schema(part.schema).parquet(f"{shared}/landed")
        meters.meter_pipeline(landed, f"{shared}/mains", f"{shared}/work").awaitTermination()
    rows = spark.read.parquet(f"{shared}/mains").drop(tables.PARTITION)
    return rows.withColumns({c: F.col(c).cast("double") for c in COUNTERS})


def _deliveries(spark, telegrams, kind, folder):
    """The rows that a repairing stream makes of telegrams in three deliveries, each over the whole time."""
    telegrams = telegrams.withColumn("delivery", F.col("id") % 3)
    for delivery in range(3):
        part = telegrams.where(F.col("delivery") == delivery).drop("delivery", "id")
        part.write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(part.schema).parquet(f"{folder}/landed")
        repair.repair_stream(landed, kind, f"{folder}/rows", f"{folder}/work", buckets=4).awaitTermination()
    return repair.compacted_rows(spark, f"{folder}/rows", buckets=4).read()


@query
def stream_meter_repair(spark, sf_dir):
    """Meter telegrams in three deliveries to compacted rows, repaired where a delivery changes them."""
    telegrams = v.meter_telegrams(_ev(spark, sf_dir), "id")
    rows = _deliveries(spark, telegrams, repair.METER, compaction.shared_folder(spark, "stream_meter_repair"))
    return rows.withColumns({c: F.col(c).cast("double") for c in COUNTERS})


@query
def stream_battery_repair(spark, sf_dir):
    """Battery telegrams in three deliveries to compacted rows."""
    ev = _ev(spark, sf_dir)
    telegrams = v.battery_telegrams(ev, "id")
    rows = _deliveries(spark, telegrams, repair.BATTERY, compaction.shared_folder(spark, "stream_battery_repair"))
    return rows.withColumns({c: F.round(c, 9) for c in ("soc", "soh")})


def _keyed(spark, samples, kind, folder):
    """The rows that keyed state makes of samples in three deliveries, each over the whole time."""
    table = buckets.BucketTable(spark, f"{folder}/rows", buckets=4)
    samples = samples.withColumn("delivery", F.col("id") % 3)
    for delivery in range(3):
        part = samples.where(F.col("delivery") == delivery).drop("delivery", "id")
        part.write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(part.schema).parquet(f"{folder}/landed")
        keyed.keyed_stream(landed, kind, table, f"{folder}/work", retention=366 * 86_400).awaitTermination()
    return table.read()


@query
def stream_keyed_compact(spark, sf_dir):
    """Meter samples compacted in keyed state over three deliveries."""
    samples = v.meter_samples(_ev(spark, sf_dir), "id")
    return _keyed(spark, samples, keyed.METER, compaction.shared_folder(spark, "stream_keyed_compact"))


@query
def stream_keyed_battery(spark, sf_dir):
    """Battery samples compacted in keyed state over three deliveries."""
    samples = v.battery(_ev(spark, sf_dir), "id")
    rows = _keyed(spark, samples, keyed.BATTERY, compaction.shared_folder(spark, "stream_keyed_battery"))
    return rows.withColumns({c: F.round(c, 9) for c in ("soc", "soh")})


# --- gaps -----------------------------------------------------------------------------


@query
def latest_point(spark, sf_dir):
    return gaps.latest_point(_ev(spark, sf_dir))


@query
def gap_islands(spark, sf_dir):
    return gaps.gaps(_ev(spark, sf_dir))


@query
def gap_open(spark, sf_dir):
    """Holes with the one after each site's newest sample."""
    return gaps.gaps(_ev(spark, sf_dir), as_of=OPEN_UNTIL)


@query
def backfill_open(spark, sf_dir):
    holes = gaps.gaps(_ev(spark, sf_dir), "d", as_of=OPEN_UNTIL)
    return gaps.backfill_plan(holes, OPEN_UNTIL)


@query
def backfill_plan(spark, sf_dir):
    users = v.read(spark, sf_dir, "events").select("user_id", F.col("ts").alias(TS))
    holes = gaps.gaps(users, "h", keys=["user_id"])
    return gaps.backfill_plan(holes, TREND_AS_OF, keys=["user_id"])


@query
def signed_labels(spark, sf_dir):
    slots = v.numbered_slots(spark, sf_dir)
    signed = F.col("half") * F.when(F.col("id") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    return slots.select("id", signed.alias("amount"), e.signed_text(signed).alias("shown"))
