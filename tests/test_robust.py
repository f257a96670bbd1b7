"""Several markets, late and broken input, open holes, and times before the epoch."""

import pytest
from pyspark.sql import functions as F

from conftest import result
from energy_series import schemas
from energy_series.functions import energy as e
from energy_series.functions import time as t
from energy_series.operators import gaps, join
from energy_series.sources import payloads, tables

SLOTS = "site_id string, sample_time timestamp_ntz, imp bigint"
PRICES = "market_id string, sample_time timestamp_ntz, price double"
TWO = [("NL", "2024-01-01 00:00:00", 0.1), ("BE", "2024-01-01 00:00:00", 0.3)]


def test_each_site_meets_its_own_market(rows):
    series = rows(SLOTS, [("a", "2024-01-01 00:00:00", 1), ("b", "2024-01-01 00:00:00", 1)])
    sites = rows("site_id string, market_id string", [("a", "NL"), ("b", "BE")])
    joined = join.with_prices(join.with_market(series, sites), rows(PRICES, TWO), ["market_id"])
    assert result(joined.select("site_id", "price")) == [("a", 0.1), ("b", 0.3)]
    assert "BroadcastHint" not in joined._jdf.queryExecution().logical().toString()


def test_two_markets_without_keys_are_an_error(rows):
    series = rows(SLOTS, [("a", "2024-01-01 00:00:00", 1)])
    assert join.with_prices(series, rows(PRICES, TWO[:1])).count() == 1
    with pytest.raises(Exception, match="several markets"):
        join.with_prices(series, rows(PRICES, TWO)).collect()
    apart = [("NL", "2024-01-01 00:00:00", 0.1), ("BE", "2024-01-01 00:15:00", 0.2)]
    with pytest.raises(ValueError, match="several markets"):
        join.with_prices(series, rows(PRICES, apart))


def test_a_site_without_market_is_an_error(rows):
    series = rows(SLOTS, [("a", "2024-01-01 00:00:00", 1)])
    with pytest.raises(Exception, match="no market"):
        join.with_market(series, rows("site_id string, market_id string", [])).collect()


def test_broken_price_documents_are_rejected_once(spark):
    docs = spark.createDataFrame(
        [("NL", "not json"), ("NL", '{"data": {"viewer": {"homes": []}}}'), ("NL", None), ("NL",
          '{"data": {"viewer": {"homes": [{"currentSubscription": {"priceInfo": {"today": ['
          '{"startsAt": "2024-01-01T00:00:00", "total": "0.5"}, {"startsAt": "2024-01-01T01:00:00", "total": "NaN"}'
          ']}}}]}}}')],
        "market_id string, payload string",
    )
    read = payloads.parsed(docs, "prices")
    assert payloads.price_rows(read).count() == 1
    assert payloads.price_rejects(read).count() == 1
    assert payloads.price_document_rejects(read).count() == 3


def test_solar_items_without_time_are_rejects(spark):
    docs = spark.createDataFrame(
        [("a", '{"energy": {"values": [{"date": "2024-01-01 00:00:00", "value": "nan"}, {"date": "x", "value": "1"}]}}'),
         ("b", "broken")],
        "site_id string, payload string",
    )
    read = payloads.parsed(docs, "solar")
    assert [r["solar"] for r in payloads.solar_rows(read).collect()] == [0]
    assert sorted((r["site_id"], r["date"]) for r in payloads.solar_rejects(read).collect()) == [("a", "x"), ("b", None)]


def test_an_impossible_charger_date_is_a_reject(spark):
    schema = schemas.CHARGER_MINUTES
    names = spark.createDataFrame([], schema).columns
    row = dict.fromkeys(names, 1) | {"site_id": "a", "yr": 2024}
    totals = spark.createDataFrame([tuple((row | {"mon": m})[c] for c in names) for m in (12, 13)], schema)
    assert payloads.charger_rows(totals).count() == 1
    assert [r["mon"] for r in payloads.charger_rejects(totals).collect()] == [13]


def test_upsert_keeps_one_row_for_a_key(spark, rows, tmp_path):
    twice = rows(SLOTS, [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:00:00", 2)])
    tables.upsert(twice, f"{tmp_path}/t", f"{tmp_path}/s", 0)
    assert result(spark.read.parquet(f"{tmp_path}/t").select("imp")) == [(2,)]
    with pytest.raises(ValueError, match="NULL key"):
        tables.upsert(rows(SLOTS, [("a", None, 1)]), f"{tmp_path}/t", f"{tmp_path}/s", 1)


def test_a_row_without_sequence_keeps_its_values(rows):
    one = rows("site_id string, sample_time timestamp_ntz, imp bigint, seq bigint", [("a", "2024-01-01 00:00:00", 7, None)])
    assert result(tables.last_write_wins(one, "seq").select("imp")) == [(7,)]


def test_the_hole_after_the_newest_sample(rows):
    one = rows(SLOTS, [("a", "2024-01-01 00:00:00", 1)])
    assert gaps.gaps(one).count() == 0
    found = gaps.gaps(one, as_of="2024-01-01 01:00:00").collect()
    assert [r["missing"] for r in found] == [3]


def test_nan_is_missing_and_buckets_before_the_epoch(spark, rows):
    text = spark.createDataFrame([("nan",), ("1",)], "x string")
    assert e.numeric(text, ()).agg(F.sum("x")).first()[0] == 1.0
    old = rows("sample_time timestamp_ntz", [("1969-12-31 23:50:00",), ("1969-12-31 23:45:00",), ("1970-01-01 00:14:59",)])
    starts = {str(r[0]) for r in old.select(t.bucket_start("sample_time", "15min")).collect()}
    assert starts == {"1969-12-31 23:45:00", "1970-01-01 00:00:00"}
