"""Landed documents dealt to rows and rejects in one scan, and calendar steps that roll over."""

import datetime as dt
import json
import random
import sqlite3

import pytest
from conftest import result

from energy_series.columns import MARKET, TS
from energy_series.functions import time as t
from energy_series.sources import payloads, tables


def price(*today, tomorrow=None):
    items = lambda some: [{"startsAt": a, "total": b} for a, b in some]
    info = {"today": items(today), **({"tomorrow": items(tomorrow)} if tomorrow else {})}
    return json.dumps({"data": {"viewer": {"homes": [{"currentSubscription": {"priceInfo": info}}]}}})


GOOD = "2024-01-01T00:00:00.000+01:00"
PRICES = [
    ("m", price((GOOD, "0.5"), ("soon", "0.5"), (GOOD, "dear"), (GOOD, "NaN"), (None, None))),
    ("m", price(tomorrow=[(GOOD, "1")])),
    ("m", price()),
    ("n", "not json"),
    ("n", None),
    (None, "{}"),
]


def documents(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} string, payload string")


def test_every_entry_is_a_row_or_a_reject(spark):
    parsed = payloads.parsed(documents(spark, PRICES, "market_id"), "prices")
    entries = payloads.dealt(parsed, "prices", MARKET)
    found = {r["market_id"]: r.asDict() for r in entries.groupBy("market_id").agg(*payloads.counts()).collect()}
    assert found["m"] == {
        "market_id": "m", "n_documents": 3, "n_items": 6, "n_rows": 2, "n_no_items": 1, "n_no_time": 2, "n_no_amount": 2,
    }
    assert found["n"]["n_documents"] == found["n"]["n_no_items"] == 2 and found[None]["n_no_items"] == 1
    for r in found.values():
        assert r["n_items"] == r["n_rows"] + r["n_no_time"] + r["n_no_amount"]
    rows = payloads.price_rows(parsed, MARKET)
    kept = entries.where("reason IS NULL").select("market_id", TS, "value")
    assert result(kept) == result(rows.select("market_id", TS, "price"))
    rejects = payloads.price_rejects(parsed, MARKET).count() + payloads.price_document_rejects(parsed, MARKET).count()
    assert entries.where("reason IS NOT NULL").count() == rejects


def test_solar_entries(spark):
    docs = [("s", json.dumps({"energy": {"values": [{"date": "2024-01-01 00:00:00", "value": x}]}})) for x in ("3.5", "None", None)]
    docs += [("s", json.dumps({"energy": {"values": [{"date": "x", "value": "1"}]}})), ("s", "{}")]
    entries = payloads.dealt(payloads.parsed(documents(spark, docs, "site_id"), "solar"), "solar")
    assert sorted(r.value for r in entries.where("reason IS NULL").collect()) == [0.0, 0.0, 3.0]
    assert sorted(r.reason for r in entries.where("reason IS NOT NULL").collect()) == [payloads.NO_ITEMS, payloads.NO_TIME]


@pytest.mark.parametrize("docs", [PRICES, []])
def test_counts_are_those_of_what_was_written(spark, tmp_path, docs):
    parsed = payloads.parsed(documents(spark, docs, "market_id"), "prices")
    seen = payloads.land(parsed, "prices", str(tmp_path / "landed"), MARKET)
    assert seen["n_documents"] == len(docs)
    if docs:
        written = {str(r.rejected).lower() == "true": r["count"] for r in spark.read.parquet(str(tmp_path / "landed")).groupBy("rejected").count().collect()}
        assert written == {False: seen["n_rows"], True: seen["n_no_items"] + seen["n_no_time"] + seen["n_no_amount"]}


def test_rollover_steps_as_sqlite(spark):
    rng, db = random.Random(4), sqlite3.connect(":memory:")
    cases = [("2024-03-31 10:11:12", 1, "month"), ("2024-02-29 00:00:00", 1, "year"), ("2023-03-31 23:59:59", 13, "month")]
    for _ in range(60):
        start = dt.datetime(2016, 1, 1) + dt.timedelta(seconds=rng.randrange(10 * 365 * 86_400))
        cases.append((str(start), rng.randrange(40), rng.choice(["hour", "day", "month", "year"])))
    columns = [f"CAST({t.periods_before(a, n, unit, rollover=True)} AS STRING) AS c{i}" for i, (a, n, unit) in enumerate(cases)]
    got = list(spark.range(1).selectExpr(*columns).first())
    want = [db.execute("SELECT datetime(?, ?)", (a, f"-{n} {unit}")).fetchone()[0] for a, n, unit in cases]
    assert got == want
    clamped = spark.range(1).selectExpr(f"CAST({t.periods_before('2024-03-31 10:00:00', 1, 'month')} AS STRING)").first()[0]
    assert clamped == "2024-02-29 10:00:00"


def test_range_scan_rolls_over(spark, rows):
    df = rows(f"{TS} timestamp_ntz", [(f"2023-03-0{d} 00:00:00",) for d in (1, 2, 3, 4)])
    assert tables.range_scan(df, "2023-03-31 00:00:00", 0, "month", rollover=True).count() == 2
    assert tables.range_scan(df, "2023-03-31 00:00:00", 0, "month").count() == 4
