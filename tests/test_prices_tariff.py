import datetime as dt
from statistics import mean, median

import pytest
from conftest import at, result
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from energy_series.columns import TS
from energy_series.operators import prices, tariff
from energy_series.plans import bands

SCHEMA = "market_id string, sample_time timestamp_ntz, price double"
BANDS = prices.BANDS


def slots(values, start="2024-01-01 00:00:00", market="m"):
    base = at(start)
    return [(market, base + dt.timedelta(minutes=15 * i), p) for i, p in enumerate(values)]


def expected(data, as_of, lowq, highq, limit_of):
    """Brute force: per day choose, then classify slot by slot."""
    out = []
    for day in sorted({ts.date() for _, ts, _ in data}):
        rows = [(ts, p) for _, ts, p in data if ts.date() == day]
        limit = limit_of([p for _, p in rows])
        low = {ts for ts, _ in sorted(rows, key=lambda r: (r[1], r[0]))[:lowq]}
        high = {ts for ts, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:highq]}
        for ts, p in rows:
            row = dict.fromkeys(BANDS)
            if ts < as_of:
                row["past"] = p
            else:
                chosen = ts in low or ts in high
                row["lowest"] = p if ts in low else None
                row["highest"] = p if ts in high else None
                if not chosen:
                    row["low" if p <= limit else "high"] = p
            out.append(("m", str(ts), *(row[b] for b in BANDS)))
    return sorted(out, key=lambda r: r[:2])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.sampled_from([0.1, 0.25, 0.5, 0.75]), min_size=1, max_size=230))
def test_bands_equal_brute_force(rows, values):
    data = slots(values)
    as_of = at("2024-01-01 06:00:00")
    df = rows(SCHEMA, data)
    for options, limit in (
        ({}, mean),
        ({"median": True}, median),
        ({"minimum": True, "median": True}, lambda p: min(mean(p), median(p))),
    ):
        got = prices.price_bands(df, as_of, lowq=5, highq=7, **options)
        got = sorted(result(got.select("market_id", TS, *BANDS)), key=lambda r: r[:2])
        assert got == expected(data, as_of, 5, 7, limit)


def test_equal_prices_take_the_earliest_slots(rows):
    df = rows(SCHEMA, slots([0.3] * 6))
    got = prices.price_bands(df, "2023-01-01", lowq=2, highq=2).where("lowest is not null")
    assert [r[1] for r in result(got)] == ["2024-01-01 00:00:00", "2024-01-01 00:15:00"]


def test_short_day_has_slots_in_both_bands(rows):
    df = rows(SCHEMA, slots([0.1, 0.2, 0.3]))
    got = prices.price_bands(df, "2023-01-01")
    assert got.where("lowest is not null and highest is not null").count() == 3


def test_price_at_the_limit_is_low(rows):
    df = rows(SCHEMA, slots([0.1] * 7))
    got = prices.price_bands(df, "2023-01-01", lowq=0, highq=0)
    assert got.where("low is not null").count() == 7


def test_missing_price_is_in_no_band(rows):
    df = rows(SCHEMA, slots([0.1, None]))
    got = prices.price_bands(df, "2023-01-01").where(f"{TS} > '2024-01-01 00:00:00'").first()
    assert [got[b] for b in BANDS] == [None] * 5


@pytest.mark.parametrize("count", [92, 96, 100])
def test_days_of_any_length(rows, count):
    data = slots([i / 1000 for i in range(count)])
    got = prices.price_bands(rows(SCHEMA, data), "2023-01-01").where(f"{TS} < '2024-01-02'")
    assert got.where("lowest is not null").count() == 18


def test_two_day_window(rows):
    data = slots([0.1 + i / 10000 for i in range(96 * 5)], "2024-01-13 00:00:00")
    as_of = at("2024-01-15 12:00:00")
    assert bands.two_day_end(as_of) == at("2024-01-16 23:00:00")
    got = bands.price_window(rows(SCHEMA, data), as_of)
    times = [r[1] for r in result(got)]
    assert times[0] == "2024-01-15 00:00:00" and times[-1] == "2024-01-17 01:00:00"


LABELLED = "site_id string, label string, v double"


def test_contract_and_distract_by_label(spark):
    a = spark.createDataFrame([("s", "1", 1.0), ("s", "2", 5.0), ("s", "3", 2.0)], LABELLED)
    b = spark.createDataFrame([("s", "2", 1.0), ("s", "3", 4.0)], LABELLED)
    assert [r[2] for r in result(tariff.contract(a, b))] == [1.0, 6.0, 6.0]
    assert [r[2] for r in result(tariff.distract(a, b))] == [1.0, 4.0, 0.0]
    assert [r[2] for r in result(tariff.distract(a, b, allow_negatives=True))] == [1.0, 4.0, -2.0]


def test_alignment_at_the_end(spark):
    a = spark.createDataFrame([("s", "1", 1.0), ("s", "2", 5.0), ("s", "3", 2.0)], LABELLED)
    b = spark.createDataFrame([("s", "x", 10.0), ("s", "y", 20.0)], LABELLED)
    assert result(tariff.contract_aligned(a, b)) == [("s", 1, 22.0), ("s", 2, 15.0), ("s", 3, 1.0)]
    assert [r[2] for r in result(tariff.distract_aligned(b, a))] == [18.0, 5.0, 0.0]
    arrays = spark.sql("SELECT array(1D, 5D, 2D) AS a, array(10D, 20D) AS b")
    got = arrays.select(
        tariff.contract_arrays(F.col("a"), F.col("b")),
        tariff.distract_arrays(F.col("a"), F.col("b")),
        tariff.distract_arrays(F.col("a"), F.col("b"), allow_negatives=True),
    ).first()
    assert [list(x) for x in got] == [[1, 15, 22], [1, 0, 0], [1, -5, -18]]


FOUR = "site_id string, label string, ilo double, ihi double, xlo double, xhi double, own double"


def test_balances(spark):
    df = spark.createDataFrame(
        [("s", "1", 10.0, 4.0, 3.0, 6.0, 1.0), ("s", "2", 1.0, 0.0, 5.0, 2.0, 0.0)], FOUR
    )
    order = ["site_id", "label", "import_lo", "import_hi", "export_lo", "export_hi", "own"]
    assert result(tariff.balance_single(df).select(*order)) == [
        ("s", "1", 5.0, 0.0, 0.0, 0.0, 10.0),
        ("s", "2", 0.0, 0.0, 6.0, 0.0, 1.0),
    ]
    assert result(tariff.balance_dual(df).select(*order)) == [
        ("s", "1", 7.0, 0.0, 0.0, 2.0, 5.0),
        ("s", "2", 0.0, 0.0, 4.0, 2.0, 0.0),
    ]
    both = tariff.balance_dual(df, accumulate=True)
    assert [r.own for r in both.orderBy("label").collect()] == [8.0, 1.0]
    change = both.join(df.drop("own"), ["site_id", "label"]).select(
        (F.col("import_lo") - F.col("export_lo")) == (F.col("ilo") - F.col("xlo"))
    )
    assert all(r[0] for r in change.collect())


def test_year_month_matrix(spark):
    df = spark.createDataFrame(
        [("s", "2015-01", 329811, 0, 1), ("s", "2015-01", 5, 6, 2), ("s", "2017-12", 7, 8, 3)],
        "site_id string, label string, use bigint, expo bigint, n int",
    )
    got = tariff.year_month_matrix(df, order="n").orderBy("year").collect()
    assert [r.year for r in got] == [2015, 2016, 2017]
    assert (got[0].use_01, got[0].expo_01, got[2].use_12, got[2].expo_12) == (5, 6, 7, 8)
    assert sum(got[1][c] for c in got[1].asDict() if c[-2:].isdigit()) == 0
    assert len(got[0]) == 2 + 24


def test_zip_shortest(spark):
    a = spark.createDataFrame([("s", "1", 1.0), ("s", "2", 5.0)], LABELLED)
    b = a.where("label = '2'").withColumnRenamed("v", "w")
    assert result(tariff.zip_shortest(a, b)) == [("s", "2", 5.0, 5.0)]
