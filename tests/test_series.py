import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import at, result
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from energy_series.columns import TS
from energy_series.functions import time as t
from energy_series.operators import counters, grid, interpolate, ordered, shape
from energy_series.plans import quarter

READ = "site_id string, sample_time timestamp_ntz, x bigint"
LIGHT = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def readings(minutes_and_values, site="a", start="2024-02-28 22:50:00"):
    base = at(start)
    return [(site, base + dt.timedelta(minutes=m), v) for m, v in minutes_and_values]


def frame(df):
    out = df.toPandas().sort_values(["site_id", TS]).reset_index(drop=True)
    return out


def test_resample_is_dense(rows):
    df = rows(READ, readings([(0, 5), (3, 7), (70, 1)]))
    sums = grid.resample(df, "15min", sums=["x"])
    assert result(sums) == [
        ("a", "2024-02-28 22:45:00", 12),
        ("a", "2024-02-28 23:00:00", 0),
        ("a", "2024-02-28 23:15:00", 0),
        ("a", "2024-02-28 23:30:00", 0),
        ("a", "2024-02-28 23:45:00", 0),
        ("a", "2024-02-29 00:00:00", 1),
    ]
    means = grid.resample(df, "h", means=["x"])
    assert [r[2] for r in result(means)] == [6.0, None, 1.0]
    kept = grid.resample(df, "h", means=["x"], carry_means=True)
    assert [r[2] for r in result(kept)] == [6.0, 6.0, 1.0]


def test_empty_and_single_row(rows):
    assert result(grid.resample(rows(READ, []), "h", sums=["x"])) == []
    one = rows(READ, readings([(0, 5)]))
    assert result(counters.bucket_delta(one, ["x"], "h")) == [("a", "2024-02-28 22:00:00", 0)]


def test_all_missing_sums_to_zero(rows):
    df = rows(READ, readings([(0, None), (40, 3)]))
    assert [r[2] for r in result(grid.resample(df, "h", sums=["x"]))] == [0, 3]


def test_month_and_year_labels(rows):
    df = rows(READ, [("a", "2023-12-05 00:00:00", 1), ("a", "2024-02-10 12:00:00", 2)])
    months = result(grid.resample(df, "month", sums=["x"]))
    assert months == [
        ("a", "2023-12-31 00:00:00", 1),
        ("a", "2024-01-31 00:00:00", 0),
        ("a", "2024-02-29 00:00:00", 2),
    ]
    years = result(grid.resample(df, "year", sums=["x"]))
    assert years == [("a", "2023-12-31 00:00:00", 1), ("a", "2024-12-31 00:00:00", 2)]


def pandas_delta(data, rule):
    """Brute force with pandas, one site at a time."""
    df = pd.DataFrame(data, columns=["site_id", TS, "x"])
    parts = []
    for site, part in df.groupby("site_id"):
        part = part.sort_values(TS).set_index(TS)
        steps = part["x"].astype("float64").diff().resample(rule).sum()
        if len(steps) > 1:
            steps = steps.iloc[1:]
        parts += [(site, str(ts.to_pydatetime()), int(v)) for ts, v in steps.items()]
    return sorted(parts)


series = st.lists(
    st.tuples(
        st.integers(0, 60 * 50), st.one_of(st.none(), st.integers(-1000, 1000)), st.sampled_from("ab")
    ),
    min_size=1,
    max_size=40,
    unique_by=lambda r: (r[0], r[2]),
)


@LIGHT
@given(data=series)
def test_bucket_delta_equals_brute_force_with_missing_readings(rows, data):
    base = at("2024-02-28 00:00:00")
    data = [(s, base + dt.timedelta(minutes=m), v) for m, v, s in data]
    for rule, pandas_rule in (("15min", "15min"), ("d", "D")):
        got = result(counters.bucket_delta(rows(READ, data), ["x"], rule))
        assert got == pandas_delta(data, pandas_rule)


@LIGHT
@given(data=series)
def test_complete_counters_take_the_short_plan_to_the_same_result(rows, data):
    base = at("2024-02-28 00:00:00")
    data = [(s, base + dt.timedelta(minutes=m), v or 0) for m, v, s in data]
    df = rows(READ, data)
    for rule in ("15min", "h"):
        short = counters.bucket_delta(df, ["x"], rule, holes=False)
        assert result(short) == result(counters.bucket_delta(df, ["x"], rule))


def test_missing_reading_loses_both_neighbours(rows):
    df = rows(READ, readings([(0, 10), (20, None), (40, 30), (60, 45)]))
    assert [r[2] for r in result(counters.bucket_delta(df, ["x"], "h"))] == [15]


def test_deltas_add_up_to_last_minus_first(rows):
    data = readings([(m, m * m) for m in range(0, 600, 7)])
    df = rows(READ, data)
    total = counters.bucket_delta(df, ["x"], "15min", drop_first=False).agg(F.sum("x")).first()[0]
    assert total == data[-1][2] - data[0][2]


def test_hours_then_days_equal_days(rows):
    df = rows(READ, readings([(m, m) for m in range(0, 5000, 77)]))
    hours = grid.resample(df, "h", sums=["x"])
    assert result(grid.resample(hours, "d", sums=["x"])) == result(
        grid.resample(df, "d", sums=["x"])
    )


@LIGHT
@given(data=series)
def test_carry_forward_equals_brute_force(rows, data):
    base = at("2024-02-28 00:00:00")
    data = [(s, base + dt.timedelta(minutes=m), v) for m, v, s in data]
    want = pd.DataFrame(data, columns=["site_id", TS, "x"]).sort_values(["site_id", TS])
    want["x"] = want.groupby("site_id")["x"].ffill()
    got = frame(ordered.carry_forward(rows(READ, data), ["x"]))
    np.testing.assert_array_equal(
        got["x"].to_numpy("float64"), want["x"].to_numpy("float64", na_value=np.nan)
    )


@LIGHT
@given(data=series)
def test_row_delta_equals_brute_force(rows, data):
    base = at("2024-02-28 00:00:00")
    data = [(s, base + dt.timedelta(minutes=m), v) for m, v, s in data]
    want = pd.DataFrame(data, columns=["site_id", TS, "x"]).sort_values(["site_id", TS])
    want["x"] = want["x"].astype("float64")
    want["x"] = want.groupby("site_id")["x"].diff()
    got = frame(ordered.row_delta(rows(READ, data), ["x"]))
    np.testing.assert_array_equal(
        got["x"].to_numpy("float64", na_value=np.nan), want["x"].to_numpy()
    )


def test_running_total_over_slices(rows):
    data = readings([(m, m % 5) for m in range(0, 4000, 13)])
    got = frame(ordered.running_total(rows(READ, data), ["x"]))
    assert got["x"].tolist() == np.cumsum([v for _, _, v in data]).tolist()


def test_one_site_with_most_rows_gives_the_same_result(rows):
    data = readings([(m, m * 3) for m in range(0, 6000)], "hot")
    data += readings([(m, m) for m in range(0, 6000, 100)], "b")
    df = rows(READ, data)
    got = result(counters.bucket_delta(df, ["x"], "h"))
    assert got == pandas_delta(data, "h")
    shuffled = df.orderBy(F.rand(7)).repartition(5)
    assert result(counters.bucket_delta(shuffled, ["x"], "h")) == got


@LIGHT
@given(
    xs=st.lists(st.integers(0, 50_000), min_size=1, max_size=25, unique=True),
    start=st.integers(-10, 30),
)
def test_interpolation_equals_numpy(spark, xs, start):
    xs = sorted(xs)
    ys = [(7 * x) % 1013 for x in xs]
    df = spark.createDataFrame([("a", x, y) for x, y in zip(xs, ys)], "site_id string, epoch bigint, y bigint")
    low, high = start * 900, start * 900 + 40_000
    got = interpolate.interpolate(df, F.lit(low), F.lit(high)).orderBy("epoch").toPandas()
    points = np.arange(low, high, 900)
    assert got["epoch"].tolist() == points.tolist()
    np.testing.assert_array_equal(got["y"].to_numpy(), np.interp(points, xs, ys))


def test_fallback_for_sites_without_samples(spark):
    samples = spark.createDataFrame([("a", 0, 5)], "site_id string, epoch bigint, y bigint")
    sites = spark.createDataFrame([("a",), ("b",), ("b",)], "site_id string")
    got = result(interpolate.with_fallback(samples, sites, 2019))
    assert got == [("a", 0, 5), ("b", 1546300800, 0), ("b", 1577836800, 0)]


def test_timeline(spark, rows):
    anchors = rows("site_id string, latest timestamp_ntz", [("a", "1970-01-02 00:10:00")])
    got = [r[1] for r in result(grid.timeline(anchors, 1, "hour"))]
    assert got == list(range((87000 - 3600) // 900 * 900, 87000, 900))
    start, stop = grid.timeline_bounds(None, 1, "year", year=2023)
    row = spark.range(1).select(start, stop).first()
    assert row[1] == 1704067200 and row[0] == (1704067200 - 366 * 86400) // 900 * 900


def test_labels_across_new_year_keep_their_values(rows):
    df = rows(
        READ,
        [
            ("a", "2023-12-31 20:00:00", 1),
            ("a", "2023-12-31 20:45:00", 4),
            ("a", "2024-01-01 08:00:00", 10),
            ("a", "2024-01-01 08:45:00", 17),
        ],
    )
    label = t.strftime(TS, "%m-%d %Hh")
    got = counters.label_delta(df, "x", label).orderBy("starts").drop("starts")
    assert [tuple(r) for r in got.collect()] == [("a", "12-31 20h", 3), ("a", "01-01 08h", 7)]
    sums = counters.label_sum(df, "x", label).orderBy("starts").drop("starts")
    assert [tuple(r) for r in sums.collect()] == [("a", "12-31 20h", 1), ("a", "01-01 08h", 10)]


def test_falling_counter_is_clamped_per_label_only(rows):
    df = rows(READ, [("a", "2024-01-01 00:00:00", 9), ("a", "2024-01-01 01:00:00", 2)])
    assert result(counters.label_delta(df, "x", t.strftime(TS, "%Y")))[0][2] == 0
    assert result(counters.bucket_delta(df, ["x"], "d"))[0][2] == -7


def test_tail_and_tick_labels(rows):
    df = rows(READ, readings([(60 * i, i) for i in range(85)]))
    hours = grid.resample(df, "h", sums=["x"])
    assert [r[2] for r in result(shape.tail(hours, 3))] == [82, 83, 84]
    ticks = shape.tick_labels(hours, "%d-%m %Hh").orderBy(TS).collect()
    shown = [i for i, r in enumerate(ticks) if r["tick"]]
    assert shown == list(range(0, 85, 2))
    assert ticks[0]["tick"] == "28-02 22h"
    few = shape.tick_labels(hours.where("x < 5"), "%Y").collect()
    assert all(r["tick"] for r in few)


def test_shaping(rows):
    df = rows("site_id string, sample_time timestamp_ntz, b int, a int", [("s", "2024-01-01", 1, 2)])
    assert shape.sorted_columns(df).columns == ["site_id", TS, "a", "b"]
    assert shape.without(df, ["a", "zz"]).columns == ["site_id", TS, "b"]
    assert shape.renamed(df, {"a": "leveren"}).columns[-1] == "leveren"
    assert shape.preview(df).count() == shape.in_time_order(df).count() == 1


def test_battery_mean_of_means_is_not_the_plain_mean(rows):
    df = rows(
        "site_id string, sample_time timestamp_ntz, soc int",
        [("a", "2024-01-01 00:00:00", 100), ("a", "2024-01-01 00:05:00", 200),
         ("a", "2024-01-01 00:20:00", 900), ("a", "2024-01-03 00:20:00", 500)],
    )
    got = [r[2] for r in result(quarter.battery_mean_of_means(df, "D"))]
    assert got == [pytest.approx(5.25), None, 5.0]


def test_prices_fill_forward(rows):
    df = rows(
        "market_id string, sample_time timestamp_ntz, price double",
        [("m", "2024-01-01 00:00:00", 0.1), ("m", "2024-01-01 00:10:00", 0.3),
         ("m", "2024-01-01 00:45:00", 0.5)],
    )
    assert [r[2] for r in result(quarter.price_quarters(df))] == [0.2, 0.2, 0.2, 0.5]
    holed = df.withColumn("price", F.when(F.col("price") != 0.3, F.col("price")))
    assert [r[2] for r in result(quarter.price_quarters(holed, ""))] == [0.1, 0.1, 0.5]
