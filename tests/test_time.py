import datetime as dt

import pytest
from conftest import result
from pyspark.sql import functions as F

from energy_series.functions import energy as e
from energy_series.functions import time as t


@pytest.mark.parametrize(
    "rule, start, label",
    [
        ("5min", "2024-02-29 13:45:00", "2024-02-29 13:45:00"),
        ("15min", "2024-02-29 13:45:00", "2024-02-29 13:45:00"),
        ("H", "2024-02-29 13:00:00", "2024-02-29 13:00:00"),
        ("D", "2024-02-29 00:00:00", "2024-02-29 00:00:00"),
        ("ME", "2024-02-01 00:00:00", "2024-02-29 00:00:00"),
        ("A", "2024-01-01 00:00:00", "2024-12-31 00:00:00"),
    ],
)
def test_bucket_start_and_label(rows, rule, start, label):
    df = rows("ts timestamp_ntz", [("2024-02-29 13:47:12.5",)])
    got = df.select(
        t.bucket_start("ts", rule).alias("s"),
    ).select("s", t.bucket_label("s", rule).alias("l"))
    assert result(got) == [(start, label)]


def test_unknown_rule_is_refused():
    with pytest.raises(ValueError):
        t.rule_name("fortnight")
    with pytest.raises(ValueError):
        t.wall("now'; drop")


def test_results_do_not_depend_on_the_session_zone(spark, rows):
    df = rows("ts timestamp_ntz", [("2024-03-31 02:37:00",), ("2024-10-27 02:10:00",)])
    wanted = [
        ("2024-03-31 02:30:00", 1711852620, "31-03 02h"),
        ("2024-10-27 02:00:00", 1729995000, "27-10 02h"),
    ]
    usual = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Amsterdam"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select(
                t.bucket_start("ts", "15min").alias("b"),
                t.epoch_seconds("ts").alias("e"),
                t.strftime("ts", "%d-%m %Hh").alias("text"),
            )
            assert result(got) == wanted
            back = df.select(t.from_epoch("1"))
            assert result(back)[0] == ("1970-01-01 00:00:01",)
    finally:
        spark.conf.set("spark.sql.session.timeZone", usual)


def test_instant_round_trip(rows):
    df = rows("ts timestamp_ntz", [("2024-03-31 02:37:00.25",)])
    got = df.select(t.wall_to_instant("ts").alias("i")).select(t.instant_to_wall("i"))
    assert result(got) == [("2024-03-31 02:37:00.250000",)]


def test_quarters(spark):
    df = spark.createDataFrame([(0,), (1,), (899,), (900,), (901,)], "x bigint")
    got = df.select(
        "x", t.quarter_ceil("x"), t.quarter_end("x", 15), t.floor_to_step("x").cast("bigint")
    )
    assert result(got) == [
        (0, 0, -15, 0),
        (1, 900, 885, 0),
        (899, 900, 885, 0),
        (900, 900, 885, 900),
        (901, 1800, 1785, 900),
    ]


def test_parse_wall(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-02T03:04:05.000+01:00",),
            ("2024-01-02T03:04:05+01:00",),
            ("2024-01-02 03:04:05",),
            ("rubbish",),
            (None,),
            ("2024-13-02T03:04:05",),
        ],
        "s string",
    )
    got = [r[0] for r in df.select(t.parse_wall("s")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5)] * 3 + [None] * 3


def test_periods_before_clamps_month_ends(rows):
    df = rows("ts timestamp_ntz", [("2024-03-31 10:00:00",)])
    got = df.select(F.expr(t.periods_before("2024-03-31 10:00:00", 1, "month")))
    assert result(got) == [("2024-02-29 10:00:00",)]


def test_signed_text_rounds_half_to_even(spark):
    values = [2.5, 3.5, -2.5, 0.4, -0.4, 1234.6]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    assert [r[0] for r in df.select(e.signed_text("x")).collect()] == [
        f"{x:+.0f}" for x in values
    ]


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("a", "1.5", 3), ("b", "x", 4)], "site_id string, v string, n int")
    got = e.numeric(df, keep=["site_id"])
    assert dict(got.dtypes) == {"site_id": "string", "v": "double", "n": "int"}
    assert result(got) == [("a", 1.5, 3), ("b", None, 4)]


def test_row_expressions(spark):
    df = spark.createDataFrame(
        [(-10, 4, 3, 8), (-2, 4, 3, 4), (-2, 4, 3, 1)], "exp int, gep int, evp int, solar int"
    )
    c = F.col
    got = df.select(
        e.own_use(c("exp"), c("gep"), c("evp")), e.stored_solar(c("gep"), c("solar"))
    )
    assert [tuple(r) for r in got.collect()] == [(0, -4), (5, -4), (5, -1)]


def test_truncation_and_mean_of_present(spark):
    df = spark.createDataFrame(
        [(1.9996, 230.0, 231.1), (-1.9996, 230.0, None), (0.0, None, float("nan"))],
        "k double, a double, b double",
    )
    c = F.col
    got = df.select(
        e.truncated(c("k"), 1000),
        e.truncated(e.mean_of_present(c("a"), c("b")), 10, "int"),
    )
    assert [tuple(r) for r in got.collect()] == [(1999, 2305), (-1999, 2300), (0, None)]
