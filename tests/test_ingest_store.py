import json

import pytest
from conftest import result


from energy_series import schemas
from energy_series.columns import TS
from energy_series.operators import gaps, ingest
from energy_series.sources import payloads, tables

DEVICE = dict(energy_import_kwh=2.0, energy_export_kwh=1.0009, voltage_v=230.0, frequency_hz=50.0)


def telegram(ts, **devices):
    return {"site_id": "s", "sample_time": ts, **devices}


def land(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in documents))
    return str(folder)


def test_meter_telegrams(spark, tmp_path):
    ev2 = {**DEVICE, "energy_export_kwh": 3.0, "voltage_v": 231.0}
    path = land(
        tmp_path / "meter",
        "a.json",
        telegram("2024-01-01T00:00:10", p1={"energy_import_kwh": 9.0, "energy_export_kwh": 4.5}),
        telegram("2024-01-01T00:00:40", ev=DEVICE, pv=DEVICE),
        telegram("2024-01-01T05:01:10", ev=ev2),
    )
    got = ingest.translate_meter(payloads.read_json(spark, "meter", path))
    first, second, third = got.orderBy(TS).collect()
    assert (first.exp, first.imp, first.gen, first.v1) == (-4500, 9000, None, None)
    assert (second.exp, second.imp) == (-4500, 9000)
    assert (second.gen, second.gep, second.evn, second.evp) == (-2000, 1000, -2000, 1000)
    assert (second.v1, second.frq, second.sample_epoch) == (2300, 500, 1704067240)
    assert (third.evp, third.gep, third.v1) == (3000, 1000, 2305)


def test_battery_telegrams(spark, tmp_path):
    doc = telegram(
        "2024-01-01T00:00:10",
        b1={"sessy": {"state_of_charge": 0.5}},
        b2={"sessy": {"state_of_charge": 0.25007}},
    )
    path = land(tmp_path / "battery", "a.json", doc)
    got = ingest.translate_battery(payloads.read_json(spark, "battery", path)).first()
    assert (got.soc, got.soh) == (3750, 1000)


def price_document(today, tomorrow=None):
    info = {"today": today} | ({"tomorrow": tomorrow} if tomorrow is not None else {})
    home = {"currentSubscription": {"priceInfo": info}}
    return {"market_id": "m", "data": {"viewer": {"homes": [home]}}}


def test_price_documents(spark, tmp_path):
    path = land(
        tmp_path / "prices",
        "a.json",
        price_document(
            [
                {"startsAt": "2024-01-01T00:00:00.000+01:00", "total": 0.25},
                {"startsAt": "2024-01-01T00:15:00+01:00", "total": "0.5"},
                {"startsAt": "2024-01-01T00:30:00.000+01:00", "total": "n/a"},
                {"startsAt": "2024-01-01T00:45:00.000+01:00"},
            ],
            [{"startsAt": "2024-01-02T00:00:00.000+01:00", "total": 1}],
        ),
        price_document([]),
        {"market_id": "m", "data": {"viewer": {"homes": []}}},
        {"market_id": "m", "errors": "none"},
    )
    documents = payloads.read_json(spark, "prices", path)
    assert [(r[1], r[3]) for r in result(payloads.price_rows(documents))] == [
        ("2024-01-01 00:00:00", 0.25),
        ("2024-01-01 00:15:00", 0.5),
        ("2024-01-02 00:00:00", 1.0),
    ]
    assert sorted(r.total or "" for r in payloads.price_rejects(documents).collect()) == ["", "n/a"]


def test_solar_document(spark, tmp_path):
    values = [38.0, 191.0, 390.0, 1059.0, 753.0, 382.0, 239.0, 69.0, 0.0, None]
    items = [{"date": f"2024-11-26 {8 + i:02d}:00:00", "value": v} for i, v in enumerate(values)]
    path = land(tmp_path / "solar", "a.json", {"site_id": "s", "energy": {"values": items}})
    got = result(payloads.solar_rows(payloads.read_json(spark, "solar", path)))
    assert [r[3] for r in got] == [38, 191, 390, 1059, 753, 382, 239, 69, 0, 0]
    assert got[0][2] == 1732608000


def test_charger_document(spark, tmp_path):
    totals = dict(
        site_id="s", yr=2021, mon=7, dom=25, hr=6, min=1, exp=16560, gen=480, gep=2409600, h1b=123,
        h1d=14706420, imp=13285500, v1=2446, frq=5006,
    )
    midnight = {k: v for k, v in totals.items() if k not in ("hr", "min")}
    path = land(tmp_path / "charger", "a.json", totals, midnight)
    got = payloads.charger_rows(payloads.read_json(spark, "charger", path)).orderBy(TS).collect()
    assert [str(r.sample_time) for r in got] == ["2021-07-25 00:00:00", "2021-07-25 06:01:00"]
    assert got[1].gep_kwh == pytest.approx(2409600 / 3.6e6) and got[1].exp_w == 276.0
    assert (got[1].volt, got[1].hertz) == (pytest.approx(244.6), pytest.approx(50.06))


SAMPLES = (
    "site_id string, sample_time timestamp_ntz, exp bigint, imp bigint, gen bigint, gep bigint, "
    "evn bigint, evp bigint, v1 int, frq int"
)


def sample(ts, n, v1=2300):
    return ("s", ts, -n, n, -n, n, -n, n, v1, 500)


def test_compaction_shifts_samples_back(rows):
    df = rows(
        SAMPLES,
        [
            sample("2024-01-01 00:05:04", 10, 2301),
            sample("2024-01-01 00:05:05", 20),
            sample("2024-01-01 00:09:59", 30),
            sample("2024-01-01 00:10:04", 40, 2302),
        ],
    )
    got = ingest.compact_meter(df).orderBy(TS).collect()
    assert [str(r.sample_time) for r in got] == ["2024-01-01 00:00:00", "2024-01-01 00:05:00"]
    assert (got[0].imp, got[0].exp, got[0].v1) == (10, -10, 2301)
    # The highest reading of a negative counter is its earliest one.
    assert (got[1].imp, got[1].exp, got[1].v1) == (40, -20, 2300)
    assert got[1].sample_epoch == 1704067500
    left = ingest.compaction_remainder(df)
    assert [r[1] for r in result(left)] == [
        "2024-01-01 00:05:04", "2024-01-01 00:05:05", "2024-01-01 00:09:59", "2024-01-01 00:10:04",
    ]


def test_future_rows_are_rejected(spark):
    df = spark.createDataFrame([(x,) for x in (0, 899, 900, 901)], "sample_epoch bigint")
    got = ingest.not_in_future(df, "1970-01-01 00:00:00")
    assert [r[0] for r in result(got)] == [0, 899]


PRODUCTION = "site_id string, sample_time timestamp_ntz, solar bigint, seq int"


def test_upsert(spark, rows, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "staging")
    one = rows(
        PRODUCTION,
        [("s", "2024-01-01 00:00:00", 1, 1), ("s", "2024-01-01 00:00:00", 2, 2),
         ("s", "2024-01-02 00:00:00", 3, 1), ("t", "2024-01-03 00:00:00", 4, 1)],
    )
    two = rows(PRODUCTION, [("s", "2024-01-02 00:00:00", 30, 1), ("s", "2024-01-02 12:00:00", 5, 1)])
    tables.upsert(one, path, staging, 0, "seq")
    tables.upsert(two, path, staging, 1, "seq")
    want = [
        ("s", "2024-01-01 00:00:00", 2),
        ("s", "2024-01-02 00:00:00", 30),
        ("s", "2024-01-02 12:00:00", 5),
        ("t", "2024-01-03 00:00:00", 4),
    ]
    stored = lambda: result(spark.read.parquet(path).select("site_id", TS, "solar"))
    assert stored() == want
    tables.upsert(two, path, staging, 1, "seq")
    assert stored() == want
    tables.upsert(two.limit(0), path, staging, 2, "seq")
    assert stored() == want


def test_interrupted_publication_is_repeated(spark, rows, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "t"), str(tmp_path / "staging")
    one = rows(PRODUCTION, [("s", "2024-01-01 00:00:00", 1, 1), ("s", "2024-01-01 01:00:00", 2, 1)])
    two = rows(PRODUCTION, [("s", "2024-01-01 01:00:00", 9, 1)])
    tables.upsert(one, path, staging, 0, "seq")

    def broken(df, target, ts=TS, mode="overwrite"):
        write(spark.createDataFrame([], one.drop("seq").schema), target, ts, mode)
        for part in (tmp_path / "t").glob("sample_date=*/*.parquet"):
            part.rename(tmp_path / part.name)
        raise RuntimeError("crash while partitions are replaced")

    write = tables.write_table
    monkeypatch.setattr(tables, "write_table", broken)
    with pytest.raises(RuntimeError):
        tables.upsert(two, path, staging, 1, "seq")
    monkeypatch.setattr(tables, "write_table", write)
    tables.upsert(two, path, staging, 1, "seq")
    got = result(spark.read.parquet(path).select("site_id", TS, "solar"))
    assert got == [("s", "2024-01-01 00:00:00", 1), ("s", "2024-01-01 01:00:00", 9)]


def test_tables_round_trip(spark, rows, tmp_path):
    for name in schemas.TABLES:
        empty = tables.create_table(spark, name, str(tmp_path / name))
        assert empty.count() == 0 and empty.columns[-1] == tables.PARTITION
    seed = rows(
        schemas.PRODUCTION_CUMULATIVE,
        [("1508443", "2020-02-20 09:08:22", 1582186102, 0),
         ("1508443", "2020-02-21 23:30:00", 1582327800, 510),
         ("1508443", "2020-02-22 09:30:00", 1582363800, 641)],
    )
    path = str(tmp_path / "production_cumulative")
    tables.write_table(seed, path)
    stored = tables.read_table(spark, "production_cumulative", path)
    assert [r[3] for r in result(stored)] == [0, 510, 641]
    window = tables.window_scan(stored, "2020-02-22 00:00:00", 1)
    assert [r[3] for r in result(window)] == [510]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sample_date" in plan
    assert "PushedFilters: [IsNotNull(sample_time), GreaterThanOrEqual(sample_time" in plan
    tables.write_rows_json(stored, str(tmp_path / "dump"))
    assert spark.read.json(str(tmp_path / "dump")).count() == 3
    tables.write_report(stored, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 3
    assert [r[3] for r in result(tables.newest_rows(stored))] == [641]
    assert tables.retained(stored, "2040-03-07 23:30:00").count() == 2


def test_ranges(rows):
    df = rows(
        "n int, sample_time timestamp_ntz",
        [(1, "2023-12-31 23:59:59"), (2, "2024-01-01 00:00:00"), (3, "2024-03-30 12:00:00"),
         (4, "2024-04-29 12:00:00"), (5, "2024-04-30 11:00:00"), (6, "2025-01-01 00:00:00")],
    )

    def kept(**options):
        got = tables.range_scan(df, "2024-04-30 12:00:00", 1, "month", **options)
        return [r[0] for r in result(got)]

    assert kept() == [3, 4, 5, 6]
    assert kept(from_start_of_year=True) == [2, 3, 4, 5, 6]
    assert 5 not in kept(include_today=False) and 4 in kept(include_today=False)
    assert kept(year=2024) == [2, 3, 4, 5, 6]


def test_gaps_and_backfill(rows):
    df = rows(
        "site_id string, sample_time timestamp_ntz",
        [("s", "2024-01-01 00:00:00"), ("s", "2024-01-01 00:15:00"), ("s", "2024-01-01 00:46:00"),
         ("s", "2024-01-05 03:00:00"), ("t", "2024-01-01 00:00:00")],
    )
    holes = gaps.gaps(df)
    assert result(holes) == [
        ("s", "2024-01-01 00:15:00", "2024-01-01 00:46:00", 2),
        ("s", "2024-01-01 00:46:00", "2024-01-05 03:00:00", 392),
    ]
    plan = gaps.backfill_plan(holes.where("missing > 2"), "2024-01-03 20:00:00")
    assert [r[3:] for r in result(plan)] == [
        (0, "2024-01-01 00:46:00", "2023-12-31 00:00:00", "2024-01-02 00:00:00"),
        (1, "2024-01-02 00:46:00", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        (2, "2024-01-03 00:46:00", "2024-01-02 00:00:00", "2024-01-04 00:00:00"),
        (3, "2024-01-03 20:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"),
    ]
    assert result(gaps.latest_point(df))[0] == ("s", "2024-01-05 03:00:00")
    with pytest.raises(ValueError):
        gaps.gaps(df, "month")


def test_last_write_wins_has_one_row_per_key(rows):
    df = rows(PRODUCTION, [("s", "2024-01-01 00:00:00", i, i) for i in range(50)])
    assert result(tables.last_write_wins(df.repartition(7), "seq")) == [
        ("s", "2024-01-01 00:00:00", 49)
    ]

