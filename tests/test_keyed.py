"""Compaction in keyed state: each site has its own clock."""

import datetime as dt

from conftest import at, result
from test_stream import SAMPLES, land_in_order, samples

from energy_series.operators import ingest
from energy_series.sources.buckets import BucketTable
from energy_series.streaming import keyed

CELLS = "site_id string, sample_time timestamp_ntz, soc int, soh int"


def run(spark, tmp_path, schema, kind, **more):
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    table = BucketTable(spark, str(tmp_path / "out"), buckets=4)
    keyed.keyed_stream(source, kind, table, str(tmp_path / "work"), **more).awaitTermination()
    return table.read()


def test_a_fast_clock_drops_nothing_elsewhere(spark, rows, tmp_path):
    """Three batches share buckets; another site's clock runs years ahead in the first."""
    data = samples(40) + [("fast", at("2035-01-01 00:00:00"), -1, 1, -1, 1, -1, 1, 2300, 500)]
    late = [("fast", at("2024-01-01 00:00:00"), -2, 2, -2, 2, -2, 2, 2300, 500)]
    empty = [("s", at("2024-01-01 00:00:30"), None, None, None, None, None, None, None, None), (None, at("2024-01-01 00:00:30"), *[1] * 8)]
    parts = [data[::2] + data[-1:], data[1:-1:2] + empty, samples(10, start="2024-01-01 00:01:11") + late]
    land_in_order([rows(SAMPLES, p) for p in parts], tmp_path / "in")
    got = run(spark, tmp_path, SAMPLES, keyed.METER)
    every = [r for p in parts for r in p if r[0] and r not in late]
    want = ingest.compact_meter(rows(SAMPLES, list(dict.fromkeys(every))))
    assert result(got.select(*want.columns)) == result(want)
    kept = spark.read.parquet(str(tmp_path / "work" / "late")).collect()
    assert [(r.site_id, str(r.sample_time), r.imp) for r in kept] == [("fast", "2023-12-31 23:55:00", 2)]


def test_battery_state_over_three_batches(spark, rows, tmp_path):
    data = [(s, at("2024-01-01 00:01:00") + dt.timedelta(seconds=50 * i), i * 7, None if i % 5 else 1000) for i in range(30) for s in "ab"]
    land_in_order([rows(CELLS, data[i::3]) for i in range(3)], tmp_path / "in")
    want = ingest.compact_battery(rows(CELLS, data))
    got = run(spark, tmp_path, CELLS, keyed.BATTERY).select(*want.columns)
    assert result(got) == result(want)


def test_buckets_leave_the_state_and_silent_sites_are_forgotten(spark, rows, tmp_path):
    row = lambda time, x: ("s", at(time), x, 1000)
    parts = [[row("2024-01-01 00:01:00", 1)], [row("2024-01-01 08:01:00", 2)], [row("2024-01-01 00:02:00", 9), row("2024-01-01 08:02:00", 4)]]
    land_in_order([rows(CELLS, p) for p in parts], tmp_path / "in")
    # Both buckets are of one slice, so they share a clock; an hour is kept.
    got = result(run(spark, tmp_path, CELLS, keyed.BATTERY, retention=3600))
    assert [(r[1], r[3]) for r in got] == [("2024-01-01 00:00:00", 1.0), ("2024-01-01 08:00:00", 3.0)]
    assert [r.soc for r in spark.read.parquet(str(tmp_path / "work" / "late")).collect()] == [9.0]


def test_a_timer_clears_a_silent_site(spark, rows, tmp_path):
    row = lambda site, x: (site, at("2024-01-01 00:01:00"), x, 1000)
    land_in_order([rows(CELLS, [row(s, x)]) for s, x in (("s", 1), ("other", 5), ("s", 3))], tmp_path / "in")
    got = result(run(spark, tmp_path, CELLS, keyed.BATTERY, expiry=0))
    assert [(r[0], r[3]) for r in got] == [("other", 5.0), ("s", 3.0)]  # nothing of the first batch is left
