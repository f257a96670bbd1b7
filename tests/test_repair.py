"""Streams that repair what late telegrams change: results, what is read and what is written."""

import datetime as dt
import random

import pytest
from conftest import at, result
from test_meters import BATCHES, expected, land, stream, telegram

from energy_series.columns import TS
from energy_series.operators import ingest, ladder
from energy_series.sources import buckets, payloads
from energy_series.streaming import repair


def run(spark, tmp_path, kind=repair.METER, source=None):
    source = source if source is not None else stream(spark, tmp_path / "in")
    out, work = str(tmp_path / "out"), str(tmp_path / "work")
    repair.repair_stream(source, kind, out, work, buckets=4).awaitTermination()
    return repair.compacted_rows(spark, out, buckets=4)


def files(folder):
    return {p for p in folder.rglob("*.parquet") if "versions" not in p.parts}


def test_telegrams_of_any_age_reach_the_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, batch in enumerate([BATCHES[0] + BATCHES[1], BATCHES[2], BATCHES[3] + BATCHES[4]]):
        land(tmp_path / "in", n, batch)
    got, want = run(spark, tmp_path).read(), expected(spark, tmp_path, BATCHES)
    assert result(got.select(*want.columns)) == result(want)
    rejected = spark.read.parquet(str(tmp_path / "work" / "rejects"))
    assert [r.site_id for r in rejected.collect()] == [None]


def test_random_deliveries_equal_the_batch(spark, tmp_path):
    rng, base = random.Random(3), at("2023-11-20 23:50:00")
    every = []
    for i in range(120):
        time = base + dt.timedelta(minutes=rng.choice([3, 47, 500, 1440, 9_000]) * rng.randrange(1, 30))
        silent = rng.sample(["ev", "pv", "p1"], rng.choice([0, 1, 2, 2, 3]))
        shown = {d: float(i) for d in ("ev", "pv", "p1") if d not in silent}
        every.append(telegram(rng.choice("aab"), time.isoformat(), **shown))
    batches = [every[:80], every[80:]]
    (tmp_path / "in").mkdir()
    for n, batch in enumerate(batches):
        one = {(d["site_id"], d["sample_time"]): d for d in batch}
        batches[n] = list(one.values())
        land(tmp_path / "in", n, batches[n])
    got, want = run(spark, tmp_path).read(), expected(spark, tmp_path, batches)
    assert result(got.select(*want.columns)) == result(want)


@pytest.mark.parametrize(("table", "when"), [("out", "_commit")])
def test_a_batch_that_was_cut_off_is_repeated(spark, tmp_path, monkeypatch, table, when):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", 0, BATCHES[0] + BATCHES[1])
    run(spark, tmp_path)
    land(tmp_path / "in", 1, BATCHES[2])
    real = getattr(buckets.BucketTable, when)

    def cut_off(self, *more):
        if self.path.endswith(table):
            raise OSError("lost")
        real(self, *more)

    monkeypatch.setattr(buckets.BucketTable, when, cut_off)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path)
    monkeypatch.undo()
    got, want = run(spark, tmp_path).read(), expected(spark, tmp_path, BATCHES[:3])
    assert result(got.select(*want.columns)) == result(want)


def test_a_row_a_year_late_rewrites_the_days_up_to_the_next_reading(spark, tmp_path):
    (tmp_path / "in").mkdir()
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 12) for d in (1, 2, 3, 4)]
    others = [telegram(site, f"{d}T12:00:00", ev=1.0, pv=1.0, p1=1.0) for site in "abcdef" for d in days]
    # On the third day only the charger reports, so p1 stays known for a day more.
    land(tmp_path / "in", 0, others + [telegram("g", f"{d}T12:00:00", ev=1.0, **({} if d == days[2] else {"p1": 1.0, "pv": 1.0})) for d in days])
    table = run(spark, tmp_path)
    before, version = files(tmp_path), table.version()
    land(tmp_path / "in", 1, [telegram("g", "2024-01-02T18:00:00", p1=5.0), telegram("a", "2034-01-01T00:00:00", ev=2.0)])
    table = run(spark, tmp_path)
    added = [p for p in files(tmp_path) - before if p.is_relative_to(tmp_path / "out")]
    assert {p.parts[-3] for p in added} == {"part=2024-01-02", "part=2024-01-03", "part=2033-12-31"}
    assert not before - files(tmp_path)
    changed = table.log().where(f"part IS NOT NULL AND v > {version}").collect()
    assert {(str(r.part), r.first, r.n_rows) for r in changed} == {
        ("2024-01-02", "g", 1), ("2024-01-03", "g", 1), ("2033-12-31", "a", 1),
    }
    shown = {str(r[TS]): r.imp for r in table.read(sites=["g"]).collect()}
    assert [shown[f"2024-01-0{d} 11:55:00"] for d in (1, 2, 3, 4)] == [1000, 1000, 5000, 1000]


def test_ten_years_of_known_readings_are_a_few_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    start = dt.datetime(2014, 1, 3, 12)
    days = [start + dt.timedelta(days=20 * i) for i in range(180)]
    for n, site in enumerate("a"):
        land(tmp_path / "in", n, [telegram(site, x.isoformat(), **({"ev": float(i)} if i % 25 else {"p1": 1.0, "pv": 2.0})) for i, x in enumerate(days)])
    run(spark, tmp_path)
    work = repair.Repair(spark, repair.METER, str(tmp_path / "out"), str(tmp_path / "work"), buckets=4)
    day = spark.createDataFrame([("a", at("2023-06-15 00:00:00"))], "site_id string, sample_time timestamp_ntz")
    steps = work.steps(work.rows.places(day))
    opened = [f for rung in steps.values() for f in rung.inputFiles()]
    stored = [p for p in files(tmp_path / "work") if "rungs-d" in str(p)]
    assert len(opened) <= 6 and len(stored) > 70
    known = ladder.known_before(day, steps, ["evp", "imp"]).first()
    earlier = [i for i, x in enumerate(days) if x < dt.datetime(2023, 6, 15)]
    assert known.evp == 500 * max(i for i in earlier if i % 25) and known.imp == 1000
    upcoming = ladder.next_after(day, steps, ["evp", "imp"]).first()
    later = [i for i, x in enumerate(days) if x > dt.datetime(2023, 6, 16)]
    assert upcoming.evp == days[min(i for i in later if i % 25)]
    assert upcoming.imp is None or upcoming.imp == days[min(i for i in later if not i % 25)]


def test_battery_telegrams_of_any_age(spark, tmp_path):
    def charge(site, time, **units):
        return {"site_id": site, "sample_time": time, **{b: {"sessy": {"state_of_charge": x}} for b, x in units.items()}}

    batches = [
        [charge("a", f"2024-01-01T00:0{m}:07", b1=0.5, b2=m / 16) for m in range(8)] + [charge("fast", "2040-01-01T00:00:00", b1=1.0, b2=1.0)],
        [charge("a", "2024-01-01T00:03:30", b1=0.25, b2=0.75), charge("a", "2024-01-01T00:04:07", b1=0.125)],
        [charge("a", "2023-12-31T23:59:59", b1=0.25, b2=0.5), charge("fast", "2024-01-01T00:00:00", b1=0.0, b2=0.5)],
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "all").mkdir()
    for n, batch in enumerate(batches):
        land(tmp_path / "in", n, batch)
    like = payloads.stream_json(spark, "battery", str(tmp_path / "in"))
    source = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    got = run(spark, tmp_path, repair.BATTERY, source).read()
    last = {(d["site_id"], d["sample_time"]): d for batch in batches for d in batch}
    land(tmp_path / "all", 0, list(last.values()))
    want = ingest.compact_battery(ingest.translate_battery(payloads.read_json(spark, "battery", str(tmp_path / "all"))))
    assert result(got.select(*want.columns)) == result(want)
    assert not (tmp_path / "work" / "rungs-d").exists()


# The tables themselves

ROWS = "site_id string, sample_time timestamp_ntz, x int"


def table_of(spark, tmp_path, **more):
    return buckets.BucketTable(spark, str(tmp_path / "t"), buckets=4, **more)


def test_a_batch_writes_its_own_rows_only(spark, rows, tmp_path):
    table = table_of(spark, tmp_path)
    many = [(s, f"2024-01-0{d} 0{h}:00:00", 1) for s in "abcdefgh" for d in (1, 2, 3) for h in range(9)]
    table.upsert(rows(ROWS, many), "w", 0)
    before = files(tmp_path)
    table.upsert(rows(ROWS, [("c", "2024-01-02 03:00:00", 2)]), "w", 1)
    added = files(tmp_path) - before
    assert len(added) == 1 and before < files(tmp_path)
    assert {p.parts[-3] for p in added} == {"part=2024-01-02"}
    got = result(table.read())
    assert len(got) == len(many) and [r for r in got if r[2] == 2] == [("c", "2024-01-02 03:00:00", 2)]


def test_readers_see_a_version_as_a_whole(spark, rows, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.upsert(rows(ROWS, [("a", "2024-01-01 00:00:00", 1)]), "w", 0)
    old = table.read()
    seen = []
    commit = buckets.BucketTable._commit

    def slow(self, *more):
        seen.append(result(table.read()))  # the change files are there, the version is not
        commit(self, *more)

    monkeypatch.setattr(buckets.BucketTable, "_commit", slow)
    table.upsert(rows(ROWS, [("a", "2024-01-01 00:00:00", 2), ("b", "2024-01-01 00:00:00", 3)]), "w", 1)
    first = [("a", "2024-01-01 00:00:00", 1)]
    assert seen == [first] and result(old) == first and result(table.read(version=1)) == first
    assert result(table.read()) == [("a", "2024-01-01 00:00:00", 2), ("b", "2024-01-01 00:00:00", 3)]


def test_many_versions_compaction_and_vacuum(spark, rows, tmp_path):
    table = table_of(spark, tmp_path)
    want = {}
    for batch in range(20):  # over a snapshot
        data = [("ab"[(batch + i) % 2], f"2024-01-01 00:00:{(batch * 3 + i) % 7:02d}", batch) for i in range(4)]
        table.upsert(rows(ROWS, data), "w", batch)
        want |= {(s, ts): x for s, ts, x in data}
        if batch == 9:
            assert table.compact(3) > 10 and table.compact(3) == table.version()
        table.upsert(rows(ROWS, data), "w", batch)
    assert {(s, ts): x for s, ts, x in result(table.read())} == want
    assert table.version_of("w", 19) == 21 and table.version_of("w", 20) is None
    latest = table.compact(2)
    assert table.entries().count() == 2 and table.vacuum(1) > 10
    assert len({p.parent for p in files(tmp_path)}) == 2
    assert {(s, ts): x for s, ts, x in result(table.read(version=latest))} == want
    table.upsert(rows(ROWS, data), "w", 19)
    assert table.version() == latest


def test_a_window_opens_its_own_files(spark, rows, tmp_path):
    table = table_of(spark, tmp_path)
    data = [(s, f"2024-01-{d:02d} 12:00:00", d) for s in "abcdefghij" for d in range(1, 29)]
    table.upsert(rows(ROWS, data), "w", 0)
    table.upsert(rows(ROWS, [("a", "2024-01-05 12:00:00", 50)]), "w", 1)
    got = table.read(low="2024-01-04 00:00:00", high="2024-01-06 12:00:00", sites=["a", "zz"])
    assert [r[2] for r in result(got)] == [4, 50, 6]
    assert len(got.inputFiles()) <= 7  # three days of two buckets, one of them changed
    assert table.read(low="2030-01-01 00:00:00").count() == 0


def test_null_keys_empty_batches_and_other_layouts(spark, rows, tmp_path):
    table = table_of(spark, tmp_path)
    assert table.read(like=rows(ROWS, [])).count() == 0
    table.upsert(rows(ROWS, []), "w", 0)
    assert table.version() == 1 and table.read().columns == ["site_id", "sample_time", "x"]
    with pytest.raises(Exception, match="NULL key"):
        table.upsert(rows(ROWS, [("a", None, 1)]), "w", 1)
    with pytest.raises(Exception, match="NULL key"):
        table.upsert(rows(ROWS, [(None, "2024-01-01 00:00:00", 1)]), "w", 1)
    assert table.version() == 1 and table.read().count() == 0
    with pytest.raises(ValueError, match="buckets"):
        buckets.BucketTable(spark, str(tmp_path / "t"), buckets=8).read()


def test_equal_keys_in_a_batch(spark, rows, tmp_path):
    table = table_of(spark, tmp_path)
    schema = ROWS + ", seq int"
    table.upsert(rows(schema, [("a", "2024-01-01 00:00:00", 1, 2), ("a", "2024-01-01 00:00:00", 9, 1)]), "w", 0, "seq")
    assert result(table.read()) == [("a", "2024-01-01 00:00:00", 1)]
