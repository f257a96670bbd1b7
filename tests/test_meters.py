import json
import os

import pytest
from conftest import result

from energy_series.operators import ingest
from energy_series.sources import payloads, tables
from energy_series.streaming import meters


def device(n):
    return dict(energy_import_kwh=n, energy_export_kwh=n / 2, voltage_v=230.0, frequency_hz=50.0)


def telegram(site, time, **devices):
    return {"site_id": site, "sample_time": time, **{d: device(n) for d, n in devices.items()}}


BATCHES = [
    [
        telegram("a", "2024-01-01T23:50:00", ev=1.0, pv=2.0),
        telegram("a", "2024-01-02T00:00:03", p1=3.0),
        telegram("ahead", "2024-03-01T00:00:00", ev=1.0, pv=1.0, p1=1.0),
    ],
    [telegram("a", "2024-01-02T08:00:00", p1=9.0), telegram("a", "2024-01-04T08:00:00", pv=8.0)],
    # Late by days: the readings that silent devices keep change until the next ones.
    [telegram("a", "2024-01-02T00:02:00", ev=5.0), telegram("b", "2024-01-01T00:00:00", ev=1.0)],
    [telegram("ahead", "2024-01-01T12:00:00", p1=0.5), telegram("a", "2024-01-01T00:00:00", p1=0.25)],
    [telegram("a", "2024-01-02T08:00:00", p1=9.5), telegram(None, "2024-01-02T08:00:00", p1=1.0)],
]


def land(folder, n, batch):
    file = folder / f"{n}.json"
    file.write_text("\n".join(json.dumps(doc) for doc in batch))
    os.utime(file, (1_600_000_000 + n, 1_600_000_000 + n))


def stream(spark, source):
    like = payloads.stream_json(spark, "meter", str(source))
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).json(str(source))


def run(spark, tmp_path):
    meters.meter_pipeline(
        stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "work")
    ).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def expected(spark, tmp_path, batches):
    """The batch result over the telegrams that no later one replaces."""
    last = {(d["site_id"], d["sample_time"]): d for batch in batches for d in batch if d["site_id"]}
    (tmp_path / "all").mkdir()
    land(tmp_path / "all", 0, list(last.values()))
    every = payloads.read_json(spark, "meter", str(tmp_path / "all"))
    return ingest.compact_meter(ingest.translate_meter(every))


def test_telegrams_of_any_age_reach_the_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, batch in enumerate(BATCHES):
        land(tmp_path / "in", n, batch)
    got, want = run(spark, tmp_path), expected(spark, tmp_path, BATCHES)
    assert result(got.select(*want.columns)) == result(want)
    rejected = spark.read.parquet(str(tmp_path / "work" / "rejects"))
    assert [r.site_id for r in rejected.collect()] == [None]


def test_a_batch_that_was_cut_off_is_repeated(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for n, batch in enumerate(BATCHES[:2]):
        land(tmp_path / "in", n, batch)
    run(spark, tmp_path)
    land(tmp_path / "in", 2, BATCHES[2])
    real = tables.write_table

    def cut_off(df, path, *more):
        if path.endswith("known"):
            raise OSError("lost")
        real(df, path, *more)

    monkeypatch.setattr(tables, "write_table", cut_off)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path)
    monkeypatch.undo()
    got, want = run(spark, tmp_path), expected(spark, tmp_path, BATCHES[:3])
    assert result(got.select(*want.columns)) == result(want)
    assert not any((tmp_path / "work" / "staging").rglob("*.parquet"))


def test_unchanged_days_are_not_written_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", 0, BATCHES[0])
    run(spark, tmp_path)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    land(tmp_path / "in", 1, [telegram("a", "2024-01-02T08:00:00", p1=9.0)])
    run(spark, tmp_path)
    kept = [p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]]
    # A sample just after midnight counts for the five minutes, and the day, before.
    assert {p.parent.name for p in kept} == {"sample_date=2024-01-01", "sample_date=2024-02-29"}
