import datetime as dt
import json
import os

from conftest import at, result

from energy_series.columns import MARKET, TS
from energy_series.operators import ingest
from energy_series.sources import payloads
from energy_series.streaming import compaction

SAMPLES = (
    "site_id string, sample_time timestamp_ntz, exp bigint, imp bigint, gen bigint, gep bigint, "
    "evn bigint, evp bigint, v1 int, frq int"
)


def samples(count, site="s", start="2024-01-01 00:00:03", every=47):
    base = at(start)
    return [
        (site, base + dt.timedelta(seconds=every * i), -i, 2 * i, -3 * i, 4 * i, -i, i, 2300 + i % 7, 500)
        for i in range(count)
    ]


def land_in_order(df_parts, folder):
    """One parquet file per part, older parts with older file times."""
    for n, part in enumerate(df_parts):
        part.coalesce(1).write.mode("append").parquet(str(folder))
        for f in folder.glob("*.parquet"):
            stamp = 1_600_000_000 + n * 100
            if os.path.getmtime(f) > 1_700_000_000:
                os.utime(f, (stamp, stamp))


def run_compaction(spark, source, out, work):
    stream = (
        spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(str(source))
    )
    compacted = compaction.compact_meter_stream(stream)
    compaction.upsert_stream(compacted, str(out), str(work)).awaitTermination()
    return spark.read.parquet(str(out)).drop("sample_date")


def test_stream_equals_batch_over_split_files(spark, rows, tmp_path):
    data = samples(150) + samples(150, "t")
    data.sort(key=lambda r: r[1])
    parts = [rows(SAMPLES, data[i : i + 100]) for i in range(0, 300, 100)]
    land_in_order(parts, tmp_path / "in")
    got = run_compaction(spark, tmp_path / "in", tmp_path / "out", tmp_path / "work")
    want = ingest.compact_meter(rows(SAMPLES, data))
    assert result(got.select(*want.columns)) == result(want)


def test_late_rows(spark, rows, tmp_path):
    on_time = samples(60, every=60)
    late_kept = [("s", at("2024-01-01 00:55:30"), 0, 9999, 0, 0, 0, 0, 2300, 500)]
    too_late = [("s", at("2024-01-01 00:10:30"), 0, 8888, 0, 0, 0, 0, 2300, 500)]
    later = samples(2, start="2024-01-01 02:00:00")
    parts = [rows(SAMPLES, p) for p in (on_time, late_kept, later, too_late)]
    land_in_order(parts, tmp_path / "in")
    got = run_compaction(spark, tmp_path / "in", tmp_path / "out", tmp_path / "work")
    by_time = {str(r.sample_time): r.imp for r in got.collect()}
    assert by_time["2024-01-01 00:55:00"] == 9999
    assert by_time["2024-01-01 00:10:00"] < 8888


def test_new_files_continue_from_the_checkpoint(spark, rows, tmp_path):
    data = samples(60)
    land_in_order([rows(SAMPLES, data[:30])], tmp_path / "in")
    run_compaction(spark, tmp_path / "in", tmp_path / "out", tmp_path / "work")
    land_in_order([rows(SAMPLES, data[30:])], tmp_path / "in")
    got = run_compaction(spark, tmp_path / "in", tmp_path / "out", tmp_path / "work")
    want = ingest.compact_meter(rows(SAMPLES, data))
    assert result(got.select(*want.columns)) == result(want)


def test_battery_stream(spark, rows, tmp_path):
    schema = "site_id string, sample_time timestamp_ntz, soc int, soh int"
    data = [("s", at("2024-01-01 00:01:00") + dt.timedelta(seconds=50 * i), i, 1000) for i in range(20)]
    rows(schema, data).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = compaction.upsert_stream(
        compaction.compact_battery_stream(stream), str(tmp_path / "out"), str(tmp_path / "work")
    )
    query.awaitTermination()
    want = ingest.compact_battery(rows(schema, data))
    got = spark.read.parquet(str(tmp_path / "out")).select(*want.columns)
    assert result(got) == result(want)


def test_last_known_readings_cross_batches(spark, tmp_path):
    device = dict(energy_import_kwh=2.0, energy_export_kwh=1.0, voltage_v=230.0, frequency_hz=50.0)
    source = tmp_path / "in"
    source.mkdir()
    devices = [
        {"ev": device, "pv": device},
        {"p1": {"energy_import_kwh": 5.0, "energy_export_kwh": 6.0}},
        {"ev": {**device, "energy_export_kwh": 7.0}},
    ]
    for n, present in enumerate(devices):
        doc = {"site_id": "s", "sample_time": f"2024-01-01T0{n}:00:00", **present}
        file = source / f"{n}.json"
        file.write_text(json.dumps(doc))
        os.utime(file, (1_600_000_000 + n, 1_600_000_000 + n))
    telegrams = payloads.stream_json(spark, "meter", str(source))
    limited = spark.readStream.schema(telegrams.schema).option("maxFilesPerTrigger", 1)
    carry = compaction.LastKnown(spark, str(tmp_path / "state"))
    compaction.upsert_stream(
        limited.json(str(source)), str(tmp_path / "out"), str(tmp_path / "work"), "append",
        transform=carry,
    ).awaitTermination()
    want = ingest.translate_meter(payloads.read_json(spark, "meter", str(source)))
    got = spark.read.parquet(str(tmp_path / "out")).select(*want.columns)
    assert result(got) == result(want)
    assert [r.gep for r in got.orderBy(TS).collect()] == [1000, 1000, 1000]
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["batch=1", "batch=2"]


def price_document(day, price):
    items = [{"startsAt": f"2024-01-{day:02d}T00:00:00.000+01:00", "total": price}]
    home = {"currentSubscription": {"priceInfo": {"today": items}}}
    return {"market_id": "m", "data": {"viewer": {"homes": [home]}}}


def test_price_documents_are_loaded_once_and_replaced(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def land(name, stamp, *documents):
        (source / name).write_text("\n".join(json.dumps(d) for d in documents))
        os.utime(source / name, (stamp, stamp))

    def load():
        documents = payloads.stream_json(spark, "prices", str(source))
        compaction.land_to_table(
            documents, payloads.price_rows, str(tmp_path / "out"), str(tmp_path / "work"), MARKET
        ).awaitTermination()
        stored = spark.read.parquet(str(tmp_path / "out"))
        return [(r[1], r[2]) for r in result(stored.select("market_id", TS, "price"))]

    land("a.json", 1_600_000_000, price_document(1, 0.1), price_document(2, 0.2))
    land("b.json", 1_600_000_100, price_document(2, 0.3))
    assert load() == [("2024-01-01 00:00:00", 0.1), ("2024-01-02 00:00:00", 0.3)]
    assert len(load()) == 2
    land("c.json", 1_600_000_200, price_document(1, 0.9))
    assert load() == [("2024-01-01 00:00:00", 0.9), ("2024-01-02 00:00:00", 0.3)]


def test_shared_folder_follows_the_session(spark):
    usual = spark.conf.get("spark.checkpoint.dir", None)
    folder = compaction.shared_folder(spark, "x")
    assert not usual or folder.startswith(usual)
    assert folder != compaction.shared_folder(spark, "x")


