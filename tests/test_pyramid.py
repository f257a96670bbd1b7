"""Sums kept up level by level: equal to plain sums, and only what a change touches is written."""

import pytest
from conftest import result
from pyspark.sql import functions as F

from energy_series.columns import TS
from energy_series.functions import time as t
from energy_series.plans import pyramid, quarter, trend
from energy_series.sources import buckets

ROWS = "site_id string, sample_time timestamp_ntz, x bigint, y decimal(28,0)"


def some(change=()):
    data = {}
    for site in "ab":
        for month in ("2022-12", "2023-01", "2023-02"):
            for day in (1, 2):
                for slot in ("00:00", "00:15", "13:45"):
                    data[site, f"{month}-{day:02d} {slot}:00"] = (len(data), len(data) * 10)
    data.update(change)
    return [(*k, x, None if y is None else y) for k, (x, y) in data.items()]


def make(rows, data):
    return rows("site_id string, sample_time timestamp_ntz, x bigint, y bigint", data).withColumn("y", F.col("y").cast("decimal(28,0)"))


def plain(df, rule):
    return result(df.groupBy("site_id", t.bucket_start(TS, rule).alias(TS)).agg(F.sum("x"), F.sum("y")))


def test_levels_equal_plain_sums_and_a_change_touches_its_own(spark, rows, tmp_path, monkeypatch):
    built = pyramid.Pyramid(spark, str(tmp_path), ("x", "y"), buckets=2)
    assert built.update(make(rows, some()), 0) == len(some())
    assert all(built.level(r).version() == 1 for r in pyramid.LEVELS)
    assert built.update(make(rows, some()), 1) == 0  # nothing differs
    late = {("b", "2023-01-02 00:15:00"): (1000, None), ("b", "2023-01-02 07:00:00"): (1, 1)}
    changed = make(rows, some(late))

    real = buckets.BucketTable._commit

    def cut_off(self, *more):
        if self.path.endswith("/month"):
            raise OSError("lost")
        real(self, *more)

    monkeypatch.setattr(buckets.BucketTable, "_commit", cut_off)
    with pytest.raises(OSError, match="lost"):
        built.update(changed, 2)
    monkeypatch.undo()
    assert built.update(changed, 2) == 2
    written = {}
    for rule in pyramid.LEVELS:
        level = built.level(rule)
        assert result(built.read(rule)) == plain(changed, rule), rule
        written[rule] = [r.n_rows for r in level.log().where(f"part IS NOT NULL AND v = {level.version()}").collect()]
    assert written == {"15min": [2], "h": [2], "d": [1], "month": [1], "year": [1]}


def test_frames_of_one_level_equal_those_from_samples(spark, rows, tmp_path):
    n = range(200)
    mains = rows(
        "site_id string, sample_time timestamp_ntz, exp bigint, imp bigint, gen bigint, gep bigint, evn bigint, evp bigint",
        [("s", f"2024-01-{1 + i // 70:02d} {i // 4 % 17:02d}:{i % 4 * 15:02d}:07", -i, 3 * i, -2 * i, 5 * i, -i, 2 * i) for i in n],
    ).dropDuplicates([TS])
    solar = rows("site_id string, sample_time timestamp_ntz, solar bigint", [("s", f"2024-01-0{d} {h:02d}:00:00", d * h) for d in (1, 2, 3) for h in range(24)])
    prices = rows("market_id string, sample_time timestamp_ntz, price double", [("m", f"2024-01-0{d} {h:02d}:00:00", h / 64) for d in (1, 2, 3) for h in range(24)])
    cells = rows("site_id string, sample_time timestamp_ntz, soc int, soh int", [("s", f"2024-01-0{d} {h:02d}:00:00", d * h, 1000) for d in (1, 3) for h in (1, 5)])
    tables = trend.Tables(mains, solar, prices, cells)
    energy = pyramid.energy_pyramid(spark, str(tmp_path / "e"), buckets=2)
    charge = pyramid.charge_pyramid(spark, str(tmp_path / "c"), buckets=2)
    assert energy.update(pyramid.energy_rows(tables), 0) > 0 and charge.update(pyramid.charge_rows(cells), 0) == 4
    for rule in ("h", "d", "year"):
        got, want = pyramid.frames(energy, charge, rule), trend.energy_trend(tables, rule)
        assert got.keys() == want.keys()
        for name, df in want.items():
            assert result(got[name].select(*df.columns)) == result(df), (rule, name)
    assert result(charge.read("month").select("soc_n")) == [(4,)]
    assert quarter.battery_mean_of_means(cells, "month").count() == 1
