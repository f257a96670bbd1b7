import datetime as dt

from conftest import at

from energy_series.__main__ import main
from energy_series.columns import COUNTERS
from energy_series.sources import tables


def test_shell_entry_writes_every_frame(spark, rows, tmp_path):
    start = at("2024-01-01 00:00:00")
    times = [start + dt.timedelta(minutes=15 * i) for i in range(300)]
    key = "site_id string, sample_time timestamp_ntz, sample_epoch bigint, "
    root = tmp_path / "in"
    mains = rows(
        key + ", ".join(f"{c} bigint" for c in COUNTERS) + ", v1 int, frq int",
        [("s", t, 0, *(i * k for k in range(1, 7)), 2300, 500) for i, t in enumerate(times)],
    )
    production = rows(key + "solar bigint", [("s", t, 0, i % 50) for i, t in enumerate(times)])
    prices = rows(
        "market_id string, sample_time timestamp_ntz, sample_epoch bigint, price double",
        [("m", t, 0, 0.1 + i % 96 / 1000) for i, t in enumerate(times)],
    )
    battery = rows(
        key + "soc double, soh double",
        [("s", t, 0, float(i % 100), 1000.0) for i, t in enumerate(times)],
    )
    for name, df in dict(mains=mains, production=production, prices=prices, battery=battery).items():
        tables.write_table(df, str(root / name))
    out = tmp_path / "out"
    main(["--tables", str(root), "--out", str(out), "--edate", "2024-01-02 12:00:00", "--hours", "12",
          "--days", "0", "--twoday", "--report", "6"])
    hours = spark.read.parquet(str(out / "hours/HOME"))
    assert [hours.count(), hours.where("tick <> ''").count()] == [17, 17]
    for frame in ("PV", "HOME", "EV", "EURO", "EVcost", "SOC"):
        assert spark.read.parquet(str(out / "days" / frame)).count() == 2
    assert spark.read.parquet(str(out / "twoday")).where("lowest is not null").count() == 23
    assert spark.read.option("header", True).csv(str(out / "report")).count() == 1
