import datetime as dt

import pandas as pd
import pytest
from conftest import at, result

from energy_series.columns import COUNTERS, TS
from energy_series.plans import historic, quarter, trend
from energy_series.sources import tables as store

SITES = ("a", "b")


def meter_rows(site, quarters, start):
    out, totals = [], dict.fromkeys(COUNTERS, 0)
    for i in range(quarters * 3):
        steps = dict(exp=-(i % 7), imp=i % 5, gen=-(i % 2), gep=i % 11, evn=-(i % 3), evp=i % 4)
        totals = {c: totals[c] + steps[c] for c in COUNTERS}
        out.append((site, start + dt.timedelta(minutes=5 * i), *totals.values()))
    return out


@pytest.fixture
def tables(rows):
    start, quarters = at("2024-01-30 20:00:00"), 160
    slot = [start + dt.timedelta(minutes=15 * i) for i in range(quarters)]
    meters = [r for s in SITES for r in meter_rows(s, quarters, start)]
    solar = [(s, t, i % 13) for s in SITES for i, t in enumerate(slot) if 5 <= i < 150]
    price = [("m", t, 0.2 + i % 9 / 100) for i, t in enumerate(slot) if i % 10]
    soc = [(s, t, 5000 + i) for s in SITES for i, t in enumerate(slot) if i % 3]
    key = "site_id string, sample_time timestamp_ntz, "
    return trend.Tables(
        rows(key + ", ".join(f"{c} bigint" for c in COUNTERS), meters),
        rows(key + "solar bigint", solar),
        rows("market_id string, sample_time timestamp_ntz, price double", price),
        rows(key + "soc bigint", soc),
    )


def brute_force(tables, rule):
    """The joined frame of one site at a time, with pandas."""
    frames = []
    prices = tables.prices.toPandas().set_index(TS)["price"].sort_index()
    prices = prices.resample("15min").mean().ffill()
    meters, solar = tables.mains.toPandas(), tables.production.toPandas()
    for site in SITES:
        m = meters[meters.site_id == site].set_index(TS).sort_index()[list(COUNTERS)]
        m = m.diff().resample("15min").sum().iloc[1:]
        s = solar[solar.site_id == site].set_index(TS).sort_index()["solar"].resample("15min").sum()
        df = pd.concat([m, s, prices], axis=1, join="inner")
        own = (df.exp + df.gep + df.evp).clip(lower=0)
        out = pd.DataFrame(
            {
                "deliver": df.gep,
                "storage": -(df.solar - df.gep).where(df.gep < df.solar, df.solar),
                "charge": df.gen,
                "sell": df.exp,
                "own_use": own,
                "buy": df.imp,
                "ev_charge": df.evn,
                "ev_deliver": df.evp,
                "sell_euro": (df.exp * df.price).abs(),
                "own_use_euro": own * df.price,
                "dyn_buy_euro": df.gen * df.price,
                "ev_cost": df.evn * df.price,
            }
        )
        out = (out / 1000).resample(rule).sum()
        frames.append(out.assign(site_id=site).reset_index(names=TS))
    return pd.concat(frames).sort_values(["site_id", TS], ignore_index=True)


@pytest.mark.parametrize("rule, other", [("h", "h"), ("d", "D"), ("month", "ME"), ("year", "YE")])
def test_trend_equals_brute_force(tables, rule, other):
    got = trend.trend_table(tables, rule).toPandas()
    got = got.sort_values(["site_id", TS], ignore_index=True)
    want = brute_force(tables, other)
    pd.testing.assert_frame_equal(got[want.columns], want, check_exact=False, rtol=1e-9, atol=1e-9,
                                  check_dtype=False)


def test_frames(tables):
    frames = trend.energy_trend(tables, "d")
    names = {k: sorted(set(v.columns) - {"site_id", TS}) for k, v in frames.items()}
    assert names == {
        "PV": ["charge", "deliver", "storage"],
        "HOME": ["buy", "own_use", "sell"],
        "EV": ["charge", "deliver"],
        "EURO": ["dyn_buy", "own_use", "sell"],
        "EVcost": ["ev_cost"],
        "SOC": ["soc"],
    }
    labelled = frames["PV"].withColumnsRenamed(trend.DUTCH)
    assert {"leveren", "opslag", "laden"} <= set(labelled.columns)
    wide = trend.trend_table(tables, "d")
    assert result(frames["EURO"].select("site_id", TS, "sell")) == result(
        wide.select("site_id", TS, "sell_euro")
    )


def test_totals_add_up(tables):
    quarters = trend.energy_quarters(tables)
    for row in trend.totals(quarters).collect():
        parts = row.avoided_cost + row.export_earnings + row.buy_imbalance
        assert row.total == pytest.approx(parts)


def test_window_and_presets(tables):
    as_of = "2024-02-01 00:00:00"
    cut = tables.window(as_of, 3)
    times = [r[1] for r in result(cut.production.select("site_id", TS))]
    assert min(times) >= "2024-01-31 19:00:00" and max(times) <= "2024-02-01 02:00:00"
    assert set(trend.trend_preset(tables, "days", as_of)) == set(trend.energy_trend(tables, "d"))
    days = trend.trend_preset(tables, "days", as_of, length=1)["HOME"]
    hours = trend.energy_trend(tables, "d", as_of, 24)["HOME"]
    assert result(days) == result(hours)


def test_prices_per_market(tables, rows):
    """Two markets: every site sees the prices of its own."""
    key = ["market_id", "site_id"]
    other = tables.prices.selectExpr("'n' AS market_id", TS, "price * 2 AS price")
    marked = trend.Tables(
        *[
            df.selectExpr("IF(site_id = 'a', 'm', 'n') AS market_id", "*")
            for df in (tables.mains, tables.production)
        ],
        tables.prices.unionByName(other),
        tables.battery,
    )
    got = trend.totals(trend.energy_quarters(marked, key, ["market_id"]), key).toPandas()
    one = trend.totals(trend.energy_quarters(tables)).toPandas()
    got, one = (x.set_index("site_id").total for x in (got, one))
    assert got["a"] == pytest.approx(one["a"]) and got["b"] == pytest.approx(2 * one["b"])


def test_monthly_report(tables, tmp_path, spark):
    report = trend.monthly_report(tables, "2024-02-01 12:00:00", months=1)
    assert {r.month for r in report.collect()} == {"2024-02"}
    store.write_report(report, str(tmp_path / "report"))
    back = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert back.count() == 2 and "own_use_euro" in back.columns


def test_kwh_of_single_series(tables):
    wh = {tuple(r[:2]): r[2] for r in result(quarter.mains_wh(tables.mains, cols=["imp"]))}
    kwh = {tuple(r[:2]): r[2] for r in result(quarter.mains_quarters(tables.mains, cols=["imp"]))}
    assert kwh == {k: v * 0.001 for k, v in wh.items()}


def test_historic_series(rows):
    """A straight line over three days: every label sees the same growth."""
    start = at("2024-01-01 00:00:00")
    df = rows(
        "site_id string, sample_time timestamp_ntz, T1in bigint",
        [("a", start + dt.timedelta(hours=3 * i), 9000 * i) for i in range(40)],
    )
    got = historic.historic_series(df, "T1in", "2024-01-05 00:00:00", 3, "day", "%Y-%m-%d")
    assert result(got.select("label", "y")) == [
        (f"2024-01-0{d}", pytest.approx(71.25)) for d in (2, 3, 4)
    ]
    absent = historic.historic_series(
        df, "T1in", "2024-01-05", 2, "month", "%Y-%m", year=2021, sites=df.select("site_id")
    )
    assert result(absent.select("label", "y")) == [("2021-11", 0.0), ("2021-12", 0.0)]
