"""Second pass: energy, money and state of charge over hours, days, months or years."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import COUNTERS, KEYS, MARKET, TS
from ..functions import energy as e
from ..functions import time as t
from ..operators.counters import consumption, slice_readings
from ..operators.grid import fill_slots, label_buckets, resample
from ..operators.join import with_market, with_prices
from ..operators.shape import tail
from ..sources.tables import window_scan
from . import quarter


@dataclass(frozen=True)
class Tables:
    """The four stored tables and, where prices have several markets, the market of each site."""

    mains: DataFrame
    production: DataFrame
    prices: DataFrame
    battery: DataFrame
    sites: DataFrame | None = None

    def window(self, as_of, hours: int, ts: str = TS) -> Tables:
        return Tables(
            *(
                window_scan(df, as_of, hours, ts)
                for df in (self.mains, self.production, self.prices, self.battery)
            ),
            self.sites,
        )


# The columns of each result frame and their labels on the charts.
FRAMES = {
    "PV": ("deliver", "storage", "charge"),
    "HOME": ("sell", "own_use", "buy"),
    "EV": ("ev_charge", "ev_deliver"),
    "EURO": ("sell_euro", "own_use_euro", "dyn_buy_euro"),
    "EVcost": ("ev_cost",),
}
SHORT = {
    "ev_charge": "charge",
    "ev_deliver": "deliver",
    "sell_euro": "sell",
    "own_use_euro": "own_use",
    "dyn_buy_euro": "dyn_buy",
}
DUTCH = {
    "deliver": "leveren",
    "storage": "opslag",
    "charge": "laden",
    "sell": "verkopen",
    "own_use": "zelf gebruiken",
    "buy": "inkopen",
    "dyn_buy": "dyn.inkopen",
}
# Preset name -> hours per unit, resample rule, default length, tick format.
PRESETS = {
    "hours": (1, "h", 180, "%d-%m %Hh"),
    "days": (24, "d", 80, "%Y-%m-%d"),
    "months": (31 * 24, "month", 72, "%Y-%m"),
    "years": (366 * 24, "year", 2, "%Y"),
}

_MONEY = ("sell_euro", "own_use_euro", "dyn_buy_euro", "ev_cost")


def metered_quarters(
    mains: DataFrame,
    production: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    holes: bool = True,
) -> DataFrame:
    """Whole Wh per quarter hour that both the meters and the solar series cover.

    The same rows as joining :func:`~.quarter.mains_wh` with
    :func:`~.quarter.production_wh`, but the quarter hours that hold samples are
    joined before the empty ones are added: both sides are aggregated by site and
    slot, so they meet without another shuffle, and one window per site then gives
    the counter deltas, the bounds of both series and the empty slots.
    """
    readings = e.numeric(mains.select(*keys, ts, *COUNTERS), keep=(*keys, ts))
    metered = slice_readings(readings, COUNTERS, "15min", keys, ts, holes)
    solar = e.numeric(production.select(*keys, ts, "solar"), keep=(*keys, ts))
    lit_up = resample(solar, "15min", sums=["solar"], keys=keys, ts=ts, dense=False)
    slices = metered.withColumn("_metered", F.lit(True)).join(lit_up, [*keys, ts], "full")

    ordered = Window.partitionBy(*keys).orderBy(ts)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    with_meter = F.when(F.col("_metered"), F.col(ts))
    with_sun = F.when(F.col("solar").isNotNull(), F.col(ts))
    # Slots without a meter row are passed over, a missing reading is not.
    ends = F.when(F.col("_metered"), F.struct(*[F.col(f"_last_{c}").alias(c) for c in COUNTERS]))
    looked = slices.select(
        "*",
        F.last(ends, ignorenulls=True).over(before).alias("_before"),
        F.min(with_meter).over(whole).alias("_opens"),
        F.max(with_meter).over(whole).alias("_closes"),
        F.min(with_sun).over(whole).alias("_sunrise"),
        F.max(with_sun).over(whole).alias("_sunset"),
        F.lead(ts).over(ordered).alias("_next"),
    )
    bounds = ["_opens", "_closes", "_sunrise", "_sunset"]
    used = looked.select(
        *keys,
        ts,
        *[consumption(c, F.col(f"_before.{c}")) for c in COUNTERS],
        F.coalesce("solar", F.lit(0)).alias("solar"),
        *bounds,
        "_next",
    )
    dense = fill_slots(used, "15min", [*COUNTERS, "solar"], repeat=bounds, keys=keys, ts=ts)
    return dense.where(
        f"{ts} BETWEEN _sunrise AND _sunset AND {ts} <= _closes"
        f" AND ({ts} > _opens OR ({ts} = _opens AND _opens = _closes))"
    ).drop(*bounds)


def energy_quarters(
    tables: Tables,
    keys: Sequence[str] = KEYS,
    price_keys: Sequence[str] = (),
    ts: str = TS,
    holes: bool = True,
) -> DataFrame:
    """Joined quarter-hour table: whole Wh, own use, and exact money per slot."""
    metered = metered_quarters(tables.mains, tables.production, keys, ts, holes)
    prices = quarter.price_quarters(tables.prices, keys=price_keys or MARKET, ts=ts)
    units = prices.withColumn("price", e.price_units(F.col("price")))
    if tables.sites is not None and not price_keys:
        metered, price_keys = with_market(metered, tables.sites, keys), MARKET
    joined = with_prices(metered, units, price_keys, ts)
    col, price = F.col, F.col("price")
    own = e.own_use(col("exp"), col("gep"), col("evp"))
    return joined.select(
        *keys,
        ts,
        col("gep").alias("deliver"),
        e.stored_solar(col("gep"), col("solar")).alias("storage"),
        col("gen").alias("charge"),
        col("exp").alias("sell"),
        own.alias("own_use"),
        col("imp").alias("buy"),
        col("evn").alias("ev_charge"),
        col("evp").alias("ev_deliver"),
        F.abs(e.money(col("exp"), price)).alias("sell_euro"),
        F.abs(e.money(own, price)).alias("own_use_euro"),
        e.money(col("gen"), price).alias("dyn_buy_euro"),
        e.money(col("evn"), price).alias("ev_cost"),
    )


def total(column: str) -> Column:
    """Sum of a column; money in a type that a region's years of slots do not overflow."""
    return F.sum(F.col(column).cast("decimal(28,0)") if column in _MONEY else column)


def aggregate_quarters(
    quarters: DataFrame,
    rule: str,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """Sum chosen columns to ``rule``: energy in kWh, money in euro.

    The joined grids have no holes, so neither has their intersection and the sums
    need no grid of their own.
    """
    summed = quarters.groupBy(*keys, t.bucket_start(ts, rule).alias(ts)).agg(
        *[total(c).alias(c) for c in columns]
    )
    shown = summed.select(
        *keys, ts, *[(e.euro(c) if c in _MONEY else e.kwh(c)).alias(c) for c in columns]
    )
    return label_buckets(shown, rule, ts)


def frame_of(table: DataFrame, name: str, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """One result frame cut out of a :func:`trend_table`."""
    chosen = table.select(*keys, ts, *FRAMES[name])
    return chosen.withColumnsRenamed({c: SHORT[c] for c in FRAMES[name] if c in SHORT})


def frame(
    quarters: DataFrame, name: str, rule: str, keys: Sequence[str] = KEYS, ts: str = TS
) -> DataFrame:
    """One result frame (``PV``, ``HOME``, ``EV``, ``EURO`` or ``EVcost``)."""
    return frame_of(aggregate_quarters(quarters, rule, FRAMES[name], keys, ts), name, keys, ts)


def energy_trend(
    tables: Tables,
    rule: str = "h",
    as_of=None,
    hours: int = 48,
    keys: Sequence[str] = KEYS,
    price_keys: Sequence[str] = (),
    ts: str = TS,
    holes: bool = True,
) -> dict[str, DataFrame]:
    """All result frames of a window; the whole tables when ``as_of`` is None.

    The frames are lazy and each computes what it needs. A caller who writes several
    of them takes all columns at once with :func:`trend_table`, writes that table and
    cuts the frames out of it with :func:`frame_of`.
    """
    source = tables if as_of is None else tables.window(as_of, hours, ts)
    quarters = energy_quarters(source, keys, price_keys, ts, holes)
    frames = {name: frame(quarters, name, rule, keys, ts) for name in FRAMES}
    frames["SOC"] = quarter.battery_mean_of_means(source.battery, rule, keys, ts)
    return frames


def trend_table(
    tables: Tables,
    rule: str,
    as_of=None,
    hours: int = 48,
    keys: Sequence[str] = KEYS,
    price_keys: Sequence[str] = (),
    ts: str = TS,
    holes: bool = True,
) -> DataFrame:
    """Every energy and money column of :func:`energy_trend` from one pass."""
    source = tables if as_of is None else tables.window(as_of, hours, ts)
    columns = [c for cols in FRAMES.values() for c in cols]
    quarters = energy_quarters(source, keys, price_keys, ts, holes)
    return aggregate_quarters(quarters, rule, columns, keys, ts)


def trend_preset(
    tables: Tables, preset: str, as_of, length: int = 0, **options
) -> dict[str, DataFrame]:
    """Trend of the last ``length`` hours, days, months or years (0 = usual length)."""
    unit, rule, usual, _ = PRESETS[preset]
    return energy_trend(tables, rule, as_of, (length or usual) * unit, **options)


def totals(quarters: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Money over the whole window: avoided cost, export earnings, buy imbalance, sum."""
    sums = quarters.groupBy(*keys).agg(
        total("own_use_euro").alias("own"),
        total("sell_euro").alias("exp"),
        total("dyn_buy_euro").alias("buy"),
    )
    return sums.select(
        *keys,
        e.euro("own").alias("avoided_cost"),
        e.euro("exp").alias("export_earnings"),
        e.euro("buy").alias("buy_imbalance"),
        e.euro(F.col("own") + F.col("exp") + F.col("buy")).alias("total"),
    )


def monthly_report(
    tables: Tables, as_of, months: int = 6, keys: Sequence[str] = KEYS, ts: str = TS, **options
) -> DataFrame:
    """Monthly energy, money and mean state of charge of the last months."""
    unit, rule, _, fmt = PRESETS["months"]
    hours = months * unit
    table = trend_table(tables, rule, as_of, hours, keys, ts=ts, **options)
    soc = quarter.battery_mean_of_means(tables.window(as_of, hours, ts).battery, rule, keys, ts)
    joined = table.join(soc, [*keys, ts], "left")
    return tail(joined, months, keys, ts).withColumn("month", t.strftime(ts, fmt))
