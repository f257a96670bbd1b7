"""Joining the quarter-hour series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import KEYS, MARKET, TS


def with_market(series: DataFrame, sites: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add the market of each site from a table of sites; a site without one is an error."""
    missing = F.raise_error(F.lit("a site has no market"))
    found = series.join(sites.select(*keys, *MARKET).distinct(), list(keys), "left")
    return found.withColumns({m: F.coalesce(F.col(m), missing) for m in MARKET})


def with_prices(
    series: DataFrame, prices: DataFrame, price_keys: Sequence[str] = (), ts: str = TS
) -> DataFrame:
    """Add the price of each slot; slots without a price are left out.

    Prices belong to a market, not to a site, and hold one row per market and
    slot. ``price_keys`` names the columns of ``series`` that identify the market
    (see :func:`with_market`). Without them there must be one market: a second one in
    the price table is an error, also one whose slots are others than the first one's, since
    sites would meet the prices of both. That is looked up when the join is made. The
    size of the price side is not known here; adaptive execution broadcasts it when
    its measured size allows and shuffles it otherwise.
    """
    market = prices.select(*price_keys, ts, "price")
    if not price_keys and MARKET[0] in prices.columns:
        id_ = MARKET[0]
        if len(prices.select(id_).distinct().limit(2).collect()) > 1:
            raise ValueError("prices of several markets need price_keys or sites")
        several = F.raise_error(F.lit("prices of several markets need price_keys or sites"))
        price = F.when(F.min(id_).eqNullSafe(F.max(id_)), F.max("price")).otherwise(several)
        market = prices.groupBy(ts).agg(price.alias("price"))
    return series.join(market, [*price_keys, ts], "inner")


def energy_join(
    mains: DataFrame,
    production: DataFrame,
    prices: DataFrame,
    keys: Sequence[str] = KEYS,
    price_keys: Sequence[str] = (),
    ts: str = TS,
) -> DataFrame:
    """Rows for the slots that three resampled series share."""
    return with_prices(mains.join(production, [*keys, ts], "inner"), prices, price_keys, ts)
