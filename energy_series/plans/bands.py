"""Price bands of today and tomorrow."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..columns import MARKET, TS
from ..operators.prices import price_bands
from ..sources.tables import MARGIN_HOURS, window_scan
from .quarter import price_quarters

TWO_DAY_HOURS = 47  # fixed value: today 00:00 to tomorrow 23:00


def two_day_end(as_of: dt.datetime) -> dt.datetime:
    """Tomorrow 23:00."""
    return as_of.replace(hour=23, minute=0, second=0, microsecond=0) + dt.timedelta(days=1)


def price_window(
    prices: DataFrame,
    as_of: dt.datetime,
    hours: int = TWO_DAY_HOURS,
    end: dt.datetime | None = None,
    keys: Sequence[str] = MARKET,
    ts: str = TS,
    **bands,
) -> DataFrame:
    """Classified prices of the window that ends at ``end`` (default: tomorrow 23:00).

    The margin of the scan is taken back at the start of the window, not at its end.
    """
    scanned = window_scan(prices, end or two_day_end(as_of), hours - MARGIN_HOURS, ts)
    filled = price_quarters(scanned, "", keys, ts)
    return price_bands(filled, as_of, keys=keys, ts=ts, **bands)
