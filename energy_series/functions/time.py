"""Wall-clock time expressions.

Every expression here works on ``TIMESTAMP_NTZ`` and is plain interval
arithmetic, so results do not depend on the session time zone and a day with 92
or 100 quarter hours is just a day with fewer or more slots.

Arguments called ``ts``, ``epoch`` or ``x`` are SQL: a column name or an
expression such as ``"sample_time - INTERVAL '5' SECOND"``.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER_SECONDS = 900

# Resample rules: step between two buckets.
STEPS = {
    "1min": "INTERVAL '1' MINUTE",
    "5min": "INTERVAL '5' MINUTE",
    "15min": "INTERVAL '15' MINUTE",
    "h": "INTERVAL '1' HOUR",
    "d": "INTERVAL '1' DAY",
    "month": "INTERVAL '1' MONTH",
    "year": "INTERVAL '1' YEAR",
}
# Other spellings users know these rules by.
ALIASES = {"H": "h", "D": "d", "ME": "month", "M": "month", "A": "year", "YE": "year", "Y": "year"}

# Seconds one period of a timeline counts for.
TIMEFRAME_SECONDS = {
    "hour": 3600,
    "day": 3600 * 24,
    "month": 3600 * 24 * 31,
    "year": 3600 * 24 * 366,
}

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MICROSECOND = "INTERVAL '0.000001' SECOND"


def rule_name(rule: str) -> str:
    name = ALIASES.get(rule, rule)
    if name not in STEPS:
        raise ValueError(f"unknown resample rule {rule!r}; use one of {sorted(STEPS)}")
    return name


def step(rule: str) -> str:
    """SQL interval between two consecutive buckets of ``rule``."""
    return STEPS[rule_name(rule)]


def wall(value: dt.datetime | dt.date | str) -> str:
    """SQL literal of a wall-clock time."""
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = f"{value.isoformat()} 00:00:00"
    if not re.fullmatch(r"[0-9T:. -]+", value):
        raise ValueError(f"not a timestamp: {value!r}")
    return f"TIMESTAMP_NTZ'{value}'"


def epoch_seconds(ts: str) -> Column:
    """Wall clock read as if it were UTC, in whole seconds."""
    return F.expr(f"(({ts}) - {_EPOCH}) DIV INTERVAL '1' SECOND")


def from_epoch(epoch: str) -> Column:
    return F.expr(f"{_EPOCH} + ({epoch}) * INTERVAL '1' SECOND")


def wall_to_instant(ts: str) -> Column:
    """``TIMESTAMP_NTZ`` to ``TIMESTAMP``, wall clock kept as UTC (watermarks need it)."""
    return F.expr(f"timestamp_micros((({ts}) - {_EPOCH}) DIV {MICROSECOND})")


def instant_to_wall(ts: str) -> Column:
    return F.expr(f"{_EPOCH} + unix_micros({ts}) * {MICROSECOND}")


def bucket_start(ts: str, rule: str) -> Column:
    """First instant of the left-closed bucket that holds ``ts``."""
    rule = rule_name(rule)
    if rule == "d":
        return F.expr(f"CAST(CAST({ts} AS DATE) AS TIMESTAMP_NTZ)")
    if rule in ("month", "year"):
        return F.expr(f"CAST(trunc(CAST({ts} AS DATE), '{rule}') AS TIMESTAMP_NTZ)")
    width = STEPS[rule]
    # DIV cuts towards zero; before the epoch a time inside a bucket is one bucket earlier.
    since = f"(({ts}) - {_EPOCH})"
    back = f"CAST({since} < ({since} DIV {width}) * {width} AS INT)"
    return F.expr(f"{_EPOCH} + (({since} DIV {width}) - {back}) * {width}")


def bucket_label(start: str, rule: str) -> Column:
    """Label of a bucket: its start, but the last day for months and years."""
    rule = rule_name(rule)
    if rule == "month":
        return F.expr(f"CAST(last_day(CAST({start} AS DATE)) AS TIMESTAMP_NTZ)")
    if rule == "year":
        return F.expr(f"CAST(make_date(year({start}), 12, 31) AS TIMESTAMP_NTZ)")
    return F.expr(start)


# Position and length of each part in 'yyyy-MM-dd HH:mm:ss'.
_PARTS = {"Y": (1, 4), "m": (6, 2), "d": (9, 2), "H": (12, 2), "M": (15, 2), "S": (18, 2)}


def strftime(ts: str, fmt: str) -> Column:
    """Format a wall-clock timestamp with ``%Y %m %d %H %M %S`` and literal text."""
    pieces = []
    for directive, literal in re.findall(r"%(.)|([^%]+)", fmt):
        if directive in _PARTS:
            start, length = _PARTS[directive]
            pieces.append(F.expr(f"substring(CAST({ts} AS STRING), {start}, {length})"))
        elif literal or directive == "%":
            pieces.append(F.lit(literal or "%"))
        else:
            raise ValueError(f"unsupported format directive %{directive}")
    return F.concat(*pieces)


def parse_wall(text: str) -> Column:
    """Timestamp text cut after the seconds; NULL when it does not parse.

    Fractions and zone offsets are dropped, so the wall clock stays as written.
    """
    cut = f"left({text}, 19)"
    return F.expr(f"CASE WHEN length({cut}) = 19 THEN try_cast({cut} AS TIMESTAMP_NTZ) END")


def quarter_ceil(epoch: str) -> Column:
    """Next quarter hour in epoch seconds; a value on the boundary stays."""
    return F.expr(f"({epoch}) + pmod(-({epoch}), {QUARTER_SECONDS})")


def quarter_end(epoch: str, early: int | float) -> Column:
    """End of the running quarter hour, ``early`` seconds before it."""
    return quarter_ceil(epoch) - F.lit(early)


def floor_to_step(epoch: str, seconds: int = QUARTER_SECONDS) -> Column:
    return F.expr(f"floor(({epoch}) / {int(seconds)}) * {int(seconds)}")


def periods_before(as_of, periods: int, timeframe: str, rollover: bool = False) -> str:
    """``as_of`` moved back by calendar periods.

    Where the month that is reached is too short for the day, it clamps to its last day; with
    ``rollover`` the days that are left over run into the month after it.
    """
    if timeframe not in TIMEFRAME_SECONDS:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    start = wall(as_of)
    if rollover and timeframe in ("month", "year"):
        months = int(periods) * (12 if timeframe == "year" else 1)
        day = f"CAST({start} AS DATE)"
        moved = f"date_add(add_months(trunc({day}, 'month'), -{months}), day({day}) - 1)"
        return f"(CAST({moved} AS TIMESTAMP_NTZ) + ({start} - CAST({day} AS TIMESTAMP_NTZ)))"
    return f"{start} - INTERVAL '{int(periods)}' {timeframe.upper()}"
