"""DuckDB statements with the results the registered queries must have."""

from __future__ import annotations

import re

COUNTERS = ("exp", "imp", "gen", "gep", "evn", "evp")

_MARKET = "CASE WHEN site_id < '4' THEN 'NL' ELSE 'BE' END"

# Common table expressions; a statement gets those it names, directly or not.
VIEWS: dict[str, str] = {
    "ev": """
        SELECT CAST(user_id % 8 AS VARCHAR) AS site_id, ts AS sample_time, event_type AS kind,
               event_id AS id, value, CAST(round(value * 100) AS BIGINT) AS wh
        FROM events""",
    "v_mains": """
        SELECT site_id, sample_time,
               CAST(sum(CASE WHEN kind = 'purchase' THEN -wh ELSE 0 END) OVER w AS BIGINT) AS exp,
               CAST(sum(CASE WHEN kind = 'click' THEN wh ELSE 0 END) OVER w AS BIGINT) AS imp,
               CAST(sum(CASE WHEN kind = 'error' THEN -wh ELSE 0 END) OVER w AS BIGINT) AS gen,
               CAST(sum(CASE WHEN kind = 'view' THEN wh ELSE 0 END) OVER w AS BIGINT) AS gep,
               CAST(sum(CASE WHEN kind = 'signup' THEN -wh ELSE 0 END) OVER w AS BIGINT) AS evn,
               CAST(sum(CASE WHEN kind = 'signup' AND id % 3 = 0 THEN wh ELSE 0 END) OVER w
                    AS BIGINT) AS evp
        FROM ev
        WINDOW w AS (PARTITION BY site_id ORDER BY sample_time)""",
    "v_production": """
        SELECT site_id, sample_time, wh * (1 + id % 2) AS solar FROM ev WHERE kind = 'view'""",
    "v_prices": f"""
        SELECT {_MARKET} AS market_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS sample_time,
               CAST(max(value) / 1000 AS DECIMAL(9,5)) AS exact,
               CAST(CAST(max(value) / 1000 AS DECIMAL(9,5)) AS DOUBLE) AS price
        FROM ev GROUP BY ALL""",
    "v_battery": """
        SELECT site_id, sample_time, least(wh, 10000) AS soc, 1000 AS soh
        FROM ev WHERE kind = 'error'""",
    "v_samples": """
        SELECT site_id, sample_time, -id * 3 AS exp, id * 5 AS imp, -id * 2 AS gen, id * 4 AS gep,
               -id AS evn, id * 6 AS evp, 
               CAST(2200 + id % 100 AS INTEGER) AS v1, CAST(500 + id % 5 AS INTEGER) AS frq
        FROM ev""",
    "v_tariff": """
        SELECT CAST(o_custkey % 4 AS VARCHAR) AS site_id, strftime(o_orderdate, '%Y-%m') AS label,
               CAST(coalesce(sum(c) FILTER (o_orderkey % 4 = 0), 0) AS BIGINT) AS ilo,
               CAST(coalesce(sum(c) FILTER (o_orderkey % 4 = 1), 0) AS BIGINT) AS ihi,
               CAST(coalesce(sum(c) FILTER (o_orderkey % 4 = 2), 0) AS BIGINT) AS xlo,
               CAST(coalesce(sum(c) FILTER (o_orderkey % 4 = 3), 0) AS BIGINT) AS xhi,
               CAST(coalesce(sum(c) FILTER (o_orderstatus = 'P'), 0) AS BIGINT) AS own
        FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
        GROUP BY 1, 2""",
    "v_counter": """
        SELECT site_id, sample_time,
               CAST(sum(y) OVER (PARTITION BY site_id ORDER BY sample_time) AS BIGINT) AS y
        FROM (SELECT l_returnflag AS site_id, l_shipdate AS sample_time,
                     sum(CAST(l_quantity AS BIGINT)) AS y
              FROM lineitem GROUP BY ALL)""",
    # Steps between readings, per quarter hour, on a dense grid without its first slot.
    "q_steps": "SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS b, "
    + ", ".join(f"{c} - lag({c}) OVER w AS {c}" for c in COUNTERS)
    + " FROM v_mains WINDOW w AS (PARTITION BY site_id ORDER BY sample_time)",
    "q_mains_sum": "SELECT site_id, b, "
    + ", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in COUNTERS)
    + " FROM q_steps GROUP BY ALL",
    "q_mains_grid": """
        SELECT site_id, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS b, lo, hi
        FROM (SELECT site_id, min(b) AS lo, max(b) AS hi FROM q_mains_sum GROUP BY 1)""",
    "q_mains": "SELECT g.site_id, g.b AS sample_time, "
    + ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in COUNTERS)
    + """ FROM q_mains_grid g LEFT JOIN q_mains_sum s ON s.site_id = g.site_id AND s.b = g.b
          WHERE g.b > g.lo OR g.lo = g.hi""",
    "q_production": """
        SELECT g.site_id, g.b AS sample_time, CAST(coalesce(s.solar, 0) AS BIGINT) AS solar
        FROM (SELECT site_id, unnest(generate_series(min(b), max(b), INTERVAL 15 MINUTE)) AS b
              FROM (SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS b
                    FROM v_production) GROUP BY 1) g
        LEFT JOIN (SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS b,
                          sum(solar) AS solar FROM v_production GROUP BY ALL) s
        ON s.site_id = g.site_id AND s.b = g.b""",
    "q_prices": """
        SELECT g.market_id, g.b AS sample_time,
               last_value(p.exact IGNORE NULLS) OVER (PARTITION BY g.market_id ORDER BY g.b) AS exact
        FROM (SELECT market_id, unnest(generate_series(min(sample_time), max(sample_time),
                                            INTERVAL 15 MINUTE)) AS b FROM v_prices GROUP BY 1) g
        LEFT JOIN v_prices p ON p.sample_time = g.b AND p.market_id = g.market_id""",
    "q_energy": f"""
        SELECT m.site_id, m.sample_time, gep AS deliver,
               CASE WHEN gep < solar THEN gep - solar ELSE -solar END AS storage,
               gen AS charge, exp AS sell, greatest(exp + gep + evp, 0) AS own_use, imp AS buy,
               evn AS ev_charge, evp AS ev_deliver,
               abs(exp * units) AS sell_euro, greatest(exp + gep + evp, 0) * units AS own_use_euro,
               gen * units AS dyn_buy_euro, evn * units AS ev_cost
        FROM q_mains m JOIN q_production p USING (site_id, sample_time)
        JOIN (SELECT *, CAST(exact * 100000000 AS BIGINT) AS units FROM q_prices) r
        ON r.sample_time = m.sample_time AND r.market_id = {_MARKET.replace("site_id", "m.site_id")}""",
}

_KWH = "CAST({x} AS DOUBLE) * CAST(0.001 AS DOUBLE) AS {c}"
_EURO = "CAST({x} AS DOUBLE) / CAST(100000000000 AS DOUBLE) AS {c}"
MONEY = ("sell_euro", "own_use_euro", "dyn_buy_euro", "ev_cost")
ENERGY = ("deliver", "storage", "charge", "sell", "own_use", "buy", "ev_charge", "ev_deliver")


def _kwh(*cols: str, x: str = "{c}") -> str:
    return ", ".join(_KWH.format(x=x.format(c=c), c=c) for c in cols)


def _shown(cols, names=None, x: str = "sum({c})") -> str:
    names = names or {}
    return ", ".join(
        (_EURO if c in MONEY else _KWH).format(x=x.format(c=c), c=names.get(c, c)) for c in cols
    )


def _frame(bucket: str, cols, names=None, source: str = "q_energy") -> str:
    return f"SELECT site_id, {bucket} AS sample_time, {_shown(cols, names)} FROM {source} GROUP BY 1, 2"


_DAY = "date_trunc('day', sample_time)"
_HOUR = "date_trunc('hour', sample_time)"
_MONTH_END = "CAST(last_day(sample_time) AS TIMESTAMP)"
_YEAR_END = "CAST(make_date(year(sample_time), 12, 31) AS TIMESTAMP)"
_EPOCH = "CAST(floor(epoch(sample_time)) AS BIGINT)"


def _production_grid(step: str, unit: str) -> str:
    return f"""
        SELECT g.site_id, g.b AS sample_time, CAST(coalesce(s.solar, 0) AS BIGINT) AS solar
        FROM (SELECT site_id, unnest(generate_series(date_trunc('{unit}', min(sample_time)),
                     date_trunc('{unit}', max(sample_time)), INTERVAL {step})) AS b
              FROM v_production GROUP BY 1) g
        LEFT JOIN (SELECT site_id, date_trunc('{unit}', sample_time) AS b, sum(solar) AS solar
                   FROM v_production GROUP BY ALL) s ON s.site_id = g.site_id AND s.b = g.b"""


def _bands(low: int, high: int, limit: str, source: str = "v_prices") -> str:
    return f"""
        SELECT market_id, sample_time,
               CASE WHEN past THEN price END AS past,
               CASE WHEN NOT past AND NOT cheap AND NOT dear AND price <= lim THEN price END AS low,
               CASE WHEN NOT past AND NOT cheap AND NOT dear AND price > lim THEN price END AS high,
               CASE WHEN NOT past AND cheap THEN price END AS lowest,
               CASE WHEN NOT past AND dear THEN price END AS highest
        FROM (SELECT *, {limit} AS lim,
                     sample_time < TIMESTAMP '2024-01-15 12:00:00' AS past,
                     row_number() OVER (PARTITION BY market_id, d ORDER BY exact, sample_time) <= {low} AS cheap,
                     row_number() OVER (PARTITION BY market_id, d ORDER BY exact DESC, sample_time) <= {high}
                         AS dear
              FROM (SELECT *, date_trunc('day', sample_time) AS d FROM {source})
              WINDOW w AS (PARTITION BY market_id, d))"""


# A sum of decimals is exact; the mean of a day is compared through it.
_MEAN = "CAST(CAST(sum(exact) OVER w / count(*) OVER w AS DECIMAL(18,12)) AS DOUBLE)"
_MEDIAN = "median(price) OVER w"


def _delta_direct(step: str, unit: str, label: str = "g.b") -> str:
    """Steps summed straight to a coarse bucket, first bucket dropped."""
    sums = ", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in COUNTERS)
    values = _kwh(*COUNTERS, x="coalesce({c}, 0)")
    return f"""
        SELECT g.site_id, {label} AS sample_time, {values}
        FROM (SELECT site_id, lo, hi, unnest(generate_series(lo, hi, INTERVAL {step})) AS b
              FROM (SELECT site_id, date_trunc('{unit}', min(b)) AS lo,
                           date_trunc('{unit}', max(b)) AS hi FROM q_steps GROUP BY 1)) g
        LEFT JOIN (SELECT site_id, date_trunc('{unit}', b) AS b, {sums}
                   FROM q_steps GROUP BY ALL) s ON s.site_id = g.site_id AND s.b = g.b
        WHERE g.b > g.lo OR g.lo = g.hi"""


def _interpolated(start: int, stop: int, source: str) -> str:
    """Samples before and after each grid point; flat outside."""
    return f"""
        SELECT site_id, epoch,
               CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL OR x0 = x1 THEN y0
                    ELSE ((y1 - y0) / CAST(x1 - x0 AS DOUBLE)) * (epoch - x0) + y0 END AS y
        FROM (
            SELECT g.site_id, g.epoch, a.x AS x0, CAST(a.y AS DOUBLE) AS y0,
                   z.x AS x1, CAST(z.y AS DOUBLE) AS y1
            FROM (SELECT s.site_id, e.epoch
                  FROM (SELECT DISTINCT site_id FROM {source}) s,
                       (SELECT unnest(range({start}, {stop}, 900)) AS epoch) e) g
            ASOF LEFT JOIN {source} a ON a.site_id = g.site_id AND a.x <= g.epoch
            ASOF LEFT JOIN {source} z ON z.site_id = g.site_id AND z.x >= g.epoch)"""


def _balance(import_lo, export_lo, import_hi, export_hi, own) -> str:
    return f"""
        SELECT site_id, label, {import_lo} AS import_lo, {import_hi} AS import_hi,
               {export_lo} AS export_lo, {export_hi} AS export_hi, {own} AS own FROM v_tariff"""


def _ends(sign: str) -> str:
    return f"""
        SELECT site_id, CAST(n - from_end AS INTEGER) AS i, v FROM (
            SELECT site_id, from_end, max(from_end) OVER (PARTITION BY site_id) AS n,
                   CAST(coalesce(u.v, 0) {sign} coalesce(s.v, 0) AS DOUBLE) AS v
            FROM used_end u FULL JOIN sold_end s USING (site_id, from_end))"""


def _matrix() -> str:
    cells = ", ".join(
        f"coalesce(max({v}) FILTER (month = {m}), 0) AS {v}_{m:02d}"
        for v in ("use", "expo")
        for m in range(1, 13)
    )
    return f"""
        SELECT g.site_id, CAST(g.year AS INTEGER) AS year, {cells}
        FROM (SELECT site_id, unnest(range(min(year), max(year) + 1)) AS year FROM v_months GROUP BY 1) g
        LEFT JOIN v_months m ON m.site_id = g.site_id AND m.year = g.year GROUP BY ALL"""


VIEWS["v_account"] = """
    SELECT CAST(o_custkey AS VARCHAR) AS site_id, strftime(o_orderdate, '%Y-%m') AS label,
           o_orderkey % 2 = 1 AS feed, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders"""
VIEWS["used"] = """
    SELECT site_id, label, CAST(sum(cents) AS BIGINT) AS v FROM v_account WHERE NOT feed GROUP BY ALL"""
VIEWS["sold"] = """
    SELECT site_id, label, CAST(sum(cents) AS BIGINT) AS v FROM v_account WHERE feed GROUP BY ALL"""
VIEWS["v_months"] = """
    SELECT site_id, CAST(label[1:4] AS INTEGER) AS year, CAST(label[6:7] AS INTEGER) AS month,
           u.v AS use, s.v AS expo
    FROM used u FULL JOIN sold s USING (site_id, label)"""
VIEWS["used_end"] = """
    SELECT site_id, v, row_number() OVER (PARTITION BY site_id ORDER BY label DESC) AS from_end
    FROM used"""
VIEWS["sold_end"] = """
    SELECT site_id, v, row_number() OVER (PARTITION BY site_id ORDER BY label DESC) AS from_end
    FROM sold"""
VIEWS["q_soc"] = """
    SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS b, avg(soc) AS soc
    FROM v_battery GROUP BY ALL"""
VIEWS["counter_x"] = f"SELECT site_id, {_EPOCH} AS x, y FROM v_counter"
VIEWS["readings"] = """
    SELECT site_id, sample_time, kind, id,
           (id * 7 + 1) / 8.0::DOUBLE AS ev_i, (id * 7 + 4) / 16.0::DOUBLE AS ev_e,
           (id * 7 + 2) / 8.0::DOUBLE AS pv_i, (id * 7 + 5) / 16.0::DOUBLE AS pv_e,
           (id * 7 + 3) / 8.0::DOUBLE AS p1_i, (id * 7 + 6) / 16.0::DOUBLE AS p1_e,
           220 + (id % 40) / 4.0::DOUBLE AS volt, 49 + (id % 8) / 4.0::DOUBLE AS hertz
    FROM ev"""
VIEWS["price_docs"] = """
    SELECT market_id, sample_time, exact, price,
           minute(sample_time) = 0 AND CAST(round(price * 100000) AS BIGINT) % 10 = 3 AS broken
    FROM v_prices
    WHERE hour(sample_time) % 2 = 0 OR day(sample_time) % 3 <> 0"""

_LEVEL = "(CAST((id * 5 + {n}) % 1024 AS DOUBLE) / 1024) * 10000"
_JOULE = ("exp", "imp", "gen", "gep", "h1b", "h1d")
_JOULES = {"exp": 60, "imp": 120, "gen": 30, "gep": 90, "h1b": 15, "h1d": 45}


def _carried(value: str, kind: str, factor: int) -> str:
    """Cut to whole units, then the last value while the device is silent."""
    known = f"CASE WHEN kind <> '{kind}' THEN CAST(trunc({value} * {factor}) AS BIGINT) END"
    return f"CAST(last_value({known} IGNORE NULLS) OVER w AS DOUBLE)"


def _mean_of_devices(value: str) -> str:
    ev = f"last_value(CASE WHEN kind <> 'click' THEN {value} END IGNORE NULLS) OVER w"
    pv = f"last_value(CASE WHEN kind <> 'view' THEN {value} END IGNORE NULLS) OVER w"
    both = f"(coalesce({ev}, {pv}) + coalesce({pv}, {ev})) / 2"
    return f"CAST(trunc(({both}) * 10) AS DOUBLE)"


_HISTORIC = """
    SELECT site_id, label, starts, CAST(y AS DOUBLE) AS y FROM (
        SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY starts DESC) AS rn FROM (
            SELECT site_id, strftime(make_timestamp(epoch * 1000000), '{fmt}') AS label,
                   min(make_timestamp(epoch * 1000000)) AS starts,
                   round(greatest(arg_max(y, epoch) - arg_min(y, epoch), 0)
                         * CAST(0.001 AS DOUBLE), 6) AS y
            FROM ({points}) GROUP BY 1, 2))
    WHERE rn <= {period}"""

_MONTHS_BACK = "TIMESTAMP '2001-06-15 12:00:00'"
VIEWS["historic_x"] = f"""
    SELECT site_id, {_EPOCH} AS x, y FROM v_counter
    WHERE sample_time >= {_MONTHS_BACK} - INTERVAL 13 MONTH
    UNION ALL
    SELECT DISTINCT s.site_id, z.x, 0
    FROM (SELECT l_linestatus AS site_id FROM lineitem
          UNION SELECT l_returnflag FROM lineitem) s, (VALUES (1546300800), (1577836800)) z(x)
    WHERE s.site_id NOT IN (SELECT site_id FROM v_counter
                            WHERE sample_time >= {_MONTHS_BACK} - INTERVAL 13 MONTH)"""
VIEWS["year_x"] = f"""
    SELECT site_id, {_EPOCH} AS x, y FROM v_counter
    WHERE sample_time BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-01-01'"""

# Epoch seconds of 2001-06-15 12:00, 2001-12-10 12:00 and 2000-01-01.
_JUNE, _DECEMBER, _Y2000 = 992606400, 1007985600, 946684800

_STATEMENTS: dict[str, str] = {
    "mains_15min": f"SELECT site_id, sample_time, {_kwh(*COUNTERS)} FROM q_mains",
    "mains_steps": "SELECT site_id, sample_time, "
    + ", ".join(f"CAST({c} - lag({c}) OVER w AS DOUBLE) AS {c}" for c in COUNTERS)
    + " FROM v_mains WINDOW w AS (PARTITION BY site_id ORDER BY sample_time)",
    "mains_hourly": _delta_direct("1 HOUR", "hour"),
    "mains_daily": f"""
        SELECT site_id, {_DAY} AS sample_time, {_kwh("imp", x="sum({c})")}
        FROM q_mains GROUP BY 1, 2""",
    "mains_monthly_complete": _delta_direct(
        "1 MONTH", "month", "CAST(last_day(g.b) AS TIMESTAMP)"
    ),
    "mains_holes": f"""
        WITH h AS (SELECT site_id, sample_time, exp,
                          CASE WHEN CAST(floor(epoch(sample_time)) AS BIGINT) % 11 <> 0
                               THEN imp END AS imp FROM v_mains),
        s AS (SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS b,
                     exp - lag(exp) OVER w AS exp, imp - lag(imp) OVER w AS imp
              FROM h WINDOW w AS (PARTITION BY site_id ORDER BY sample_time)),
        a AS (SELECT site_id, b, sum(exp) AS exp, sum(imp) AS imp FROM s GROUP BY ALL)
        SELECT g.site_id, g.b AS sample_time, {_kwh("imp", "exp", x="coalesce({c}, 0)")}
        FROM q_mains_grid g LEFT JOIN a ON a.site_id = g.site_id AND a.b = g.b
        WHERE g.b > g.lo OR g.lo = g.hi""",
    "production_hourly": f"""
        SELECT site_id, sample_time, {_kwh("solar")} FROM ({_production_grid("1 HOUR", "hour")})""",
    "battery_15min": """
        SELECT g.site_id, g.b AS sample_time, round(s.soc * CAST(0.01 AS DOUBLE), 9) AS soc
        FROM (SELECT site_id, unnest(generate_series(min(b), max(b), INTERVAL 15 MINUTE)) AS b
              FROM q_soc GROUP BY 1) g
        LEFT JOIN q_soc s ON s.site_id = g.site_id AND s.b = g.b""",
    "battery_soc_daily": """
        SELECT g.site_id, g.d AS sample_time, round(s.soc * CAST(0.01 AS DOUBLE), 9) AS soc
        FROM (SELECT site_id, unnest(generate_series(date_trunc('day', min(b)),
                     date_trunc('day', max(b)), INTERVAL 1 DAY)) AS d FROM q_soc GROUP BY 1) g
        LEFT JOIN (SELECT site_id, date_trunc('day', b) AS d, avg(soc) AS soc
                   FROM q_soc GROUP BY ALL) s ON s.site_id = g.site_id AND s.d = g.d""",
    "prices_ffill": """
        SELECT market_id, sample_time, CAST(exact AS DOUBLE) AS price FROM q_prices""",
    "prices_raw_fill": """
        SELECT market_id, sample_time,
               last_value(CASE WHEN hour(sample_time) % 5 <> 0 THEN price END IGNORE NULLS)
                   OVER (PARTITION BY market_id ORDER BY sample_time) AS price
        FROM v_prices""",
    "series_join": f"""
        SELECT m.*, p.solar, CAST(r.exact AS DOUBLE) AS price
        FROM q_mains m JOIN q_production p USING (site_id, sample_time)
        JOIN q_prices r
        ON r.sample_time = m.sample_time AND r.market_id = {_MARKET.replace("site_id", "m.site_id")}""",
    "energy_quarters": f"""
        SELECT site_id, sample_time, {", ".join(ENERGY)}, {_shown(MONEY, x="{c}")} FROM q_energy""",
    "trend_pv_day": _frame(_DAY, ("deliver", "storage", "charge")),
    "trend_home_hour": _frame(_HOUR, ("sell", "own_use", "buy")),
    "trend_ev_day": _frame(
        _DAY, ("ev_charge", "ev_deliver"), {"ev_charge": "charge", "ev_deliver": "deliver"}
    ),
    "trend_euro_month": _frame(
        _MONTH_END,
        ("sell_euro", "own_use_euro", "dyn_buy_euro"),
        {"sell_euro": "sell", "own_use_euro": "own_use", "dyn_buy_euro": "dyn_buy"},
    ),
    "trend_evcost_year": _frame(_YEAR_END, ("ev_cost",)),
    "trend_table_day": _frame(_DAY, (*ENERGY, *MONEY)),
    "trend_totals": """
        SELECT site_id, CAST(sum(own_use_euro) AS DOUBLE) / 1e11::DOUBLE AS avoided_cost,
               CAST(sum(sell_euro) AS DOUBLE) / 1e11::DOUBLE AS export_earnings,
               CAST(sum(dyn_buy_euro) AS DOUBLE) / 1e11::DOUBLE AS buy_imbalance,
               CAST(sum(own_use_euro) + sum(sell_euro) + sum(dyn_buy_euro) AS DOUBLE)
                   / 1e11::DOUBLE AS total
        FROM q_energy GROUP BY 1""",
    "tick_labels": f"""
        SELECT site_id, sample_time, solar,
               CASE WHEN (row_number() OVER (PARTITION BY site_id ORDER BY sample_time) - 1)
                         % greatest(count(*) OVER (PARTITION BY site_id) // 40, 1) = 0
                    THEN strftime(sample_time, '%d-%m %Hh') ELSE '' END AS tick
        FROM ({_production_grid("1 HOUR", "hour")})""",
    "price_day_statistics": """
        SELECT market_id, date_trunc('day', sample_time) AS day,
               round(CAST(sum(exact) / count(*) AS DOUBLE), 9) AS mean_price,
               round(median(price), 9) AS median_price
        FROM v_prices GROUP BY 1, 2""",
    "price_bands_mean": _bands(18, 18, _MEAN),
    "price_bands_median": _bands(18, 18, _MEDIAN),
    "price_bands_minimum": _bands(30, 70, f"least({_MEAN}, {_MEDIAN})"),
    "price_bands_two_days": _bands(18, 18, _MEAN, "two_days"),
    "window_scan": """
        SELECT * FROM ev WHERE sample_time BETWEEN TIMESTAMP '2024-01-18 10:00:00'
                                               AND TIMESTAMP '2024-01-20 14:00:00'""",
    "range_periods": """
        SELECT o_orderkey, o_orderdate AS sample_time FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-02-28 10:00:00'""",
    "range_periods_rollover": """
        SELECT o_orderkey, o_orderdate AS sample_time FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-05-01 10:00:00' - INTERVAL 3 MONTH + INTERVAL 30 DAY""",
    "range_start_of_year": """
        SELECT o_orderkey, o_orderdate AS sample_time FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "range_not_today": """
        SELECT o_orderkey, o_orderdate AS sample_time FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1998-06-15 10:00:00' - INTERVAL 31 DAY
                              AND TIMESTAMP '1998-06-14 10:00:00'""",
    "range_year": """
        SELECT o_orderkey, o_orderdate AS sample_time FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-01-01'""",
    "retention": """
        SELECT o_orderkey, o_orderdate AS sample_time FROM orders
        WHERE o_orderdate >= TIMESTAMP '2018-01-01 06:00:00' - INTERVAL 7320 DAY""",
    "numeric_coerce": r"""
        SELECT event_id, ts AS sample_time, value,
               TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'bad'
                             ELSE regexp_extract(props, '(\d+)', 1) END AS DOUBLE) AS reading
        FROM events""",
    "future_filter": f"""
        SELECT *, {_EPOCH} AS sample_epoch FROM ev
        WHERE {_EPOCH} < epoch(TIMESTAMP '2024-01-20 12:15:00')""",
    "timeline": """
        SELECT site_id, unnest(range((n - 172800) // 900 * 900, n, 900)) AS epoch
        FROM (SELECT site_id, CAST(floor(epoch(max(sample_time))) AS BIGINT) AS n
              FROM ev GROUP BY 1)""",
    "quarter_ceil": f"""
        SELECT id, {_EPOCH} AS epoch, ({_EPOCH} + 899) // 900 * 900 AS next_quarter,
               ({_EPOCH} + 899) // 900 * 900 - 15 AS quarter_end,
               {_EPOCH} // 900 * 900 AS quarter_start FROM ev""",
    "interp_counter": f"""
        SELECT site_id, epoch, round(y, 6) AS y
        FROM ({_interpolated(_DECEMBER - 400 * 86400, _DECEMBER, "counter_x")})""",
    "label_delta": """
        SELECT site_id, strftime(sample_time, '%m-%d %Hh') AS label,
               greatest(arg_max(imp, sample_time) - arg_min(imp, sample_time), 0) AS imp,
               min(sample_time) AS starts
        FROM v_mains GROUP BY 1, 2""",
    "label_sum": """
        SELECT site_id, strftime(sample_time, '%Y-%m-%d') AS label,
               CAST(greatest(sum(solar) - arg_max(solar, sample_time), 0) AS BIGINT) AS solar,
               min(sample_time) AS starts
        FROM v_production GROUP BY 1, 2""",
    "historic_series": _HISTORIC.format(
        fmt="%Y-%m",
        points=_interpolated(_JUNE - 12 * 31 * 86400, _JUNE, "historic_x"),
        period=12,
    ),
    "historic_year": _HISTORIC.format(
        fmt="%Y-%m-%d",
        points=_interpolated(_Y2000 - 53 * 86400, _Y2000, "year_x"),
        period=53,
    ),
    "tail_periods": f"""
        SELECT site_id, sample_time, solar FROM (
            SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY sample_time DESC) AS rn
            FROM ({_production_grid("1 HOUR", "hour")})) WHERE rn <= 50""",
    "contract": """
        SELECT site_id, label, coalesce(u.v, 0) + coalesce(s.v, 0) AS v
        FROM used u FULL JOIN sold s USING (site_id, label)""",
    "distract": """
        SELECT site_id, label, greatest(coalesce(u.v, 0) - coalesce(s.v, 0), 0) AS v
        FROM used u FULL JOIN sold s USING (site_id, label)""",
    "distract_signed": """
        SELECT site_id, label, coalesce(u.v, 0) - coalesce(s.v, 0) AS v
        FROM used u FULL JOIN sold s USING (site_id, label)""",
    "contract_aligned": """
        SELECT site_id, CAST(from_end AS INTEGER) AS from_end,
               coalesce(u.v, 0) + coalesce(s.v, 0) AS v
        FROM used_end u FULL JOIN sold_end s USING (site_id, from_end)""",
    "distract_aligned": """
        SELECT site_id, CAST(from_end AS INTEGER) AS from_end,
               greatest(coalesce(u.v, 0) - coalesce(s.v, 0), 0) AS v
        FROM used_end u FULL JOIN sold_end s USING (site_id, from_end)""",
    "contract_arrays": _ends("+"),
    "distract_arrays": _ends("-"),
    "zip_shortest": """
        SELECT site_id, label, u.v AS use, s.v AS expo
        FROM used u JOIN sold s USING (site_id, label)""",
    "balance_single": _balance(
        "greatest(ilo + ihi - xlo - xhi, 0)",
        "greatest(xlo + xhi - ilo - ihi, 0)",
        "CAST(0 AS BIGINT)",
        "CAST(0 AS BIGINT)",
        "own + least(ilo + ihi, xlo + xhi)",
    ),
    "balance_dual": _balance(
        "greatest(ilo - xlo, 0)",
        "greatest(xlo - ilo, 0)",
        "greatest(ihi - xhi, 0)",
        "greatest(xhi - ihi, 0)",
        "own + least(ihi, xhi)",
    ),
    "balance_dual_accumulated": _balance(
        "greatest(ilo - xlo, 0)",
        "greatest(xlo - ilo, 0)",
        "greatest(ihi - xhi, 0)",
        "greatest(xhi - ihi, 0)",
        "own + least(ihi, xhi) + least(ilo, xlo)",
    ),
    "year_month_matrix": _matrix(),
    "meter_translate": f"""
        SELECT site_id, sample_time, {_EPOCH} AS sample_epoch,
               {_carried("p1_e", "error", -1000)} AS exp, {_carried("p1_i", "error", 1000)} AS imp,
               {_carried("pv_i", "view", -1000)} AS gen, {_carried("pv_e", "view", 1000)} AS gep,
               {_carried("ev_i", "click", -1000)} AS evn, {_carried("ev_e", "click", 1000)} AS evp,
               {_mean_of_devices("volt")} AS v1, {_mean_of_devices("hertz")} AS frq
        FROM readings WINDOW w AS (PARTITION BY site_id ORDER BY sample_time)""",
    "carry_last_known": """
        SELECT site_id, sample_time,
               last_value(CASE WHEN kind = 'click' THEN CAST(wh AS DOUBLE) END IGNORE NULLS)
                   OVER w AS click,
               last_value(CASE WHEN id % 50 = 0 THEN value END IGNORE NULLS) OVER w AS rare
        FROM ev WINDOW w AS (PARTITION BY site_id ORDER BY sample_time)""",
    "battery_translate": f"""
        SELECT site_id, sample_time, {_EPOCH} AS sample_epoch,
               CAST(trunc(({_LEVEL.format(n=1)} + {_LEVEL.format(n=2)}) / 2) AS INTEGER) AS soc,
               1000 AS soh
        FROM ev""",
    "compact_meter": """
        SELECT site_id, b AS sample_time, CAST(epoch(b) AS BIGINT) AS sample_epoch,
               max(exp) AS exp, max(imp) AS imp, max(gen) AS gen, max(gep) AS gep,
               max(evn) AS evn, max(evp) AS evp, CAST(trunc(avg(v1)) AS INTEGER) AS v1,
               CAST(trunc(avg(frq)) AS INTEGER) AS frq
        FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, sample_time - INTERVAL 5 SECOND) AS b
              FROM v_samples) GROUP BY ALL""",
    "compact_battery": """
        SELECT site_id, b AS sample_time, CAST(epoch(b) AS BIGINT) AS sample_epoch,
               round(avg(soc), 9) AS soc, round(avg(soh), 9) AS soh
        FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, sample_time - INTERVAL 5 SECOND) AS b
              FROM v_battery) GROUP BY ALL""",
    "compaction_remainder": f"""
        SELECT v_samples.* FROM v_samples JOIN (
            SELECT site_id,
                   time_bucket(INTERVAL 5 MINUTE, max(sample_time) - INTERVAL 5 SECOND) AS b
            FROM v_samples GROUP BY 1) n USING (site_id)
        WHERE {_EPOCH} > epoch(b)""",
    "price_json_rows": f"""
        SELECT market_id, sample_time, {_EPOCH} AS sample_epoch, price
        FROM price_docs WHERE NOT broken""",
    "price_json_rejects": """
        SELECT market_id, strftime(sample_time, '%Y-%m-%dT%H:%M:%S') || '.000+01:00' AS starts_at,
               'n/a' AS total
        FROM price_docs WHERE broken""",
    "solar_json_rows": f"""
        SELECT site_id, sample_time, {_EPOCH} AS sample_epoch,
               CASE WHEN solar % 5 = 0 THEN 0 ELSE solar END AS solar
        FROM (SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS sample_time,
                     CAST(sum(solar) AS BIGINT) AS solar FROM v_production GROUP BY ALL)""",
    "charger_units": "SELECT site_id, date_trunc('minute', sample_time) AS sample_time, "
    + ", ".join(f"CAST(id * {n} AS DOUBLE) / 3600000 AS {c}_kwh" for c, n in _JOULES.items())
    + ", "
    + ", ".join(f"CAST(id * {n} AS DOUBLE) / 60 AS {c}_w" for c, n in _JOULES.items())
    + """, CAST(2200 + id % 300 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS volt,
          CAST(4950 + id % 100 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS hertz FROM ev""",
    "upsert_last_wins": """
        SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS sample_time,
               arg_max(kind, id) AS kind, arg_max(wh, id) AS wh
        FROM ev GROUP BY 1, 2""",
    "latest_point": "SELECT site_id, max(sample_time) AS latest FROM ev GROUP BY 1",
    "gap_islands": """
        SELECT site_id, gap_start, gap_end,
               (epoch_us(gap_end) - epoch_us(gap_start) - 1) // 900000000 AS missing
        FROM (SELECT site_id, sample_time AS gap_start,
                     lead(sample_time) OVER (PARTITION BY site_id ORDER BY sample_time) AS gap_end
              FROM ev)
        WHERE gap_end - gap_start > INTERVAL 15 MINUTE""",
    "gap_open": """
        SELECT site_id, gap_start, gap_end,
               (epoch_us(gap_end) - epoch_us(gap_start) - 1) // 900000000 AS missing
        FROM (SELECT site_id, sample_time AS gap_start,
                     coalesce(lead(sample_time) OVER (PARTITION BY site_id ORDER BY sample_time),
                              TIMESTAMP '2024-02-05 00:00:00') AS gap_end
              FROM ev)
        WHERE gap_end - gap_start > INTERVAL 15 MINUTE""",
    "backfill_open": """
        SELECT site_id, gap_start, gap_end, CAST(k AS INTEGER) AS attempt, s AS start_at,
               date_trunc('day', s - to_hours(CASE WHEN k = 0 THEN 24 ELSE 2 END)) AS request_from,
               date_trunc('day', s + INTERVAL 1 DAY) AS request_to
        FROM (SELECT *, least(gap_start + to_days(CAST(k AS INTEGER)),
                              TIMESTAMP '2024-02-05 00:00:00') AS s
              FROM (SELECT *, unnest(range(greatest(date_diff('day', gap_start, gap_end), 1))) AS k
                    FROM (SELECT site_id, sample_time AS gap_start,
                                 coalesce(lead(sample_time) OVER (PARTITION BY site_id ORDER BY sample_time),
                                          TIMESTAMP '2024-02-05 00:00:00') AS gap_end
                          FROM ev)
                    WHERE gap_end - gap_start > INTERVAL 1 DAY))""",
    "upsert_merge": """
        SELECT site_id, time_bucket(INTERVAL 15 MINUTE, sample_time) AS sample_time,
               arg_max(kind, CASE WHEN id % 3 = 0 THEN id + 1000000000000 ELSE id END) AS kind,
               arg_max(wh, CASE WHEN id % 3 = 0 THEN id + 1000000000000 ELSE id END) AS wh
        FROM ev GROUP BY 1, 2""",
    "backfill_plan": """
        SELECT user_id, gap_start, gap_end, CAST(k AS INTEGER) AS attempt, s AS start_at,
               date_trunc('day', s - to_hours(CASE WHEN k = 0 THEN 24 ELSE 2 END)) AS request_from,
               date_trunc('day', s + INTERVAL 1 DAY) AS request_to
        FROM (SELECT *, least(gap_start + to_days(CAST(k AS INTEGER)),
                              TIMESTAMP '2024-01-31 00:00:00') AS s
              FROM (SELECT *, unnest(range(greatest(date_diff('day', gap_start, gap_end), 1))) AS k
                    FROM (SELECT user_id, ts AS gap_start,
                                 lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap_end
                          FROM events)
                    WHERE gap_end - gap_start > INTERVAL 1 HOUR))""",
    "signed_labels": """
        SELECT id, amount, CASE WHEN amount < 0 THEN '-' ELSE '+' END
               || CAST(CAST(round_even(abs(amount), 0) AS BIGINT) AS VARCHAR) AS shown
        FROM (SELECT id, CAST(wh AS DOUBLE) * 0.5::DOUBLE
                     * CASE WHEN id % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS amount
              FROM ev)""",
}
_STATEMENTS["stream_compact"] = _STATEMENTS["compact_meter"]
_STATEMENTS["stream_keyed_compact"] = _STATEMENTS["compact_meter"]
_STATEMENTS["stream_keyed_battery"] = _STATEMENTS["compact_battery"]
_STATEMENTS["payload_accounting"] = """
    SELECT 'prices' AS kind, market_id AS source, n_documents, coalesce(n_items, 0) AS n_items, coalesce(n_rows, 0) AS n_rows,
           n_documents - coalesce(n_days, 0) AS n_no_items, 0::BIGINT AS n_no_time,
           coalesce(n_items - n_rows, 0) AS n_no_amount
    FROM (SELECT market_id, count(DISTINCT CAST(sample_time AS DATE)) AS n_documents FROM v_prices GROUP BY 1)
    LEFT JOIN (SELECT market_id, count(DISTINCT CAST(sample_time AS DATE)) AS n_days, count(*) AS n_items,
                      count(*) FILTER (NOT broken) AS n_rows
               FROM price_docs GROUP BY 1) USING (market_id)
    UNION ALL
    SELECT 'solar', site_id, count(DISTINCT CAST(sample_time AS DATE)), count(DISTINCT time_bucket(INTERVAL 15 MINUTE, sample_time)),
           count(DISTINCT time_bucket(INTERVAL 15 MINUTE, sample_time)), 0::BIGINT, 0::BIGINT, 0::BIGINT
    FROM v_production GROUP BY site_id"""
_STATEMENTS["trend_pyramid_day"] = _STATEMENTS["trend_table_day"]
_STATEMENTS["battery_soc_pyramid"] = _STATEMENTS["battery_soc_daily"]
_STATEMENTS["landed_meter_files"] = _STATEMENTS["meter_translate"]
_STATEMENTS["landed_battery_files"] = _STATEMENTS["battery_translate"]
_STATEMENTS["price_dump"] = _STATEMENTS["price_json_rows"]
_STATEMENTS["report_file"] = _STATEMENTS["trend_table_day"]
_STATEMENTS["created_table"] = _STATEMENTS["compact_battery"]
_STATEMENTS["upsert_buckets"] = _STATEMENTS["upsert_merge"]
_STATEMENTS["bucket_window"] = """
    SELECT site_id, sample_time, wh FROM (
        SELECT site_id, time_bucket(INTERVAL 15 MINUTE, ev.sample_time) AS sample_time,
               arg_max(wh, (id % 5 = 0, wh)) AS wh
        FROM ev GROUP BY 1, 2)
    WHERE site_id IN ('2', '5') AND sample_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-19 23:45:00'"""
VIEWS["v_battery_samples"] = _STATEMENTS["battery_translate"]
_STATEMENTS["stream_battery_repair"] = _STATEMENTS["compact_battery"].replace("v_battery", "v_battery_samples")
_STATEMENTS["trend_table_day_holes"] = _STATEMENTS["trend_table_day"]
VIEWS["v_translated"] = _STATEMENTS["meter_translate"]
_STATEMENTS["stream_meter_pipeline"] = _STATEMENTS["compact_meter"].replace("v_samples", "v_translated")
_STATEMENTS["stream_meter_repair"] = _STATEMENTS["stream_meter_pipeline"]
VIEWS["two_days"] = """
    SELECT * FROM v_prices WHERE sample_time BETWEEN TIMESTAMP '2024-01-15 00:00:00'
                                                 AND TIMESTAMP '2024-01-17 01:00:00'"""

# The same tables cut to the window of the last 180 hours and of the last six months.
_CUT = {
    "last_hours": "TIMESTAMP '2024-01-31' - INTERVAL 182 HOUR",
    "last_months": f"TIMESTAMP '2024-01-31' - INTERVAL {6 * 31 * 24 + 2} HOUR",
}


def _with_window(low: str) -> dict[str, str]:
    """The views with every stored table cut to rows from ``low`` on."""
    cut = dict(VIEWS)
    for name in ("v_mains", "v_production", "v_prices", "v_battery"):
        cut[f"all_{name}"] = VIEWS[name]
        cut[name] = f"""SELECT * FROM all_{name} WHERE sample_time >= {low}
                        AND sample_time <= TIMESTAMP '2024-01-31 02:00:00'"""
    return cut


def _assemble(statement: str, views: dict[str, str]) -> str:
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in re.findall(r"\b[a-z_0-9]+\b", sql):
            if name in views and name not in needed:
                visit(views[name])
                needed[name] = None

    visit(statement)
    used = ", ".join(f"{name} AS ({views[name].strip()})" for name in needed)
    body = statement.strip()
    if not used:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {used}, {body[5:]}"
    return f"WITH {used} {body}"


def oracle_sql() -> dict[str, str]:
    statements = {name: _assemble(sql, VIEWS) for name, sql in _STATEMENTS.items()}
    statements["trend_presets"] = _assemble(
        _frame(_HOUR, ("sell", "own_use", "buy")), _with_window(_CUT["last_hours"])
    )
    report = f"""
        SELECT t.*, round(s.soc * CAST(0.01 AS DOUBLE), 9) AS soc,
               strftime(t.sample_time, '%Y-%m') AS month
        FROM ({_frame(_MONTH_END, (*ENERGY, *MONEY))}) t
        LEFT JOIN (SELECT site_id, CAST(last_day(b) AS TIMESTAMP) AS sample_time, avg(soc) AS soc
                   FROM q_soc GROUP BY 1, 2) s
        ON s.site_id = t.site_id AND s.sample_time = t.sample_time"""
    statements["monthly_report"] = _assemble(report, _with_window(_CUT["last_months"]))
    return statements
