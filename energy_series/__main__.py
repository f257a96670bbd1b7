"""Write trend and price tables: ``python -m energy_series --help``."""

from __future__ import annotations

import argparse
import datetime as dt

from .operators.shape import tick_labels
from .plans.bands import price_window
from .plans.quarter import battery_mean_of_means
from .plans.trend import FRAMES, PRESETS, Tables, frame_of, monthly_report, trend_table
from .session import session
from .sources.tables import read_table, write_report


def options(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("energy_series", description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the four stored tables")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--edate", help="end of the window (default: now)")
    for name, (_, _, usual, _) in PRESETS.items():
        parser.add_argument(f"--{name}", type=int, help=f"last N {name}; 0 means {usual}")
    parser.add_argument("--twoday", action="store_true", help="prices of today and tomorrow")
    parser.add_argument("--report", type=int, help="CSV report of the last N months")
    return parser.parse_args(argv)


def main(argv=None) -> None:
    chosen = options(argv)
    spark = session()
    as_of = dt.datetime.fromisoformat(chosen.edate) if chosen.edate else dt.datetime.now()
    names = ("mains", "production", "prices", "battery")
    tables = Tables(*(read_table(spark, name, f"{chosen.tables}/{name}") for name in names))
    for preset, (unit, rule, usual, fmt) in PRESETS.items():
        length = getattr(chosen, preset)
        if length is None:
            continue
        folder, hours = f"{chosen.out}/{preset}", (length or usual) * unit
        # All columns come from one pass; the frames are cut out of its small result.
        table = trend_table(tables, rule, as_of, hours)
        table.write.mode("overwrite").parquet(f"{folder}/table")
        stored = spark.read.parquet(f"{folder}/table")
        frames = {name: frame_of(stored, name) for name in FRAMES}
        frames["SOC"] = battery_mean_of_means(tables.window(as_of, hours).battery, rule)
        for name, frame in frames.items():
            tick_labels(frame, fmt).write.mode("overwrite").parquet(f"{folder}/{name}")
    if chosen.twoday:
        bands = price_window(tables.prices, as_of)
        labelled = tick_labels(bands, "%Hh", keys=["market_id"])
        labelled.write.mode("overwrite").parquet(f"{chosen.out}/twoday")
    if chosen.report is not None:
        write_report(monthly_report(tables, as_of, chosen.report), f"{chosen.out}/report")


if __name__ == "__main__":
    main()
