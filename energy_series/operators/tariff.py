"""Adding, subtracting and balancing series per tariff, and the year by month matrix."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import KEYS
from ..functions import energy as e


def _add(a: Column, b: Column) -> Column:
    return a + b


def _subtract(allow_negatives: bool) -> Callable[[Column, Column], Column]:
    return lambda a, b: a - b if allow_negatives else e.at_least_zero(a - b)


def _combine(left, right, on, value, operation) -> DataFrame:
    sides = (left.select(*on, F.col(value).alias("_a")), right.select(*on, F.col(value).alias("_b")))
    a, b = (F.coalesce(F.col(c), F.lit(0)) for c in ("_a", "_b"))
    return sides[0].join(sides[1], list(on), "full").select(*on, operation(a, b).alias(value))


def _from_end(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("from_end", F.row_number().over(newest_first))


def contract(left, right, keys=KEYS, label: str = "label", value: str = "v") -> DataFrame:
    """Add two labelled series; a label one side lacks counts as 0 there."""
    return _combine(left, right, [*keys, label], value, _add)


def distract(
    left, right, keys=KEYS, label: str = "label", value: str = "v", allow_negatives: bool = False
) -> DataFrame:
    """Subtract a labelled series from another; negative results become 0 unless allowed."""
    return _combine(left, right, [*keys, label], value, _subtract(allow_negatives))


def contract_aligned(left, right, keys=KEYS, order: str = "label", value: str = "v") -> DataFrame:
    """Add two series by position counted from their ends (``from_end`` = 1 is the last)."""
    sides = (_from_end(df, keys, order) for df in (left, right))
    return _combine(*sides, [*keys, "from_end"], value, _add)


def distract_aligned(
    left, right, keys=KEYS, order: str = "label", value: str = "v", allow_negatives: bool = False
) -> DataFrame:
    sides = (_from_end(df, keys, order) for df in (left, right))
    return _combine(*sides, [*keys, "from_end"], value, _subtract(allow_negatives))


def _zip_from_end(a: Column, b: Column, operation) -> Column:
    zero = F.lit(0.0)
    return F.reverse(
        F.zip_with(
            F.reverse(a),
            F.reverse(b),
            lambda x, y: operation(F.coalesce(x, zero), F.coalesce(y, zero)),
        )
    )


def contract_arrays(a: Column, b: Column) -> Column:
    """Add two array columns aligned at their ends."""
    return _zip_from_end(a, b, _add)


def distract_arrays(a: Column, b: Column, allow_negatives: bool = False) -> Column:
    return _zip_from_end(a, b, _subtract(allow_negatives))


def zip_shortest(*series: DataFrame, keys: Sequence[str] = KEYS, label: str = "label") -> DataFrame:
    """Side-by-side series over the labels all of them have."""
    first, *rest = series
    for other in rest:
        first = first.join(other, [*keys, label], "inner")
    return first


def _balanced(df: DataFrame, low_import, low_export, high_import, high_export, own) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("ilo", "ihi", "xlo", "xhi", "own")],
        low_import.alias("import_lo"),
        high_import.alias("import_hi"),
        low_export.alias("export_lo"),
        high_export.alias("export_hi"),
        own.alias("own"),
    )


def balance_single(df: DataFrame) -> DataFrame:
    """Cancel import against export over both tariffs together.

    Columns ``ilo, ihi, xlo, xhi`` are import and export of the low and high
    tariff, ``own`` is the own use. The high results are 0.
    """
    used, exported = F.col("ilo") + F.col("ihi"), F.col("xlo") + F.col("xhi")
    nothing = F.lit(0).cast(dict(df.dtypes)["ilo"])
    return _balanced(
        df,
        e.tariff_import(used, exported),
        e.tariff_export(used, exported),
        nothing,
        nothing,
        F.col("own") + F.least(used, exported),
    )


def balance_dual(df: DataFrame, accumulate: bool = False) -> DataFrame:
    """Cancel import against export within each tariff.

    Own use grows by the cancelled high-tariff energy; ``accumulate`` adds the
    cancelled low-tariff energy as well.
    """
    ilo, ihi, xlo, xhi = (F.col(c) for c in ("ilo", "ihi", "xlo", "xhi"))
    own = F.col("own") + F.least(ihi, xhi)
    return _balanced(
        df,
        e.tariff_import(ilo, xlo),
        e.tariff_export(ilo, xlo),
        e.tariff_import(ihi, xhi),
        e.tariff_export(ihi, xhi),
        own + F.least(ilo, xlo) if accumulate else own,
    )


def year_month_matrix(
    df: DataFrame,
    values: Sequence[str] = ("use", "expo"),
    keys: Sequence[str] = KEYS,
    label: str = "label",
    order: str | None = None,
) -> DataFrame:
    """One row per year, one column per value and month (``use_01`` ...).

    Labels are ``YYYY-MM``. Every year between the first and last one has a row,
    missing months are 0. Labels are unique, or the last row of a label by ``order`` wins.
    """
    parts = F.split(label, "-")
    dated = df.withColumns({"_year": parts[0].cast("int"), "_month": parts[1].cast("int")})
    months = [(v, m, f"{v}_{m:02d}") for v in values for m in range(1, 13)]

    def value(v: str, m: int) -> Column:
        here = F.col("_month") == m
        return F.max_by(v, F.when(here, F.col(order))) if order else F.max(F.when(here, F.col(v)))

    years = dated.groupBy(*keys, F.col("_year").alias("year")).agg(
        *[F.coalesce(value(v, m), F.lit(0)).alias(name) for v, m, name in months]
    )
    by_year = Window.partitionBy(*keys).orderBy("year")
    until = F.coalesce(F.lead("year").over(by_year) - 1, F.col("year"))
    spread = years.withColumn("_until", until).select(
        "*", F.posexplode(F.sequence("year", "_until")).alias("_pos", "_row")
    )
    types = dict(years.dtypes)
    return spread.select(
        *keys,
        F.col("_row").alias("year"),
        *[
            F.when(F.col("_pos") == 0, F.col(name))
            .otherwise(F.lit(0).cast(types[name]))
            .alias(name)
            for _, _, name in months
        ],
    )
