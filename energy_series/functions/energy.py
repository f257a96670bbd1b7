"""Energy, money and number expressions (all row-local, all code-generated)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Means of prices are taken over exact decimals, and money is a product of whole
# numbers: Wh and hundred-millionths of a euro per kWh. Sums then do not depend on
# the order of rows, and no slow wide decimals are needed.
PRICE_TYPE = "decimal(12,8)"
PRICE_UNITS = 100_000_000


def numeric(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Every text column outside ``keep`` becomes DOUBLE, unreadable text and NaN become NULL."""
    kept = set(keep)
    return df.select(
        *[
            F.nanvl(F.col(f.name).try_cast("double"), F.lit(None)).alias(f.name)
            if f.name not in kept and isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def scaled(col: Column | str, factor: float) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double") * F.lit(factor)


def kwh(col: Column | str) -> Column:
    """Wh to kWh."""
    return scaled(col, 0.001)


def percent(col: Column | str) -> Column:
    """Centi-percent to percent."""
    return scaled(col, 0.01)


def at_least_zero(col: Column) -> Column:
    return F.when(col < 0, F.lit(0)).otherwise(col)


def own_use(exp: Column, gep: Column, evp: Column) -> Column:
    """Energy used inside the home that the grid did not deliver; ``exp`` is negative."""
    return at_least_zero(exp + gep + evp)


def stored_solar(gep: Column, solar: Column) -> Column:
    """Solar energy that did not reach the home, shown below the axis."""
    return -F.when(gep < solar, solar - gep).otherwise(solar)


def price_units(price: Column) -> Column:
    return F.round(price * F.lit(float(PRICE_UNITS))).cast("bigint")


def money(energy_wh: Column, units: Column) -> Column:
    """Exact product of whole Wh and :func:`price_units`."""
    return energy_wh * units


def euro(total: Column | str) -> Column:
    """Presentation of a sum of :func:`money`."""
    col = F.col(total) if isinstance(total, str) else total
    return col.cast("double") / F.lit(1000.0 * PRICE_UNITS)


def truncated(col: Column, factor: float, to: str = "bigint") -> Column:
    """Scale and cut towards zero."""
    return (col * F.lit(factor)).cast(to)


def mean_of_present(a: Column, b: Column) -> Column:
    """Mean of two readings where one may be missing; NULL when both are."""
    a, b = (F.when(~F.isnan(x.cast("double")), x) for x in (a, b))
    return (F.coalesce(a, b) + F.coalesce(b, a)) / F.lit(2)


def signed_text(col: Column | str) -> Column:
    """Whole number with its sign, ties to even."""
    col = (F.col(col) if isinstance(col, str) else col).cast("double")
    sign = F.when(col < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, F.format_string("%.0f", F.bround(F.abs(col), 0)))


def tariff_import(used: Column, exported: Column) -> Column:
    return at_least_zero(used - exported)


def tariff_export(used: Column, exported: Column) -> Column:
    return at_least_zero(exported - used)
