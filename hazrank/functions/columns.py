"""Reusable column expressions.

Everything here is a plain Catalyst expression so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazrank.config import (
    GALLONS_PER_CUBIC_YARD, GALLONS_PER_LITRE, LB_PER_GALLON_WATER, LB_PER_KG, LB_PER_SHORT_TON,
)


def conditional_count(cond: Column) -> Column:
    """count(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1)))


# --- F12 --------------------------------------------------------------------
def conditional_ratio(cond: Column, denominator: Column | None = None) -> Column:
    """Share of rows satisfying ``cond`` as DOUBLE (NULL on an empty group)."""
    den = denominator if denominator is not None else F.count(F.lit(1))
    return conditional_count(cond).cast("double") / den


def flag_yn(c: Column) -> Column:
    """'Y' -> 1, 'N' -> 0, anything else -> NULL."""
    return F.when(c == "N", F.lit(0)).when(c == "Y", F.lit(1))


# --- F5 ---------------------------------------------------------------------
def pounds_exact(unit: Column, qty: Column, density: Column, density_unit: Column) -> Column:
    """Generated quantity in pounds as an exact DECIMAL.

    unit 1 lb, 2 short tons, 3 kg, 4 metric tons; 5 gallons, 6 litres,
    7 cubic yards need a density: density unit '2' = specific gravity
    (times the weight of a gallon of water), '1' = lb per gallon.
    A specific gravity of exactly 1 is the unknown-density marker and
    gives NULL; other density units give NULL.

    Quantities and densities are reported in at most four decimals and enter
    as such; products are not rounded, so their sums depend on no order.
    """
    number = lambda v, kind: F.lit(str(v)).cast(kind)
    qty, density_ = qty.cast("decimal(14,4)"), density.cast("decimal(6,4)")
    per_unit = (F.when(unit.isin("1", "5"), number(1, "decimal(10,6)"))
                 .when(unit == "2", number(LB_PER_SHORT_TON, "decimal(10,6)"))
                 .when(unit.isin("3", "4"), number(LB_PER_KG, "decimal(10,6)"))
                 .when(unit == "6", number(GALLONS_PER_LITRE, "decimal(10,6)"))
                 .when(unit == "7", number(GALLONS_PER_CUBIC_YARD, "decimal(10,6)")))
    volume = unit.isin("5", "6", "7")
    known = (density_unit == "1") | ((density_unit == "2") & (density != 1))
    weight = (F.when(volume & known, F.when(density_unit == "2", number(LB_PER_GALLON_WATER, "decimal(7,3)"))
                     .otherwise(number(1, "decimal(7,3)")))
               .when(~volume, F.when(unit == "4", number(1000, "decimal(7,3)")).otherwise(number(1, "decimal(7,3)"))))
    return qty * per_unit * F.when(volume, density_).otherwise(number(1, "decimal(6,4)")) * weight


def to_pounds(unit: Column, qty: Column, density: Column, density_unit: Column) -> Column:
    """``pounds_exact`` as a DOUBLE."""
    return pounds_exact(unit, qty, density, density_unit).cast("double")


# Two-stage half-up rounding.  Engines sum doubles in different orders,
# so a value whose exact decimal form is a tie (0.0890625 = 57/640) can
# come out a hair above in one engine and a hair below in the other.
# Stage 1 rounds at 10 decimals and absorbs such last-bit noise; stage 2
# rounds at ``digits``.  ``floor`` is taken as ``z - pmod(z, 1)``, which stays
# a double: one rule for every value, with no detour through a long.
NOISE_DIGITS = 10


def round_half_up_sql(x: str, digits: int = 6) -> str:
    """SQL text of ``round_half_up`` for a column expression ``x``."""
    n = f"{float(10 ** NOISE_DIGITS)!r}D"
    scale = f"{float(10 ** digits)!r}D"
    down = lambda z: f"(({z}) - pmod({z}, 1.0D))"
    y = f"({down(f'{x} * {n} + 0.5D')} / {n})"
    return (f"CASE WHEN isnan({x}) OR abs({x}) = double('Infinity') THEN {x} "
            f"ELSE {down(f'{y} * {scale} + 0.5D')} / {scale} END")


def sql_in(col: str, values) -> str:
    return f"{col} IN (" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def count_if_sql(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


def round_half_up(x: Column, digits: int = 6) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on the binary double.

    Stated as arithmetic so every engine gives the same bits (engine
    ``round`` functions differ on exact decimal ties).
    """
    n = float(10 ** NOISE_DIGITS)
    scale = float(10 ** digits)
    finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    down = lambda z: z - F.pmod(z, F.lit(1.0))
    y = down(x * F.lit(n) + F.lit(0.5)) / F.lit(n)
    return F.when(finite, down(y * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).otherwise(x)
