"""Exact money arithmetic and PostgreSQL-style rounding.

Credits are doubles at rest. Summing doubles depends on row order, which a
distributed engine does not fix, so an amount is a struct of two parts. A credit
with up to four decimals is ``main``, a count of 1/10,000 units (a long), whose
sums accumulate exactly in ``decimal(38,0)``. Any other credit (more decimals,
beyond UNITS_BOUND, NaN, infinite) is ``rest``, a double summed as it is, so it
is neither rounded nor dropped nor can it overflow. Totals come back as one
double. Converting a double to a decimal row by row is several times slower.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditlake.schemas import AMOUNT_SCALE, ROUNDING_TYPE, UNITS_TOTAL_TYPE

_UNITS_PER_CREDIT = 10**AMOUNT_SCALE
#: Credits below this have units that a double holds exactly (2^53 / 10^4, rounded down).
UNITS_BOUND = 9.0e11


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _amount(main: Column, rest: Column) -> Column:
    return F.struct(main.alias("main"), rest.alias("rest"))


def to_amount(col: Column | str) -> Column:
    """Double credits as an amount; NULL stays NULL."""
    c = _c(col)
    units = F.rint(c * F.lit(float(_UNITS_PER_CREDIT)))
    plain = (F.abs(c) < F.lit(UNITS_BOUND)) & (units / F.lit(float(_UNITS_PER_CREDIT)) == c)
    parts = _amount(
        F.when(plain, units.cast("long")).otherwise(F.lit(0).cast("long")),
        F.when(plain, F.lit(0.0)).otherwise(c),
    )
    return F.when(c.isNotNull(), parts)


def signed(amount: Column | str, add: Column, deduct: Column | None = None) -> Column:
    """The amount where ``add`` holds, its negative where ``deduct`` does, else zero."""

    def part(name: str, zero: Column) -> Column:
        x = _c(amount)[name]
        out = F.when(add, x)
        return (out if deduct is None else out.when(deduct, -x)).otherwise(zero)

    return _amount(part("main", F.lit(0)), part("rest", F.lit(0.0)))


def sum_amount(amount: Column | str) -> Column:
    """Sum of amounts (of rows or earlier sums): the main part exactly."""
    x = _c(amount)
    return _amount(F.sum(x["main"].cast(UNITS_TOTAL_TYPE)), F.sum(x["rest"]))


def amount_to_double(amount: Column | str) -> Column:
    """Amount → double number of credits."""
    x = _c(amount)
    return (x["main"].cast(UNITS_TOTAL_TYPE) / F.lit(_UNITS_PER_CREDIT)).cast("double") + x["rest"]


def to_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def exact_sum(col: Column | str) -> Column:
    """Sum of a double column, exact for values of up to four decimals, returned as double."""
    return amount_to_double(sum_amount(to_amount(col)))


def round_half_away(col: Column | str, places: int = 2) -> Column:
    """``ROUND(x::numeric, places)``: half away from zero on the decimal value.

    Doubles of 1e15 and more, which hold no such decimals, and NaN stay as they are.
    """
    c = _c(col)
    fits = F.abs(c) < F.lit(1e15)
    return F.when(fits, to_double(F.round(F.when(fits, c).cast(ROUNDING_TYPE), places))).otherwise(c)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL when the denominator is 0 or NULL (``x / NULLIF(n, 0)``)."""
    return to_double(numerator) / F.nullif(denominator, F.lit(0))


def exact_mean(col: Column | str) -> Column:
    """``AVG(x)`` of a double column with an exact sum (NULLs skipped)."""
    c = _c(col)
    return ratio(exact_sum(c), F.count(c))
