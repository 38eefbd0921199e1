"""Sums and means that do not depend on the order in which rows arrive.

Adding doubles gives different last digits on every run of a distributed job. Here each
value is first turned into a whole number of small units, so that the sum is integer
arithmetic: associative, inside whole-stage codegen and as fast as adding doubles
(a decimal sum of the same data is some fifteen times slower).

Values are column names or SQL expressions over columns: one call to the JVM per measure
instead of one per operation, which counts in reports with two dozen of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money and miles are counted in 1/10,000: 4e13 rows of 20 dollars fit in a bigint.
AMOUNT_STEP = 10_000.0
# Ratios and means of means are counted in 1/1,000,000, in two parts (see ratio_mean).
RATIO_STEP = 1_000_000.0
_HALF_BITS = 20
_HALF = 1 << _HALF_BITS


def units(value: str, step: float = AMOUNT_STEP) -> str:
    """SQL for the value as a whole number of ``1/step``, rounding halves to even."""
    return f"CAST(rint(({value}) * {step}D) AS BIGINT)"


def total(value: str) -> Column:
    """SUM of an amount."""
    return F.expr(_total(value))


def _total(value: str) -> str:
    return f"CAST(sum({units(value)}) AS DOUBLE) / {AMOUNT_STEP}D"


def mean(value: str) -> Column:
    """AVG of an amount; NULL for a group without values."""
    return F.expr(f"{_total(value)} / count({value})")


def int_mean(value: str) -> Column:
    """AVG of an integer column."""
    return F.expr(f"CAST(sum(CAST({value} AS BIGINT)) AS DOUBLE) / count({value})")


def ratio_mean(value: str) -> Column:
    """AVG of a ratio or of a mean.

    The finer step could overflow one bigint at cluster scale, so the high and the low
    bits are summed apart and joined again, exactly, once per group.
    """
    fine = units(value, RATIO_STEP)
    high = f"CAST(sum(shiftright({fine}, {_HALF_BITS})) AS DECIMAL(38,0))"
    low = f"sum({fine} & {_HALF - 1}L)"
    return F.expr(f"CAST({high} * {_HALF} + {low} AS DOUBLE) / {RATIO_STEP}D / count({value})")


def count_where(test: Column) -> Column:
    """COUNT of rows passing a test (NULL counts as failed)."""
    return F.count(F.when(test, F.lit(1)))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL when there is no whole."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def minutes(seconds: Column) -> Column:
    return seconds / F.lit(60.0)


def round_half_up(value: Column, places: int) -> Column:
    """Scale, round halves away from zero, scale back.

    ``F.round(x, 2)`` decides ties on the printed decimal, one BigDecimal per row; this
    decides them on the scaled double, as SQL engines written in C do, in plain arithmetic.
    """
    factor = F.lit(float(10**places))
    size = F.abs(value * factor)
    whole = F.floor(size)
    rounded = whole + F.when(size - whole >= 0.5, F.lit(1)).otherwise(F.lit(0))
    return F.signum(value) * rounded / factor
