"""Rounding and averaging that give one answer whatever the row order.

Spark's own ``round`` and double-to-decimal cast go through the decimal text of
the double (1.005 becomes 1.01). The results to match scale first and round
half away from zero (1.005 * 100 = 100.49999999999999, hence 1.00). The
expressions below do that without leaving generated code. They take SQL text,
which is one call into the JVM however long the expression is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _half_away(value: str) -> str:
    # rint sends ties to the even neighbour, which may be the one nearer to zero.
    return (
        f"(rint({value}) + CASE WHEN {value} - rint({value}) = signum({value}) * 0.5D "
        f"THEN signum({value}) ELSE 0D END)"
    )


def _rounded(value: str, digits: int) -> str:
    return f"({_half_away(f'(({value}) * 1e{digits}D)')} / 1e{digits}D)"


def half_away(value: str) -> Column:
    """Nearest whole double; exact ties go away from zero."""
    return F.expr(_half_away(f"({value})"))


def round_half_away(value: str, digits: int) -> Column:
    return F.expr(_rounded(value, digits))


def settled(value: str, digits: int) -> Column:
    """Round a floating sum or mean to ``digits`` places, whatever the row order.

    The last bits of such a value depend on the order the rows came in, which
    decides exact ties. Rounding six places finer first takes that noise away.
    """
    fine = f"1e{digits + 6}D"
    return F.expr(_rounded(f"rint(({value}) * {fine}) / {fine}", digits))


#: Floating values are added up as decimals of eight places, which is exact in any order.
EXACT = "DECIMAL(28, 8)"


def exact_sum(column: str, digits: int) -> Column:
    """Rounded sum of a floating column, the same whatever the row order and however large."""
    return F.expr(_rounded(f"CAST(sum(try_cast({column} AS {EXACT})) AS DOUBLE)", digits))


def exact_mean(column: str, digits: int) -> Column:
    """Rounded mean of a floating column, taken from its exact sum."""
    value = f"try_cast({column} AS {EXACT})"
    return F.expr(_rounded(f"CAST(sum({value}) AS DOUBLE) / count({value})", digits))


def _is_floating(source: T.DataType) -> bool:
    return isinstance(source, (T.DoubleType, T.FloatType))


def to_integer(value: str, source: T.DataType) -> Column:
    """Rounding integer cast: doubles to the nearest even, as in the staging contract, decimals half away."""
    if _is_floating(source):
        return F.expr(f"CAST(rint({value}) AS INT)")
    if isinstance(source, T.DecimalType):
        return F.expr(f"CAST(round({value}) AS INT)")
    return F.expr(f"CAST({value} AS INT)")


def to_money(value: str, source: T.DataType) -> Column:
    """decimal(18,2) cast of any numeric column."""
    if not _is_floating(source):
        return F.expr(f"CAST({value} AS DECIMAL(18, 2))")
    cents = _half_away(f"(CAST({value} AS DOUBLE) * 100D)")
    return F.expr(f"CAST(CAST(CAST({cents} AS BIGINT) AS DECIMAL(18, 0)) * 0.01BD AS DECIMAL(18, 2))")


def mean_decimal(column: str, digits: int = 2) -> Column:
    """Rounded mean of a decimal(18,2) column, taken from the exact sum in cents."""
    return F.expr(
        _rounded(f"CAST(sum({column}) * 100 AS DOUBLE) / (count({column}) * 100D)", digits)
    )


def mean_minutes(column: str, digits: int = 2) -> Column:
    """Rounded mean of a minutes column that was derived from whole seconds.

    Summing the seconds as integers keeps the mean independent of row order, so
    a rerun gives the same mart to the last digit.
    """
    seconds = f"sum(CAST(rint({column} * 60D) AS BIGINT))"
    return F.expr(_rounded(f"{seconds} / (count({column}) * 60D)", digits))


def share_pct(condition: str, digits: int = 2) -> Column:
    """Percentage of rows that meet the condition; NULL counts as not met."""
    return F.expr(_rounded(f"100D * avg(CASE WHEN {condition} THEN 1 ELSE 0 END)", digits))
