"""Cleaning and metric expressions of the statistics table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: year, day and month with two digits each.
SHORT_DATE = r"^\d{2}\.\d{2}\.\d{2}$"
NUMBER = r"^\s*[+-]?\d+(\.\d*)?\s*$"


def region_key(region: Column) -> Column:
    """Lower-case region without surrounding spaces."""
    return F.lower(F.trim(region))


def landing_region(region: Column) -> Column:
    """Like :func:`region_key`, but tabs and line ends are removed as well."""
    return F.lower(F.btrim(region, F.lit(" \t\r\n\f\v")))


def to_count(value: Column, dtype: T.DataType) -> Column:
    """Whole number, or null for text that holds none; a number is only widened.

    Text with a fraction keeps its whole part, as the lenient cast did. Unusable text is
    sorted out by its form: a failing cast raises and catches an error for every row.
    """
    if isinstance(dtype, T.LongType):
        return value
    if not isinstance(dtype, T.StringType):
        return value.try_cast("bigint")
    return F.when(value.rlike(NUMBER), F.substring_index(value, ".", 1).try_cast("bigint"))


def is_short_date(text: Column) -> Column:
    """True for text of the form ``yy.dd.MM``."""
    return text.rlike(SHORT_DATE)


def trending_day(text: Column) -> Column:
    """Date of ``yy.dd.MM`` or ISO text, null when there is no such day.

    The short form is rebuilt as ISO text: the two-digit year counts from 2000, and the
    result does not depend on the time parser policy of the session.
    """
    iso = F.concat(
        F.lit("20"), text.substr(1, 2), F.lit("-"), text.substr(7, 2), F.lit("-"), text.substr(4, 2)
    )
    return F.when(is_short_date(text), iso.try_cast("date")).otherwise(text.try_cast("date"))


def short_date_text(day: Column) -> Column:
    """Date as ``yy.dd.MM`` text, the form the historic files use."""
    return F.date_format(day, "yy.dd.MM")


def zero_if_null(count: Column) -> Column:
    return F.coalesce(count, F.lit(0).cast("bigint"))


def percent_of_views(amount: Column, views: Column) -> Column:
    """``amount`` per hundred views with four decimals, 0 where nothing was viewed."""
    return F.when(views > 0, four_decimals(amount.cast("double") / views * 100)).otherwise(F.lit(0.0))


def four_decimals(value: Column) -> Column:
    """As ``round(value, 4)``, which writes every number as text and reads it again.

    That is needed only near the middle of two results and for numbers so large that their fractions are inexact.
    """
    units = value * 10_000
    nearest = F.floor(units + 0.5)
    clear = (F.abs(units) < 1e9) & (F.abs(F.abs(units - nearest) - 0.5) > 1e-6)
    return F.when(clear, nearest.cast("double") / 10_000).otherwise(F.round(value, 4))


def exact_sum(name: str) -> Column:
    """Sum of a count that no dirty file can push out of its type, 0 where no count is known."""
    return F.coalesce(F.sum(F.col(name).cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)")


def total_of(sums: Column) -> Column:
    """An exact sum as it is published: null where it is beyond a bigint."""
    return sums.try_cast("bigint")


# Ratios below this many percent are summed as whole ten-thousandths.
_SMALL_RATIO = 10_000.0


def ratio_parts(name: str) -> list[Column]:
    """Aggregates of a four-decimal ratio from which its mean follows exactly.

    Sums of doubles differ in the last digit from run to run; here every sum is exact, so
    a retried task gives the same result. Usual ratios are summed as bigint, which is far
    cheaper than a decimal; only absurd ones take the decimal, which holds them all. Both
    give the same mean.
    """
    value = F.col(name)
    small = (value < _SMALL_RATIO) & (value > -_SMALL_RATIO)
    return [
        F.sum(F.when(small, F.floor(value * 10_000 + 0.5))).alias(f"{name}_units"),
        F.sum(F.when(~small, value.cast("decimal(25,4)"))).cast("decimal(35,4)").alias(f"{name}_rest"),
        F.count(value).alias(f"{name}_n"),
    ]


def mean_of_parts(name: str) -> Column:
    """Mean of a ratio from any number of rows of its ``ratio_parts``."""
    units = F.coalesce(F.sum(f"{name}_units"), F.lit(0)).cast("decimal(20,0)")
    rest = F.coalesce(F.sum(f"{name}_rest"), F.lit(0)).cast("decimal(35,4)")
    total = units * F.lit(Decimal("0.0001")) + rest
    return F.try_divide(total.cast("double"), F.sum(f"{name}_n"))
