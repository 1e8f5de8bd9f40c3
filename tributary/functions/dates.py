"""Dates that are text of several shapes, month labels and calendar differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.text import Colish, as_col

# Month abbreviations used by the source systems.
MONTHS = {
    "JAN": 1, "FEV": 2, "MAR": 3, "ABR": 4, "MAI": 5, "JUN": 6,
    "JUL": 7, "AGO": 8, "SET": 9, "OUT": 10, "NOV": 11, "DEZ": 12,
}

ISO = "yyyy-MM-dd"
DAY_FIRST = "dd/MM/yyyy"
DAY_FIRST_COMPACT = "ddMMyyyy"
YEAR_FIRST_COMPACT = "yyyyMMdd"


def parsed(c: Colish, pattern: str) -> Column:
    """A date, or null when the text does not fit."""
    return F.try_to_date(as_col(c), pattern)


def guarded_iso(c: Colish) -> Column:
    """A date only from text that is exactly ``YYYY-MM-DD``."""
    column = as_col(c)
    return F.when(column.rlike(r"^\d{4}-\d{2}-\d{2}$"), parsed(column, ISO))


def guarded_compact(c: Colish, pattern: str = DAY_FIRST_COMPACT) -> Column:
    """A date only from text of exactly eight characters."""
    column = as_col(c)
    return F.when(F.length(column) == 8, parsed(column, pattern))


def month_start(c: Colish) -> Column:
    """First day of the month of ``YYYYMM`` text."""
    return parsed(F.concat(as_col(c), F.lit("01")), YEAR_FIRST_COMPACT)


def month_number(c: Colish) -> Column:
    """Number of a month abbreviation, null for any other text."""
    pairs = [part for name, number in MONTHS.items() for part in (F.lit(name), F.lit(number))]
    return F.create_map(*pairs)[as_col(c)]


def parse_month_label(c: Colish) -> Column:
    """``FEV/2024`` to 2024-02-01.

    A number in place of the name counts months from December of the year before, so
    ``000/2024`` is 2023-12-01.
    """
    column = as_col(c)
    label = F.split_part(column, F.lit("/"), F.lit(1))
    year = F.split_part(column, F.lit("/"), F.lit(2)).try_cast("int")
    months = F.coalesce(month_number(label), label.try_cast("int"))
    december = parsed(F.concat((year - 1).cast("string"), F.lit("-12-01")), "y-MM-dd")
    return F.add_months(december, months)


def parse_compact_month_label(c: Colish) -> Column:
    """``FEV2024`` (any case) to 2024-02-01, null for any other shape."""
    column = as_col(c)
    month = month_number(F.upper(F.substring(column, 1, 3)))
    year = F.substring(column, 4, 4)
    return parsed(F.concat(year, F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-01")), ISO)


def calendar_age(later: Colish, earlier: Colish) -> Column:
    """Difference of two dates as struct<years, months, days>.

    Days borrow the length of the earlier date's month. A reversed pair gives negative parts.
    """
    a, b = as_col(later).cast("date"), as_col(earlier).cast("date")
    high, low = F.greatest(a, b), F.least(a, b)
    sign = F.when(a < b, F.lit(-1)).otherwise(F.lit(1))
    days = F.day(high) - F.day(low)
    borrowed = F.when(days < 0, F.lit(1)).otherwise(F.lit(0))
    months = (F.year(high) - F.year(low)) * 12 + F.month(high) - F.month(low) - borrowed
    whole_days = days + borrowed * F.day(F.last_day(low))
    return F.when(
        a.isNotNull() & b.isNotNull(),
        F.struct(
            (sign * F.floor(months / 12).cast("int")).alias("years"),
            (sign * F.pmod(months, F.lit(12))).cast("int").alias("months"),
            (sign * whole_days).cast("int").alias("days"),
        ),
    )
