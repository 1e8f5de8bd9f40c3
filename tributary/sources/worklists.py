"""Key lists that drive the next fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.keyed import all_not_null


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).where(all_not_null(keys)).distinct()


def document_keys(df: DataFrame, number: str, *others: str) -> DataFrame:
    """Year (first four characters) and serial (last six) of a document number, with its other key
    parts; rows that lack a part, or have it empty, are skipped."""
    present = df
    for c in (number, *others):
        present = present.where(F.col(c).isNotNull() & (F.col(c) != ""))
    return present.select(
        *others, F.left(number, F.lit(4)).alias("ano"), F.right(number, F.lit(6)).alias("numero")
    )


def units_by_year(units: DataFrame, unit: str, first_year: int, last_year: int) -> DataFrame:
    """Each unit with each year of the range (a handful of years, written into every row)."""
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    return units.select(unit).distinct().select(unit, F.explode(years).alias("ano"))
