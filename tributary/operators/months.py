"""Gap filling along the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_months(
    spans: DataFrame,
    calendar: DataFrame,
    first: str,
    last: str,
    month: str,
) -> DataFrame:
    """Every ``month`` of the calendar inside each row's [first, last]; a row without any keeps null.

    ``calendar`` is a frame of dates. Its distinct values, grouped by year, become one map that
    travels as a scalar: a date column holds at most 366 values a year, so the map is bounded by
    the calendar and not by the data. Each span then picks the years it touches. There is no range
    join and no shuffle of the spans.
    """
    dates = calendar.select(F.col(month).alias("_d")).where("_d is not null").distinct()
    by_year = dates.groupBy(F.year("_d").alias("_y")).agg(F.sort_array(F.collect_list("_d")).alias("_days"))
    years = by_year.agg(F.map_from_entries(F.collect_list(F.struct("_y", "_days")))).scalar()

    low, high = F.col(first), F.col(last)
    touched = F.sequence(F.year(low), F.year(high))
    inside = F.filter(
        F.flatten(F.transform(touched, lambda y: F.coalesce(F.col("_years")[y], F.array().cast("array<date>")))),
        lambda d: (d >= low) & (d <= high),
    )
    months = F.when(low.isNotNull() & high.isNotNull() & (low <= high), inside)
    keep = [c for c in spans.columns if c != month]
    return (
        spans.withColumn("_years", years)
        .select(*keep, F.explode_outer(months).alias(month))
    )


def month_spine(df: DataFrame, key: str, month: str) -> DataFrame:
    """For each key, all months seen anywhere between its own first and last month."""
    spans = df.groupBy(key).agg(F.min(month).alias("_first"), F.max(month).alias("_last"))
    return fill_months(spans, df, "_first", "_last", month).select(key, month)
