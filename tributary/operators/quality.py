"""Checks that return their failing rows: an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count_match(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row with both counts when they differ. Only one-row aggregates meet."""
    counted = source.agg(F.count(F.lit(1)).alias("source_row_count"))
    target_count = target.agg(F.count(F.lit(1)).alias("n")).scalar()
    both = counted.withColumn("target_row_count", target_count)
    return both.where("source_row_count != target_row_count")


def type_check(df: DataFrame, table: str, expected: Mapping[str, str]) -> DataFrame:
    """One row per column whose type differs from the expected one; absent columns pass.

    ``decimal`` without a precision accepts any. Reads the schema only, never the data.
    """
    actual = dict(df.dtypes)

    def fits(kind: str, found: str) -> bool:
        return found == kind or (kind == "decimal" and found.startswith("decimal("))

    wrong = [
        (table, column, kind, actual[column])
        for column, kind in expected.items()
        if column in actual and not fits(kind, actual[column])
    ]
    return df.sparkSession.createDataFrame(
        wrong, "table_name string, column_name string, expected_type string, actual_type string"
    )
