"""The column functions that SQL users call by name, as temporary SQL functions.

Catalyst inlines their bodies, so they cost no more than the expressions themselves.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tributary.functions.dates import MONTHS

_MONTHS = "map(" + ", ".join(f"'{name}', {number}" for name, number in MONTHS.items()) + ")"
_PLAIN = "try_cast(translate(value, ',.', '.') AS DECIMAL(15,2))"

FUNCTIONS = {
    "parse_date(label STRING) RETURNS DATE": f"""
        add_months(
            try_to_date(concat(try_cast(split_part(label, '/', 2) AS INT) - 1, '-12-01'), 'y-MM-dd'),
            coalesce(try_element_at({_MONTHS}, split_part(label, '/', 1)),
                     try_cast(split_part(label, '/', 1) AS INT)))""",
    "format_nc(number STRING) RETURNS STRING": """
        CASE WHEN number IS NULL THEN ''
             WHEN right(number, 4) RLIKE '^[0-9]+$' THEN concat(left(number, 7), lpad(right(number, 4), 5, '0')) END""",
    "parse_financial_value(value STRING) RETURNS DECIMAL(15,2)": rf"""
        CASE WHEN value IS NULL OR trim(value) = '' OR contains(value, 'NaN') THEN CAST(0 AS DECIMAL(15,2))
             WHEN startswith(value, '(') THEN
                 try_cast(regexp_replace(translate(value, '.', ''), r'\(?(\d+),(\d+)\)?', '-$1.$2') AS DECIMAL(15,2))
             ELSE {_PLAIN} END""",
}


def register(spark: SparkSession) -> None:
    """Make the functions known to the session."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
