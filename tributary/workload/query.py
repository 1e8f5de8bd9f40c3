"""What a checked query is, and the form in which results are compared."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import ensure_skew_handling


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Tables:
    """The provided tables of one folder, read when named."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir.rstrip("/")
        ensure_skew_handling(spark)

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles and dates as text, so that two engines' results compare by value."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(sql: str | None = None):
    """Mark a function of (tables, spark) as a checked query."""
    def wrap(build: Callable[[Tables, SparkSession], DataFrame]) -> Query:
        return Query(lambda spark, sf_dir: comparable(build(Tables(spark, sf_dir), spark)), sql)

    return wrap


def collect_queries(namespace: dict) -> dict[str, Query]:
    return {name: value for name, value in namespace.items() if isinstance(value, Query)}
