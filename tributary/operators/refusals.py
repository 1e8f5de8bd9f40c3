"""Rows that a job cannot take: kept beside the rows it takes, with the reason and a count."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import fresh_folder

REASON = "refused_because"


@dataclass(frozen=True)
class Sifted:
    """The rows a job goes on with, those it refuses (with ``refused_because``), and how many of each reason."""

    accepted: DataFrame
    refused: DataFrame
    counts: dict[str, int]


def sift(df: DataFrame, rules: Mapping[str, Column], path: str | None = None) -> Sifted:
    """Divide ``df`` in one pass: a row is refused for the first rule that is true for it.

    Both parts are one table in the shared folder (or at ``path``, which is replaced), partitioned by the reason, so
    every row of ``df`` is in exactly one of them, reading one part opens none of the other's files, and the input is computed
    once. The counts are observed while the table is written.
    """
    if REASON in df.columns:
        raise ValueError(f"the rows already have a column {REASON}")
    path = path or fresh_folder(df.sparkSession, "sifted")
    reason = F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules.items()], F.lit(None).cast("string"))
    seen = Observation()
    counted = [F.count(F.when(F.col(REASON) == name, 1)).alias(name) for name in rules]
    marked = df.withColumn(REASON, reason).observe(seen, *counted)
    marked.write.mode("overwrite").partitionBy(REASON).parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(REASON, T.StringType())])
    read = df.sparkSession.read.schema(schema).parquet(path)
    return Sifted(read.where(F.col(REASON).isNull()).drop(REASON), read.where(F.col(REASON).isNotNull()), {n: seen.get[n] for n in rules})
