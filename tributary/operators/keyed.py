"""Keyed writes and keep-one selections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.joins import own_exchange
from tributary.operators.refusals import Sifted, sift

NULL_KEY = "null in the key"


def all_not_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def keep_one(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key under ``order``.

    The ``row_number = 1`` filter lets Spark put a group limit before the shuffle, so a hot key
    sends one row per input task, not all of its rows.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def drop_copies(df: DataFrame, columns: Sequence[str], first_by: str) -> DataFrame:
    """One row per group of equal ``columns`` (nulls are equal), the earliest by ``first_by``.

    An aggregate rather than a window: copies collapse in every input task before the shuffle.
    """
    others = [c for c in df.columns if c not in columns]
    if others == [first_by]:
        return df.groupBy(*columns).agg(F.min(first_by).alias(first_by)).select(*df.columns)
    tie_break = [c for c in others if c != first_by]
    kept = F.min(F.struct(F.col(first_by).isNull().alias("_late"), first_by, *tie_break)).alias("_kept")
    grouped = df.groupBy(*columns).agg(kept)
    return grouped.select(*columns, *[F.col(f"_kept.{c}").alias(c) for c in others]).select(*df.columns)


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: str | None = None,
) -> DataFrame:
    """``current`` with the rows of ``batch`` replacing those of equal key.

    Within the batch the last row by ``order_by`` wins. Rows without a full key are refused (the
    landing tables have a primary key). Columns the batch does not bring keep their old value;
    columns it adds are null for rows it does not touch.

    The big table is only probed with an anti join on the batch keys: it is not sorted, and when
    the batch is small enough for Spark to broadcast, it is not shuffled either.
    """
    incoming = batch.where(all_not_null(keys))
    if order_by:
        rest = [F.col(c).desc_nulls_last() for c in batch.columns if c not in keys and c != order_by]
        incoming = keep_one(incoming, keys, F.col(order_by).desc_nulls_last(), *rest)
    untouched = current.join(incoming.select(*keys), list(keys), "left_anti").select(*current.columns)
    carried = [c for c in current.columns if c not in batch.columns]
    if carried:
        old = current.select(*keys, *carried).join(incoming.select(*keys), list(keys), "left_semi")
        incoming = incoming.join(old, list(keys), "left")
    return untouched.unionByName(incoming, allowMissingColumns=True)


def upsert_sifted(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: str | None = None
) -> tuple[DataFrame, Sifted]:
    """``upsert``, and the batch divided into the rows it takes and those it refuses for a null in the key.

    The batch is computed once: the accepted rows are read from the table that the division wrote.
    """
    sifted = sift(batch, {NULL_KEY: ~all_not_null(keys)})
    return upsert(current, sifted.accepted, keys, order_by), sifted


def replace_groups(current: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` with all rows of each key in ``batch`` replaced by the batch's rows of that key.

    For responses that bring everything known about a key at once, as several rows.
    """
    incoming = batch.where(all_not_null(keys))
    renamed = [f"_t{i}" for i in range(len(keys))]
    touched = incoming.select(*[F.col(k).alias(t) for k, t in zip(keys, renamed)]).distinct()
    untouched = current.join(touched, own_exchange(keys, renamed), "left_anti")
    return untouched.unionByName(incoming, allowMissingColumns=True)


def merge_rows(current: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge with SQL equality: a key with a null part never matches, so its rows append again."""
    rest = [F.col(c).asc_nulls_last() for c in batch.columns if c not in keys]
    complete = keep_one(batch.where(all_not_null(keys)), keys, *(rest or [F.lit(1)]))
    partial = batch.where(~all_not_null(keys))
    untouched = current.join(complete.select(*keys), list(keys), "left_anti").select(*current.columns)
    return untouched.unionByName(complete, allowMissingColumns=True).unionByName(
        partial, allowMissingColumns=True
    )


def add_missing_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with each absent column added as null text."""
    absent = [c for c in columns if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in absent])


def append_evolving(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Append that widens either side with null for the columns only the other has."""
    return current.unionByName(batch, allowMissingColumns=True)
