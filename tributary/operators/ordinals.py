"""Occurrence numbers and positional matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.joins import own_exchange
from tributary.session import kept_table


def _with_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows of the same key that come earlier in ``order`` (nulls first).

    Rows are dealt into ranges of (keys, order), so a key of any size fills as many ranges as its rows
    need, and all its rows in one range come before those in the next. Sums are taken inside
    (key, range), and the totals of the key's ranges before are added. The dealt rows are written once,
    so both parts see the same ranges, also after a lost executor.
    """
    by_order = [F.col(c).asc_nulls_first() for c in order]
    dealt = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *by_order)
    dealt = kept_table(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*keys, "_range").orderBy(*by_order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_inside", F.coalesce(F.sum(weight).over(earlier), F.lit(0)))

    groups = [f"_k{i}" for i in range(len(keys))]
    totals = dealt.groupBy(*[F.col(k).alias(g) for k, g in zip(keys, groups)], F.col("_range").alias("_r")).agg(F.sum(weight).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(g)) for k, g in zip(keys, groups)], F.col("_range") == F.col("_r"))
    return inside.join(offsets, same, "left").select(*df.columns, (F.col("_before") + F.col("_inside")).cast("long").alias(name))


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """``row_number`` per key under a total ascending ``order`` (nulls first); a hot key is spread over many tasks."""
    numbered = _with_before(df, keys, order, F.lit(1), "_earlier")
    return numbered.select(*df.columns, (F.col("_earlier") + 1).alias(name))


def rank_within(df: DataFrame, keys: Sequence[str], column: str, name: str = "rank") -> DataFrame:
    """SQL ``rank`` per key by one ascending column (nulls first): one more than the rows of smaller values.

    Ties are counted per distinct value before anything is ordered, so any number of them is one row.
    """
    counted = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = _with_before(counted, keys, [column], F.col("_ties"), "_smaller")
    names, groups = [*keys, column], [f"_g{i}" for i in range(len(keys) + 1)]
    lookup = ranked.select(*[F.col(n).alias(g) for n, g in zip(names, groups)], (F.col("_smaller") + 1).alias(name))
    return df.join(lookup, own_exchange(names, groups), "left").select(*df.columns, name)


def match_nth(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    order_left: Sequence[str],
    order_right: Sequence[str],
) -> DataFrame:
    """Full join of the k-th left row with the k-th right row of the same key.

    The ordinal is part of the join key, so a key with many rows is spread by the shuffle itself
    and no pairs within a group are formed. Column names of the two sides must differ.
    """
    numbered_left = number_within(left, [l for l, _ in on], order_left, "ordinal_left")
    numbered_right = number_within(right, [r for _, r in on], order_right, "ordinal_right")
    condition = reduce(
        lambda a, b: a & b,
        [F.col(l) == F.col(r) for l, r in on],
        F.col("ordinal_left") == F.col("ordinal_right"),
    )
    return numbered_left.join(numbered_right, condition, "full")
