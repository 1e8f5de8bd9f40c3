"""Joins whose meaning goes beyond one join call."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own_exchange(left: Sequence[str], right: Sequence[str]) -> Column:
    """Join condition on equal key tuples, null parts counting as equal.

    For a lookup that was grouped by the very key it is joined on. With plain key equality Spark
    would reuse the grouping's shuffle for the join, and then adaptive execution no longer splits a
    hot key on the fact side. As one tuple the keys get their own shuffle on both sides.
    """
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(left)]) == F.struct(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(right)]
    )


def not_in(df: DataFrame, column: str, others: DataFrame, other_column: str) -> DataFrame:
    """Rows for which SQL ``column NOT IN (select other_column ...)`` is true.

    A null among ``others`` leaves no row, and a null ``column`` passes only an empty list. The
    built-in null-aware anti join always broadcasts the list; here the list is an ordinary
    anti-join side of any size, and the two null rules come from one pair of counts.
    """
    counts = others.agg(F.count(F.lit(1)).alias("n"), F.count(other_column).alias("known"))
    sizes = counts.select(F.struct("n", "known")).scalar()
    keys = others.select(F.col(other_column).alias("_listed")).where("_listed is not null").distinct()
    absent = df.join(keys, own_exchange([column], ["_listed"]), "left_anti")
    return absent.where(
        (sizes["n"] == sizes["known"]) & ((sizes["n"] == 0) | F.col(column).isNotNull())
    )


def splittable_full_join(
    facts: DataFrame,
    other: DataFrame,
    fact_keys: Sequence[str],
    other_keys: Sequence[str],
) -> DataFrame:
    """Full outer join that survives a hot (or null) key among the facts.

    Spark cannot split a skewed partition of a full outer join, but it can split the left side of
    a left outer join. So the fact side is left-joined, and the other rows that nothing matched
    are added by an anti join against the distinct fact keys. Column names of the sides must differ.
    """
    def on(left: Sequence[str], right: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in zip(left, right)])

    matched = facts.join(other, on(fact_keys, other_keys), "left")
    seen = [f"_seen_{i}" for i in range(len(fact_keys))]
    distinct_keys = facts.select(*[F.col(k).alias(s) for k, s in zip(fact_keys, seen)]).distinct()
    unmatched = other.join(distinct_keys, on(other_keys, seen), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def origin_flag(left_probe: Column, right_probe: Column, both: str, left: str, right: str) -> Column:
    """Which sides a joined row came from, judged by two probe columns; null when both are null."""
    return (
        F.when(left_probe.isNotNull() & right_probe.isNotNull(), F.lit(both))
        .when(left_probe.isNotNull(), F.lit(left))
        .when(right_probe.isNotNull(), F.lit(right))
    )


def unique_groups(df: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` value occurs exactly once; rows with a null key are left out.

    One aggregate with partial counts: a value held by a third of all rows reaches the shuffle as
    one row per input task.
    """
    rest = [c for c in df.columns if c != key]
    grouped = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    )
    return grouped.where("_n = 1").select(*df.columns)


def group_value(df: DataFrame, keys: str | Sequence[str], value: Column, name: str) -> DataFrame:
    """``df`` with an aggregate over all rows of the same key (null keys form one group).

    Equal to a window over the whole partition, but as a pre-aggregated lookup: no task has to
    hold all rows of one key, and the join can split a hot key.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    groups = [f"_g{i}" for i in range(len(names))]
    lookup = df.groupBy(*[F.col(k).alias(g) for k, g in zip(names, groups)]).agg(value.alias(name))
    return df.join(lookup, own_exchange(names, groups), "left").select(*df.columns, name)
