"""Linking facts to entities by a cascade of keys, each pass seeing only what is left."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.joins import own_exchange
from tributary.session import kept_table


@dataclass(frozen=True)
class Pass:
    """``candidates`` maps its column ``key`` to the entity; facts carry that key in ``fact_key``."""

    candidates: DataFrame
    key: str
    fact_key: str


def cascade(
    facts: DataFrame,
    passes: Sequence[Pass],
    entity: str,
    residue_key: str,
    residue: DataFrame | None = None,
    found: DataFrame | None = None,
) -> DataFrame:
    """Linked facts with ``entity`` and the number of the ``link_pass`` that found it.

    Pass by pass, a fact links when its key is known among the candidates; then every fact that
    shares ``residue_key`` with a linked one leaves the residue. Facts without a residue key take
    no part. ``residue``, when given, lists the residue keys to begin with. ``found``, when given, holds links known
    before (``entity`` beside a fact's columns); they are returned too, as pass 0, unless the passes find them again.

    So a residue group is served by the first pass that any of its facts matches, and that can be
    found for all passes at once: the (group, pass, key) triples are narrowed to known
    keys, and the lowest pass per group is taken, a minimum that folds copies in each task. It is read twice, so it
    is written, which releases what led to it. Then one join on (pass, key) links everything,
    in place of a join and an anti join of the whole residue per pass. The facts themselves are
    joined twice, each time as the side that a skewed key lets Spark split. A key that many facts and many
    candidates share makes as many links as their product, so nothing is shuffled behind the last join.
    """
    columns = facts.columns
    facts = facts.where(F.col(residue_key).isNotNull())
    candidates = reduce(
        DataFrame.unionByName,
        [
            step.candidates.select(
                F.lit(number).alias("_pass"), F.col(step.key).alias("_key"), F.col(entity)
            )
            for number, step in enumerate(passes, start=1)
        ],
    ).where(F.col("_key").isNotNull() & F.col(entity).isNotNull()).distinct()

    offers = F.array(*[
        F.struct(F.lit(number).alias("_pass"), F.col(step.fact_key).alias("_key"))
        for number, step in enumerate(passes, start=1)
    ])
    asking = facts
    if residue is not None:
        asking = facts.join(residue.select(F.col(residue_key).alias("_group")), F.col(residue_key) == F.col("_group"), "left_semi")
    wanted = (
        asking.select(F.col(residue_key).alias("_group"), F.explode(offers).alias("_offer"))
        .select("_group", "_offer.*")
        .where("_key is not null")
    )
    if residue is not None:  # behind the shuffle by group copies go without another
        wanted = wanted.distinct()
    first_pass = kept_table(
        wanted.join(candidates.select("_pass", "_key").distinct(), ["_pass", "_key"], "left_semi")
        .groupBy("_group")
        .agg(F.min("_pass").alias("_pass")),
        "first-pass",
    )

    chosen = F.element_at(F.array(*[F.col(step.fact_key) for step in passes]), F.col("_pass"))
    served = facts.join(first_pass, own_exchange([residue_key], ["_group"])).withColumn("_key", chosen)
    linked = served.join(candidates, ["_pass", "_key"]).select(entity, *columns, F.col("_pass").alias("link_pass"))
    if found is None:
        return linked
    placed = found.join(first_pass, own_exchange([residue_key], ["_group"]), "left").withColumn("_key", chosen)
    only_before = placed.join(candidates, ["_pass", "_key", entity], "left_anti")
    return linked.union(only_before.select(entity, *columns, F.lit(0).alias("link_pass")))
