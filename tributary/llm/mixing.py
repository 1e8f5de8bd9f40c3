"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

from collections.abc import Mapping
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import literal_table, whole_row
from tributary.session import kept_table

OTHER = "(other)"
MIX_COLUMNS = ("mix_source", "mix_block", "mix_slot", "mix_place")


def pfair_period(weights: Mapping[str, int]) -> dict[str, list[int]]:
    """One period of the schedule: for each source the slots of its blocks, of ``sum(weights)`` slots.

    With share w = weight / total, block j (from 0) is released at floor(j / w) and due at
    ceil((j + 1) / w). Each slot goes to the released block of earliest deadline, ties to the name.
    On one lane with shares that sum to one this meets every deadline and leaves no slot idle, so after
    t slots each source has had more than w t - 1 and less than w t + 1 blocks.
    """
    total = sum(weights.values())
    slots: dict[str, list[int]] = {s: [] for s in weights}
    released: list[tuple[int, str]] = []
    waiting = [(0, s) for s in sorted(weights)]
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            s = heappop(waiting)[1]
            heappush(released, (-(-(len(slots[s]) + 1) * total // weights[s]), s))
        s = heappop(released)[1]
        slots[s].append(t)
        if len(slots[s]) < weights[s]:
            heappush(waiting, (len(slots[s]) * total // weights[s], s))
    return slots


def phases(weights: Mapping[str, int], blocks: Mapping[str, int]) -> list[dict]:
    """The schedule of all blocks, as periods: rows (source, first_block, first_slot, period, slots).

    All sources run until one has no block left; the rest go on with their weights among themselves,
    as a new schedule that starts there. So there are as many phases as sources at most, whatever
    the number of blocks, and each phase keeps the one-block bound for its own shares.
    """
    left = {s: blocks[s] for s in weights if blocks.get(s)}
    done = dict.fromkeys(left, 0)
    start, rows = 0, []
    while left:
        shares = {s: weights[s] for s in left}
        period = sum(shares.values())
        slots = pfair_period(shares)
        ends = {s: (n - 1) // shares[s] * period + slots[s][(n - 1) % shares[s]] for s, n in left.items()}
        length = min(ends.values()) + 1
        for s in left:
            rows.append({"s": s, "first_block": done[s], "first_slot": start, "period": period, "slots": slots[s]})
            whole, part = divmod(length, period)
            given = whole * shares[s] + sum(x < part for x in slots[s])
            done[s] += given
            left[s] -= given
        left = {s: n for s, n in left.items() if n}
        start += length
    return rows


def _others(df: DataFrame) -> list[str]:
    """The columns of ``df`` whose names are not those of the mix."""
    return [c for c in df.columns if c.lower() not in MIX_COLUMNS]


def mix_sources(
    df: DataFrame, weights: Mapping[str, int], other_weight: int, block_rows: int = 64,
    source: str = "source", doc_id: str = "doc_id", slice_rows: int = 20_000,
) -> DataFrame:
    """``df`` with mix_source, mix_block, mix_slot and mix_place: reading by (slot, place) gives the mix.

    Each source's documents, in the order of md5(id) and id (null ids first), are cut into blocks of
    ``block_rows``; the last may be shorter. ``mix_slot`` is the block's turn among all blocks, so
    that after any number of turns every source has had its weight's share of them to within one block, until
    it has no more; then the others share the turns by their weights. No row is dropped or repeated.

    Sources without a weight, and null, form one source ``(other)`` of weight ``other_weight``. The
    schedule has as many entries as there are weights times their sum, whatever the data, and is the
    only thing broadcast. A hot source is spread over slices of the md5 order, as many as its rows
    need, and numbered by slice, so no task holds more than a slice. Rows that repeat an id and text
    take places next to each other. An empty table gives no rows. Other columns are handed on; one that has the
    name of a result column, in any case, gives way to it.
    """
    if any(w <= 0 for w in [*weights.values(), other_weight]):
        raise ValueError("weights must be positive whole numbers")
    wanted = {**weights, OTHER: other_weight}
    named = F.when(F.col(f"`{source}`").isin(*weights), F.col(f"`{source}`")).otherwise(F.lit(OTHER))
    name = F.col(f"`{doc_id}`")
    md5 = F.md5(F.coalesce(name.cast("string"), F.lit("")).cast("binary"))
    keyed = df.select(whole_row(df, "_row"), named.alias("mix_source"), name.alias("_doc_id"), md5.alias("_md5"))
    totals = {r["mix_source"]: r["n"] for r in keyed.groupBy("mix_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = max(1, -(-max(totals.values(), default=0) // slice_rows))
    place = F.conv(F.substring("_md5", 1, 12), 16, 10).cast("long")
    sliced = keyed.withColumn("_slice", F.floor(place * F.lit(slices) / F.lit(1 << 48)).cast("int"))
    counts = sliced.groupBy("mix_source", "_slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("mix_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept_table(
        counts.select(
            F.struct(F.col("mix_source").alias("s"), F.col("_slice").alias("p")).alias("_key"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("_before"),
        ),
        "slice-starts",
    )
    inside = Window.partitionBy("mix_source", "_slice").orderBy("_md5", F.col("_doc_id").asc_nulls_first())
    numbered = sliced.withColumn("_local", F.row_number().over(inside)).join(
        starts, F.struct(F.col("mix_source").alias("s"), F.col("_slice").alias("p")) == F.col("_key")
    )
    number = F.col("_before") + F.col("_local") - 1
    placed = numbered.withColumn("mix_block", F.floor(number / block_rows)).withColumn("mix_place", F.pmod(number, F.lit(block_rows)))
    rows = phases(wanted, {s: -(-n // block_rows) for s, n in totals.items()})
    schedule = literal_table(
        df.sparkSession, rows, "s string, first_block bigint, first_slot bigint, period bigint, slots array<bigint>"
    )
    by_source = schedule.groupBy("s").agg(
        F.sort_array(F.collect_list(F.struct("first_block", "first_slot", "period", "slots")), asc=False).alias("_phases")
    )
    joined = placed.join(F.broadcast(by_source), F.col("mix_source") == F.col("s"))
    phase = F.filter("_phases", lambda p: p["first_block"] <= F.col("mix_block"))[0]
    local = F.col("mix_block") - F.col("_phase.first_block")
    width = F.size("_phase.slots").cast("long")
    slot = F.col("_phase.first_slot") + F.floor(local / width) * F.col("_phase.period") + F.get("_phase.slots", F.pmod(local, width).cast("int"))
    return joined.withColumn("_phase", phase).withColumn("mix_slot", slot).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in _others(df)], "mix_source", F.col("mix_block").cast("long").alias("mix_block"),
        F.col("mix_slot").cast("long").alias("mix_slot"), F.col("mix_place").cast("long").alias("mix_place"),
    )


def mixed_order(df: DataFrame, weights: Mapping[str, int], other_weight: int, block_rows: int = 64, **names: str) -> DataFrame:
    """The rows of ``df`` plus mix_slot and mix_place, laid out in the order of the mix: across partitions by range, sorted within.

    The two columns keep the order, since files that a table is read from again have none among them.
    """
    mixed = kept_table(mix_sources(df, weights, other_weight, block_rows, **names), "mixed")
    ordered = mixed.repartitionByRange("mix_slot", "mix_place").sortWithinPartitions("mix_slot", "mix_place")
    return ordered.select(*[F.col(f"`{c}`") for c in _others(df)], "mix_slot", "mix_place")
