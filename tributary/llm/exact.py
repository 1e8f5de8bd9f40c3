"""Exact duplicates by two-pass Bloom filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ascii_lower, whole_row
from tributary.session import kept_table

CELLS = 256  # per block: four words of 64 bits
PROBES = 3
HASHES_PER_BLOCK = 16
# A filter of this many blocks takes some 100 MB once broadcast; beyond, it is joined by shuffle.
BROADCAST_BLOCKS = 1 << 19


def _cells(h: str) -> list[Column]:
    """The cells of a hash in its block: other bits than those that choose the block."""
    return [F.shiftrightunsigned(F.col(h), 8 * i).bitwiseAND(F.lit(CELLS - 1)).cast("int") for i in range(PROBES)]


def repeat_filter(hashes: DataFrame, h: str, blocks: int) -> DataFrame:
    """First pass: a blocked Bloom filter of the hashes seen at least twice, rows (block, w0..w3).

    A hash takes ``PROBES`` cells of one block. A cell counts up to two, and only the cells that two or
    more insertions reached are set in the result. Every repeated hash has all its cells set; of the
    hashes that occur once, about one in two hundred has as well. Counting is an aggregate with
    partial counts, so a hash held by a third of all rows reaches the shuffle once per task and cell.
    """
    block = F.pmod(F.shiftright(h, 24), F.lit(blocks)).alias("block")
    hit = hashes.select(block, F.explode(F.array(*_cells(h))).alias("cell"), F.col(h))
    twice = hit.groupBy("block", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell").bitwiseAND(F.lit(63)))
    words = [F.bit_or(F.when(F.shiftright("cell", 6) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{i}") for i in range(CELLS // 64)]
    return twice.groupBy("block").agg(*words)


def may_repeat(rows: DataFrame, h: str, blocks: int, repeats: DataFrame) -> DataFrame:
    """Second pass: ``rows`` with ``_suspect``, true for all repeated hashes and few others.

    Only the filter travels: it is broadcast when its number of blocks has a checked bound, so rows
    stay where they are. A larger filter meets the rows' hashes (not their texts) in a shuffled join.
    """
    filtered = repeats.select(F.col("block").alias("_filter_block"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(CELLS // 64)])
    if blocks <= BROADCAST_BLOCKS:
        filtered = F.broadcast(filtered)
    joined = rows.withColumn("_block", F.pmod(F.shiftright(h, 24), F.lit(blocks))).join(
        filtered, F.col("_block") == F.col("_filter_block"), "left"
    )
    found = F.lit(True)
    for cell in _cells(h):
        word = F.coalesce(*[F.when(F.shiftright(cell, 6) == i, F.col(f"_w{i}")) for i in range(CELLS // 64)])
        found = found & F.coalesce(
            F.call_function("shiftrightunsigned", word, cell.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1, F.lit(False)
        )
    return joined.withColumn("_suspect", found)


def _normalised(text: str) -> Column:
    return F.coalesce(ascii_lower(F.col(f"`{text}`")), F.lit(""))


def _digests(df: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, int, DataFrame]:
    """First pass: id, digest and hash of every row (a kept table), the filter's blocks, the filter."""
    sha = F.unhex(F.sha2(_normalised(text), 256)).alias("sha")
    rows = kept_table(df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), sha), "digests").withColumn("h", F.xxhash64("sha"))
    blocks = max(1, -(-rows.count() // HASHES_PER_BLOCK))
    return rows, blocks, kept_table(repeat_filter(rows, "h", blocks), "repeat-filter")


def _groups(suspects: DataFrame) -> DataFrame:
    """Groups of two rows or more among the suspects: key, keep_id, group_size."""
    groups = suspects.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return groups.where("group_size > 1").select(F.struct(F.col("sha").alias("s")).alias("key"), "keep_id", "group_size")


def mark_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after lower-casing A-Z (null counts as empty), and the row
    with the largest id stays. Only rows whose hash may repeat are shuffled, as (id, digest); groups
    are counted by partial aggregates and looked up by a join that can split a hot group. All other
    rows pass straight through. A null id is smaller than any other; rows that share text and id are
    the same document twice and carry the same marks. Other columns are ignored. An empty table
    gives no rows.
    """
    rows, blocks, repeats = _digests(df, text, doc_id)
    marked = may_repeat(rows, "h", blocks, repeats)
    suspects = marked.where("_suspect").select("doc_id", "sha")
    grouped = suspects.join(_groups(suspects), F.struct(F.col("sha").alias("s")) == F.col("key"), "left").select(
        "doc_id", F.when(F.col("key").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "sha",
    )
    alone = marked.where("not _suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    return alone.union(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that ``mark_copies`` keeps, whole, one per group of equal texts.

    Rows that the filter clears pass through with their texts where they are; only suspects are shuffled.
    Suspects with the same text and id, null included, are told apart by nothing: one of them stays.
    Other columns are handed on, whatever their names.
    """
    rows, blocks, repeats = _digests(df, text, doc_id)
    suspects = may_repeat(rows, "h", blocks, repeats).where("_suspect").select("doc_id", "sha")
    kept = suspects.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    # The row that stays is named by text and id; how often that pair occurs tells a repeated row.
    pair = F.struct(F.col("sha").alias("s"), F.col("doc_id").alias("i"))
    times = suspects.groupBy(pair.alias("times_key")).agg(F.count(F.lit(1)).alias("times"))
    stays = kept.withColumn("pair", F.struct(F.col("sha").alias("s"), F.col("keep_id").alias("i"))).join(
        times, F.col("pair").eqNullSafe(F.col("times_key"))
    )
    stays = kept_table(stays.select(F.struct(F.col("sha").alias("s")).alias("_stay_key"), F.col("keep_id").alias("_keep"), F.col("times").alias("_times")), "stays")

    columns = [F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    sha, own_id = F.unhex(F.sha2(_normalised(text), 256)), F.col(f"`{doc_id}`").cast("long")
    hashed = df.select(whole_row(df, "_row"), sha.alias("_sha"), own_id.alias("_id")).withColumn("_h", F.xxhash64("_sha"))
    marked = may_repeat(hashed, "_h", blocks, repeats)
    clear = marked.where("not _suspect").select(*columns)
    looked_up = marked.where("_suspect").join(stays, F.struct(F.col("_sha").alias("s")) == F.col("_stay_key"), "left")
    staying = looked_up.where(F.col("_stay_key").isNull() | F.col("_id").eqNullSafe(F.col("_keep")))
    once = staying.where("_times is null or _times = 1").select(*columns)
    again = staying.where("_times > 1").dropDuplicates(["_sha"]).select(*columns)
    return clear.union(once).union(again)
