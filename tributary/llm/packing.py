"""Best-fit packing of documents into token sequences by the sum of squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.bpe import encoder
from tributary.llm.common import literal_table
from tributary.llm.wordhash import text_chunks
from tributary.session import kept_table

LEVEL_BITS = 10  # of a sequence id: the level that placed it
PIECE_BITS = 21  # of a sequence id that follows places: the piece of the document
SETTLED = 0.1  # least share of its pieces that a level places for good
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place long"


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset for each size, placed in the given order.

    With N(g) open bins of residual gap g, an item goes where the sum of N(g)^2 over the gaps of open
    bins grows least: taking a bin of gap g lowers N(g) and raises N(g - size); a full bin is closed
    and counts no more; a new bin only raises N(capacity - size). Ties go to the smallest gap, so a
    new bin is the last choice.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)  # by gap; a full or unopened bin counts as none
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(sizes), dtype=np.int64)
    offsets = np.empty(len(sizes), dtype=np.int64)
    opened = 0
    for i, size in enumerate(sizes.tolist()):
        after = counts[: capacity - size + 1]  # bins whose gap would be 0 .. capacity - size
        before = counts[size:]
        growth = np.where(before > 0, 2 * (after - before) + 2, np.iinfo(np.int64).max)
        growth[0] = 1 - 2 * before[0] if before[0] > 0 else np.iinfo(np.int64).max
        growth[-1] = 2 * after[-1] + 1 if size < capacity else 0
        rest = int(growth.argmin())
        gap = rest + size
        if gap == capacity:
            number, opened = opened, opened + 1
        else:
            number = open_bins[gap].pop()
            counts[gap] -= 1
        if rest:
            open_bins[rest].append(number)
            counts[rest] += 1
        bins[i], offsets[i] = number, capacity - gap
    return bins, offsets


def token_pieces(
    df: DataFrame, tokenizer: str, capacity: int, end_id: int, text: str = "text", doc_id: str = "doc_id", place: Column | None = None
) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut into pieces of ``capacity`` if longer.

    The first piece of a cut document takes what is left over, the others are full. Null text counts
    as empty and is one piece that holds the end id. ``place`` is handed on with each piece.
    """
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch, texts in text_chunks(batches, "text"):
            out: list[tuple] = []
            for key, at, ids in zip(batch.column("doc_id").to_pylist(), batch.column("place").to_pylist(), encode([t.decode() for t in texts])):
                ids += end
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                starts = [0, *range(first, total, capacity)]
                for n, (a, b) in enumerate(zip(starts, [*starts[1:], total])):
                    out.append((key, n, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "place"],
            )

    placed = F.lit(None).cast("long") if place is None else place.cast("long")
    pieces = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), placed.alias("place")).mapInArrow(cut, PIECES)
    return pieces.drop("place") if place is None else pieces


def _placer(capacity: int, level: int, width: int, ordered: bool):
    """Grouped stage: one group's pieces placed, with the tokens their sequence holds. If ``ordered``, a sequence has the
    number of its first piece, and its pieces follow each other by their numbers."""

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "_row"], ascending=[False, True])
        sizes = group["length"].to_numpy()
        bins, offsets = sum_of_squares(sizes, capacity)
        filled = np.bincount(bins, weights=sizes).astype(np.int64)
        if ordered:
            numbers = group["_number"].to_numpy()
            order = np.lexsort((numbers, bins))
            new = np.concatenate(([True], bins[order][1:] != bins[order][:-1]))
            before, which = np.cumsum(sizes[order]) - sizes[order], np.cumsum(new) - 1
            sequence = np.empty_like(bins)
            sequence[order], offsets[order] = numbers[order][new][which], before - before[new][which]
        else:
            sequence = ((bins << width | int(key[0])) << LEVEL_BITS) + level
        return pd.DataFrame({"_row": group["_row"], "length": sizes, "_number": group["_number"], "sequence_id": sequence, "offset": offsets, "filled": filled[bins]})

    return place


def _bar(pieces_by_fill: dict[int, int], well_filled: float) -> float:
    """``well_filled``, or the lower fill from which on ``SETTLED`` of the pieces are in sequences as full as that."""
    settled, least = 0, SETTLED * sum(pieces_by_fill.values())
    for filled, n in sorted(pieces_by_fill.items(), reverse=True):
        settled += n
        if settled >= least:
            return min(well_filled, filled)
    return 0


def _ranges(rest: DataFrame, count: int, groups: int, ends_at: int) -> DataFrame:
    """``rest`` with ``g``: groups of about as many rows, each a range of ``_number``; a document's pieces stay together."""
    width = -(-ends_at // (16 * groups))
    bucketed = rest.withColumn("_bucket", F.floor(F.shiftright("_number", PIECE_BITS) / F.lit(width)))
    rows, before = [], 0
    for bucket, n in sorted(map(tuple, bucketed.groupBy("_bucket").count().collect())):
        rows.append({"b": bucket, "g": (before + n // 2) * groups // count})
        before += n
    of_bucket = literal_table(rest.sparkSession, rows, "b long, g long")
    return bucketed.join(F.broadcast(of_bucket), F.col("_bucket") == F.col("b")).drop("_bucket", "b")


def pack(pieces: DataFrame, capacity: int, rows_per_group: int = 50_000, well_filled: float = 0.98, ordered: bool = False) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``: each sequence is gapless from 0.

    Pieces are dealt by hash into groups of about ``rows_per_group``, one task each, however large the
    input. A group's pieces are placed from long to short. Its last few sequences stay badly filled;
    their pieces are dealt again into fewer groups and placed anew, until one group holds all of the
    rest. Pieces that do not fit each other, such as many of one length over half of ``capacity``, stay
    badly filled wherever they are dealt; a level of which little is well filled keeps its fullest
    sequences, with ``SETTLED`` of its pieces at least, so the levels grow with the logarithm of the rows. Equal rows are told apart by a number of their own.

    If ``ordered``, pieces have ``place``, a number from 0 that each document has to itself. Then groups are ranges
    of places, a sequence's id rises with the place of its first piece, and its pieces follow each other by place.
    """
    numbered = kept_table(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    columns = [c for c in numbered.columns if c != "_row"]
    number = F.shiftleft("place", PIECE_BITS) + F.col("piece") if ordered else F.lit(0).cast("long")
    schema = "_row long, length long, _number long, sequence_id long, offset long, filled long"
    level, rest, done = 0, numbered.select("_row", F.col("length").cast("long").alias("length"), number.alias("_number")), []
    ends_at = (numbered.agg(F.max("place")).first()[0] or 0) + 1 if ordered else 0
    while (count := rest.count()) > 0:
        groups = -(-count // rows_per_group)
        width = max(1, (groups - 1).bit_length())
        if ordered and groups > 1:
            dealt = _ranges(rest, count, groups, ends_at)
        else:
            dealt = rest.withColumn("g", F.pmod(F.xxhash64("_row", F.lit(level)), F.lit(groups)))
        placed = kept_table(dealt.groupBy("g").applyInPandas(_placer(capacity, level, width, ordered), schema), f"level-{level}")
        bar = 0
        if groups > 1:
            bar = _bar({r[0]: r[1] for r in placed.groupBy("filled").count().collect()}, well_filled * capacity)
        done.append(placed.where(F.col("filled") >= bar).select(F.col("_row").alias("_placed"), "sequence_id", "offset"))
        rest = placed.where(F.col("filled") < bar).select("_row", "length", "_number")
        level += 1
    if not done:
        return numbered.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    all_placed = done[0]
    for more in done[1:]:
        all_placed = all_placed.union(more)
    return numbered.join(all_placed, F.col("_row") == F.col("_placed")).select(*columns, "sequence_id", "offset")


def best_fit_pack(
    df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, text: str = "text", doc_id: str = "doc_id", rows_per_group: int = 50_000,
    place: Column | None = None,
) -> DataFrame:
    """Every document of ``df`` packed into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty
    texts are one piece with the end id alone; repeated rows and null ids are packed like any other;
    other columns are ignored, whatever their names; an empty table gives no rows. With ``place``, a number from 0
    that each row has to itself, sequences follow it.
    """
    pieces = token_pieces(df, tokenizer, capacity, end_id, text, doc_id, place)
    return pack(pieces, capacity, rows_per_group, ordered=place is not None).drop("place")
