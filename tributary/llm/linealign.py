"""Repeated passages: documents that share lines are aligned, and the later one loses the common blocks."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import whole_row
from tributary.session import kept_table

RUNS = "id long, h long, run long"
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
SPANS = "id long, h long, from_line int, to_line int"


def _rising(places: list[int]) -> list[int]:
    """Indices of a longest rising subsequence."""
    tails: list[int] = []
    tops: list[int] = []
    back = [-1] * len(places)
    for i, p in enumerate(places):
        at = bisect_left(tops, p)
        back[i] = tails[at - 1] if at else -1
        tops[at : at + 1], tails[at : at + 1] = [p], [i]
    found, i = [], tails[-1] if tails else -1
    while i >= 0:
        found.append(i)
        i = back[i]
    return found[::-1]


def runs(lines: np.ndarray, lengths: np.ndarray, ends: np.ndarray, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line, last line and hash of the shortest runs of ``least_chars``: from every line on, and up to every line.

    ``lines`` and ``lengths`` are those of several documents after each other, which end at ``ends``; no run
    crosses an end. Runs begin and end with a line that is not blank. Any longer passage is covered by its runs
    of this kind, so two documents share a passage when they share runs, and then share all that cover it.
    """
    n = len(lines)
    starts = np.concatenate(([0], ends[:-1]))
    of = np.repeat(np.arange(len(ends)), ends - starts)
    chars = np.concatenate(([0], np.cumsum(lengths)))
    at = np.flatnonzero(lengths > 0)
    last = np.searchsorted(chars, chars[at] + least_chars) - 1  # the first line with which the sum is reached
    down = last < ends[of[at]]
    first = np.searchsorted(chars, chars[at + 1] - least_chars, side="right") - 1  # the last line from which on it is
    up = first >= starts[of[at]]
    first, last = np.concatenate((at[down], first[up])), np.concatenate((last[down], at[up]))
    both = np.unique(first * (n + 1) + last)
    first, last = both // (n + 1), both % (n + 1)
    powers = np.full(n + 1, BASE)
    powers[:1] = 1
    inverse = np.full(n + 1, pow(int(BASE), -1, 1 << 64), dtype=np.uint64)
    inverse[:1] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(lines.view(np.uint64) * np.multiply.accumulate(powers)[:n])))
    return first, last, (sums[last + 1] - sums[first]) * np.multiply.accumulate(inverse)[first]


def _run_hashes(least_chars: int):
    """Arrow stage: the distinct runs of every document."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = lambda c: batch.column(c).flatten().to_numpy()
            ends = np.cumsum(batch.column("lines").value_lengths().to_numpy())
            first, _, hashes = runs(flat("lines"), flat("lengths").astype(np.int64), ends, least_chars)
            of = np.searchsorted(ends, first, side="right")
            order = np.lexsort((hashes, of))
            of, hashes = of[order], hashes[order]
            new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])))) if len(of) else order
            of = pa.array(of[new])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(of), batch.column("h").take(of), pa.array(hashes[new].view(np.int64))], names=["id", "h", "run"]
            )

    return stage


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned pairs (place in a, place in b) of equal lines, rising in both.

    Lines at both ends that agree are taken; between them the lines that occur once on either side are
    put into their longest common order, and the gaps between them are aligned in the same way. A gap
    without such lines is left; ``common_blocks`` looks its runs up.
    """
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            pairs.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {x: k for k, x in enumerate(a[i:m], i) if in_a[x] == 1 and in_b.get(x) == 1}
        common = [(place[x], k) for k, x in enumerate(b[j:n], j) if x in place]
        anchors = [common[k] for k in _rising([p for p, _ in common])]
        if not anchors:
            continue
        pairs += anchors
        for (p, q), (r, s) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)]):
            todo.append((p + 1, r, q + 1, s))
    return sorted(pairs)


def _left_over(a: list[int], b: list[int], lengths: list[int], blocks: list[tuple[int, int]], least_chars: int) -> bool:
    """Whether consecutive lines of ``b`` that ``a`` holds have ``least_chars`` and are not all in ``blocks``."""
    held, gone = set(a), np.zeros(len(b), dtype=bool)
    for p, q in blocks:
        gone[p:q] = True
    chars, covered = 0, True
    for x, n, g in zip(b, lengths, gone.tolist()):
        if x not in held:
            chars, covered = 0, True
            continue
        chars += n
        covered &= g or not n
        if chars >= least_chars and not covered:
            return True
    return False


def common_blocks(a: list[int], b: list[int], lengths: list[int], least_chars: int) -> list[tuple[int, int]]:
    """Runs of lines of ``b`` that ``a`` holds as a run too and that have ``least_chars`` in all. Blank lines (0) bridge but do not count.

    First those that patience diff aligns. A passage that ``a`` or ``b`` holds twice, or that stands in another
    order, has no place there; where lines are left over, every run of ``b`` is looked up among those of ``a``.
    """
    blocks, run = [], []
    for pair in [*patience(a, b), (-9, -9)]:
        if run and pair != (run[-1][0] + 1, run[-1][1] + 1):
            if sum(lengths[j] for _, j in run) >= least_chars:
                blocks.append((run[0][1], run[-1][1] + 1))
            run = []
        run.append(pair)
    if not _left_over(a, b, lengths, blocks, least_chars):
        return blocks
    of_line = dict(zip(b, lengths))
    both = np.array([*a, *b], dtype=np.int64)
    # A line that only a has equals none of b, so its length does not matter as long as it is not blank.
    first, last, hashes = runs(both, np.array([*(of_line.get(x, 1) for x in a), *lengths], dtype=np.int64), np.array([len(a), len(both)]), least_chars)
    in_b = first >= len(a)
    found = np.flatnonzero(in_b)[np.isin(hashes[in_b], hashes[~in_b])]
    edges = np.zeros(len(b) + 1, dtype=np.int64)
    np.add.at(edges, first[found] - len(a), 1)
    np.add.at(edges, last[found] - len(a) + 1, -1)
    for p, q in blocks:
        edges[p] += 1
        edges[q] -= 1
    gone = np.concatenate(([0], (np.cumsum(edges)[:-1] > 0).astype(np.int64), [0]))
    turns = np.flatnonzero(np.diff(gone))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def _align(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            ids, hs = batch.column("id").to_pylist(), batch.column("h").to_pylist()
            for i in range(batch.num_rows):
                a, b, lengths = (batch.column(c)[i].values.to_numpy() for c in ("earlier", "lines", "lengths"))
                keep = np.isin(a, b)  # lines only one side has cannot align; breaks between kept ones stay visible
                a = np.where(keep, a, 1)
                found += [(ids[i], hs[i], p, q) for p, q in common_blocks(a.tolist(), b.tolist(), lengths.tolist(), least_chars)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            columns = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "h", "from_line", "to_line"])

    return run


def drop_aligned_blocks(
    df: DataFrame, least_chars: int = 100, text: str = "text", doc_id: str = "doc_id", broadcast_rows: int = 200_000
) -> DataFrame:
    """``df`` with the text freed of blocks that an earlier document has, plus n_lines and n_removed.

    A document is looked at beside every earlier one that is the first holder of one of its runs: the shortest
    consecutive lines of ``least_chars`` characters or more, from each line on and up to each line (``runs``);
    earlier means a smaller id. Short lines count like long ones. So a passage that thousands share makes
    one pair per document and none among them, and no run is too frequent to be followed; and every passage of
    that length is found, whichever earlier documents hold it. The pair's
    lines are aligned by patience diff, what is left is looked up by runs (passages that occur twice on a side or
    in another order), and the runs of lines with ``least_chars`` characters or more
    are deleted from the later document. Lines are compared without blanks at their ends.

    Null text stays null, with no lines. A null id is smaller than any. Rows with the same id and text are
    one document and get the same result; with the same id and other text, the order is that of their hashes.
    Other columns are handed on; one named n_lines or n_removed, in any case, gives way to the result's.
    """
    name, body = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    lines = F.transform(F.split(body, "\n"), lambda x: F.trim(x))
    documents = df.where(body.isNotNull()).select(name.alias("id"), F.xxhash64(body).alias("h"), lines.alias("parts")).select(
        "id", "h",
        F.transform("parts", lambda x: F.when(x == "", F.lit(0)).otherwise(F.xxhash64(x))).alias("lines"),
        F.transform("parts", lambda x: F.length(x)).alias("lengths"),
    )
    documents = kept_table(documents, "lines")
    held = documents.mapInArrow(_run_hashes(least_chars), RUNS).select(F.struct("id", "h").alias("doc"), "run")
    firsts = held.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first != last")
    firsts = firsts.select(F.struct(F.col("run").alias("r")).alias("run_key"), "first")
    pairs = (
        held.join(firsts, F.struct(F.col("run").alias("r")) == F.col("run_key"))
        .where("doc != first").select(F.col("doc").alias("later"), "first").distinct()
    )
    pairs = kept_table(pairs, "line-pairs")
    once = documents.dropDuplicates(["id", "h"])
    keyed = kept_table(once.select(F.struct("id", "h").alias("doc"), "lines", "lengths"), "line-lists")
    own = keyed.select(F.struct(F.col("doc").alias("d")).alias("own_key"), "lines", "lengths")
    other = keyed.select(F.struct(F.col("doc").alias("d")).alias("other_key"), F.col("lines").alias("earlier"))

    def is_key(column: str, key: str):
        return F.struct(F.col(column).alias("d")).eqNullSafe(F.col(key))

    full = pairs.join(other, is_key("first", "other_key")).join(own, is_key("later", "own_key"))
    spans = full.select("later.id", "later.h", "lines", "lengths", "earlier").mapInArrow(_align(least_chars), SPANS)
    spans = kept_table(spans, "spans")
    per_document = spans.groupBy(F.struct("id", "h").alias("_span_key")).agg(
        F.array_distinct(F.flatten(F.collect_list(F.sequence("from_line", F.col("to_line") - 1)))).alias("_gone")
    )
    per_document = kept_table(per_document, "removed-lines")
    if spans.count() <= broadcast_rows:
        per_document = F.broadcast(per_document)
    doc = F.struct(name.alias("id"), F.xxhash64(body).alias("h"))
    joined = df.select(whole_row(df, "_row"), body.alias("_text"), doc.alias("_doc")).join(
        per_document, F.col("_doc").eqNullSafe(F.col("_span_key")), "left"
    )
    body, split = F.col("_text"), F.split("_text", "\n")
    gone = F.map_from_arrays("_gone", "_gone")
    left = F.filter(split, lambda x, i: ~F.map_contains_key(gone, i))
    cleaned = F.when(F.col("_gone").isNull(), body).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in df.columns if c.lower() not in ("n_lines", "n_removed")],
        F.when(body.isNull(), 0).otherwise(F.size(split)).alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias("n_removed"),
    )
