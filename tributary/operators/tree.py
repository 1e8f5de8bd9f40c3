"""Depth and path of the nodes of a tree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.operators.joins import own_exchange
from tributary.session import kept_table


def tree_paths(
    nodes: DataFrame,
    code: str,
    parent: str,
    label: str,
    is_root: Column,
    depth: str = "depth",
    path: str = "path",
    width: int = 5,
) -> DataFrame:
    """Every node reachable from the root, with its depth (root = 1) and path of labels.

    Below the root a label is left-padded with zeros, or cut, to ``width``; a null label makes the paths through it null. Nodes
    that hang on no path from the root are left out, cycles among them.

    Paths are found by doubling: every open node knows an ancestor and the piece of path from there. A round
    looks that ancestor up: if its path is known the node's is too, else the node takes over its ancestor's
    ancestor and joins the pieces. So a round settles all nodes up to twice the depth of the one before. A round in which
    nothing settles leaves only nodes without a root. Each round writes
    what it settled and what stays open to the shared folder; settled nodes are not written again. The rounds carry codes and
    pieces alone. A parent given to a root is ignored. A code on several rows
    gives its children a path for each; if such rows lead round in a circle below the root, the paths would never end, and
    the job ends with an error.

    All paths of a deep tree are the square of its depth, so they are never written or shuffled. A code in some ``spacing``, drawn by its
    hash, is an anchor: the first rounds stop at the nearest anchor above, the next give the anchors alone their whole
    paths, and a node's path is put together from its anchor's and its own piece in the last join, behind which
    nothing is shuffled. What is kept grows as the nodes times the spacing, and as the anchors times the depth; the
    spacing follows the root of the number of nodes. A chain of 5,000 nodes takes 9 rounds of one equi join, and 7 among its anchors.
    """
    columns = nodes.columns
    kind = nodes.select(code).union(nodes.select(parent)).schema[0].dataType  # both as the type they are compared in
    known = kept_table(nodes.withColumns({"_uid": F.monotonically_increasing_id(), "_top": F.coalesce(is_root, F.lit(False))}), "tree-nodes")
    rows = known.count()
    spacing = 1 << max(6, int(math.sqrt(rows) / 3).bit_length() - 1)

    def anchor(c: str) -> Column:
        return F.coalesce(F.col(c).isNotNull() & (F.pmod(F.xxhash64(c), F.lit(spacing)) == 0), F.lit(False))

    padded = F.concat(F.lit("-"), F.lpad(F.col(label), width, "0"))
    state = known.select(
        "_uid", F.col(code).cast(kind).alias("_code"), F.when(~F.col("_top"), F.col(parent).cast(kind)).alias("_up"),
        F.lit(1).alias("_steps"), F.when(F.col("_top"), F.col(label)).otherwise(padded).alias("_piece"), "_top",
    )
    # A done row without ``_up`` has its whole path, one with it hangs on that anchor.
    pieces = _climbed(state.withColumn("_done", F.col("_top") | anchor("_up")).drop("_top"), "tree", rows)
    anchors = kept_table(pieces.where(anchor("_code")).withColumn("_done", F.col("_up").isNull()), "anchors")
    above = _climbed(anchors, "tree-anchors", anchors.count()).select(
        F.col("_code").alias("_a_code"), F.col("_steps").alias("_a_steps"), F.col("_piece").alias("_a_piece"))

    pieces = pieces.select(F.col("_uid").alias("_of"), F.col("_up").alias("_hung"), F.col("_steps").alias(depth), F.col("_piece").alias(path))
    placed = known.join(pieces, own_exchange(["_uid"], ["_of"]))
    hung = placed.where("_hung is not null").join(above, own_exchange(["_hung"], ["_a_code"])).withColumns(
        {depth: F.col(depth) + F.col("_a_steps"), path: F.concat("_a_piece", path)})
    return placed.where("_hung is null").select(*columns, depth, path).union(hung.select(*columns, depth, path))


def _climbed(state: DataFrame, name: str, rows: int) -> DataFrame:
    """The rows of ``state`` that reach a done row by way of ``_up``, with the steps and the piece from there."""
    settled, opened, longest = [state.where("_done")], state.where("not _done"), 1
    while True:
        targets = opened
        for part in settled:
            targets = targets.unionByName(part)
        targets = targets.select(*[F.col(c).alias(f"_t{c}") for c in ("_code", "_done", "_up", "_steps", "_piece")])
        moved = opened.where("_up is not null").join(targets, own_exchange(["_up"], ["_t_code"])).select(
            "_uid", "_code", F.col("_t_done").alias("_done"), F.col("_t_up").alias("_up"),
            (F.col("_steps") + F.col("_t_steps")).alias("_steps"), F.concat("_t_piece", "_piece").alias("_piece"),
        )
        seen = Observation()
        done, left = F.count(F.when(F.col("_done"), 1)).alias("done"), F.count(F.when(~F.col("_done"), 1)).alias("left")
        after = kept_table(moved.observe(seen, done, left), name)
        settled.append(after.where("_done"))
        if not seen.get["done"] or not seen.get["left"]:
            break
        opened, longest = after.where("not _done"), 2 * longest
        if longest > 2 * rows:
            raise ValueError("the tree has a cycle")
    whole = settled[0]
    for part in settled[1:]:
        whole = whole.unionByName(part)
    return whole
