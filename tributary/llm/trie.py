"""Prefix trie of conversations; totals of all subtrees by parallel tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tributary.llm.common import discard
from tributary.operators.joins import own_exchange
from tributary.operators.ordinals import number_within
from tributary.session import kept_table

SLICE = 1 << 16  # turns of one conversation that one task reads in a row
IDS_PER_BLOCK = 1024
LIVE, RAKED, CONTRACTED = 0, 1, 2


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, digest, n_bytes): the turns of every conversation, numbered from 1.

    They are ordered by ``turn`` (null first), then role and the text's digest; rows that repeat all of
    these stay and get numbers of their own. Null role or text counts as empty. Rows without a conv_id
    belong to no conversation and are left out; other columns are ignored. A turn is represented by
    the first 16 bytes of the SHA-256 of role and text, so no text is shuffled.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.substring(F.unhex(whole), 1, 16).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("nth"),  # any order will do among equal rows
    )
    return number_within(turns, ["conv_id"], ["turn", "role", "digest", "nth"], "pos").select("conv_id", "pos", "digest", "n_bytes")


def shared_heads(turns: DataFrame, base: Column, head: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first ``head`` turns replaced by those of conversation ``base``.

    ``turns`` is a written table of rows (conv_id, pos, digest, n_bytes); ``base`` and ``head`` (at most ``longest``) are
    computed from ``conv_id``. A base with fewer turns gives all it has, an absent one none. The result is
    the new turns, with ``last`` set on each conversation's last one, and the conversations (conv_id, length), turnless ones included.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"base": base, "head": head})
    bases = sizes.select(F.col("conv_id").alias("other"), F.col("n").alias("n_base"))
    given = F.least("head", F.coalesce("n_base", F.lit(0))).cast("long")
    sizes = sizes.join(bases, own_exchange(["base"], ["other"]), "left").withColumn("given", given)
    sizes = kept_table(
        sizes.select(F.col("conv_id").alias("conv"), "base", "head", "given", (F.col("given") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length")),
        "conversations",
    )
    own = turns.join(sizes, own_exchange(["conv_id"], ["conv"])).where(F.col("pos") > F.col("head"))
    heads = turns.where(F.col("pos") <= longest).join(sizes, own_exchange(["conv_id"], ["base"])).where(F.col("pos") <= F.col("head"))
    rebuilt = own.withColumn("at", F.col("pos") - F.col("head") + F.col("given")).unionByName(heads.withColumn("at", F.col("pos")))
    rebuilt = rebuilt.select(F.col("conv").alias("conv_id"), F.col("at").alias("pos"), "digest", "n_bytes", (F.col("at") == F.col("length")).alias("last"))
    return rebuilt, sizes.select(F.col("conv").alias("conv_id"), "length")


def _paths(turns: DataFrame) -> DataFrame:
    """Turns with the key (p1, p2) of the sequence that ends there and the key (q1, q2) of that without the turn.

    A key is the exclusive or of 128 hashed bits per (position, turn), so it depends on the whole sequence and yet
    can be summed over slices of a conversation: inside every slice first, then the totals of the slices before are added.
    """
    keyed = turns.withColumn("slice", F.floor((F.col("pos") - 1) / SLICE)).withColumns(
        {f"e{i}": F.xxhash64(F.lit(i), "pos", "digest") for i in (1, 2)}
    )
    upto = Window.partitionBy("conv_id", "slice").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = keyed.withColumns({f"i{k}": F.bit_xor(f"e{k}").over(upto) for k in (1, 2)})
    totals = keyed.groupBy(F.col("conv_id").alias("c"), F.col("slice").alias("s")).agg(*[F.bit_xor(f"e{k}").alias(f"t{k}") for k in (1, 2)])
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("c", "s", *[F.bit_xor(f"t{k}").over(before).alias(f"o{k}") for k in (1, 2)]).where("s > 0")
    found = inside.join(offsets, own_exchange(["conv_id", "slice"], ["c", "s"]), "left")
    key = {k: F.col(f"i{k}").bitwiseXOR(F.coalesce(f"o{k}", F.lit(0))) for k in (1, 2)}
    return found.select(
        "conv_id", "pos", "n_bytes", "last", *[key[k].alias(f"p{k}") for k in (1, 2)],
        *[key[k].bitwiseXOR(F.col(f"e{k}")).alias(f"q{k}") for k in (1, 2)],
    )


def _xor(column: str, change: Column) -> Column:
    return F.col(column).bitwiseXOR(F.coalesce(change, F.lit(0)))


def _plus(column: str, change: str) -> Column:
    return F.col(column) + F.coalesce(change, F.lit(0))


def _round(live: DataFrame, turn: int, sums: list[str]) -> DataFrame:
    """One turn of the contraction: leaves are raked into their parents, then every third link of a unary chain is cut out."""
    is_root = F.col("q1").isNull()
    at = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    leaves = live.where((F.col("n_kids") == 0) & ~is_root)
    gone = leaves.groupBy(at("q1", "q2").alias("to")).agg(
        F.count(F.lit(1)).alias("fewer"), F.bit_xor("p1").alias("x1"), F.bit_xor("p2").alias("x2"),
        *[F.sum(F.col(s) + F.col(f"{s}_link")).alias(f"{s}_add") for s in sums],
    )
    inner = live.where((F.col("n_kids") > 0) | is_root).join(gone, at("p1", "p2") == F.col("to"), "left")
    inner = inner.select(
        "p1", "p2", "q1", "q2", (F.col("n_kids") - F.coalesce("fewer", F.lit(0))).alias("n_kids"),
        _xor("k1", F.col("x1")).alias("k1"), _xor("k2", F.col("x2")).alias("k2"),
        *[_plus(s, f"{s}_add").alias(s) for s in sums], *[f"{s}_link" for s in sums],
    )
    rank = lambda a: F.xxhash64(F.lit(turn), f"{a}1", f"{a}2")
    cut = ~is_root & (F.col("n_kids") == 1) & (rank("p") < rank("k")) & (rank("p") < rank("q"))
    inner = inner.withColumn("cut", F.coalesce(cut, F.lit(False)))
    out = inner.where("cut")
    none = F.lit(None).cast("long")
    # The child gets a new parent and a heavier link to it; the parent gets a new child.
    to_child = out.select(
        at("k1", "k2").alias("to"), F.col("p1").alias("v1"), F.col("p2").alias("v2"), F.col("q1").alias("u1"), F.col("q2").alias("u2"),
        *[F.col(s).alias(f"{s}_v") for s in sums], *[F.col(f"{s}_link").alias(f"{s}_vlink") for s in sums], F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"),
    )
    to_parent = out.select(
        at("q1", "q2").alias("to"), none.alias("v1"), none.alias("v2"), none.alias("u1"), none.alias("u2"),
        *[none.alias(f"{s}_v") for s in sums], *[none.alias(f"{s}_vlink") for s in sums],
        F.col("p1").bitwiseXOR(F.col("k1")).alias("x1"), F.col("p2").bitwiseXOR(F.col("k2")).alias("x2"),
    )
    names = ["v1", "v2", "u1", "u2", *[f"{s}_v" for s in sums], *[f"{s}_vlink" for s in sums]]
    changes = to_child.unionByName(to_parent).groupBy("to").agg(
        *[F.max(n).alias(n) for n in names], F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")
    )
    kept = inner.where("not cut").join(changes, at("p1", "p2") == F.col("to"), "left")
    row = F.struct(
        F.lit(LIVE).alias("kind"), "p1", "p2", F.coalesce("u1", "q1").alias("q1"), F.coalesce("u2", "q2").alias("q2"), "n_kids",
        _xor("k1", F.col("x1")).alias("k1"), _xor("k2", F.col("x2")).alias("k2"), *sums,
        *[(F.col(f"{s}_link") + F.coalesce(f"{s}_v", F.lit(0)) + F.coalesce(f"{s}_vlink", F.lit(0))).alias(f"{s}_link") for s in sums],
    )
    # What is cut out has its child's total and this much more.
    record = F.struct(
        F.lit(CONTRACTED).alias("kind"), F.col("v1").alias("p1"), F.col("v2").alias("p2"), none.alias("q1"), none.alias("q2"), F.lit(1).cast("long").alias("n_kids"),
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), *[(F.col(f"{s}_v") + F.col(f"{s}_link")).alias(s) for s in sums],
        *[F.lit(0).cast("long").alias(f"{s}_link") for s in sums],
    )
    done = leaves.select(F.lit(RAKED).alias("kind"), *[c for c in live.columns if c != "kind"])
    return kept.select(F.inline(F.when(F.col("v1").isNull(), F.array(row)).otherwise(F.array(row, record)))).unionByName(done)


def subtree_totals(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """Rows (p1, p2, sums): for every node of a tree the sums of the columns ``sums`` over its subtree.

    ``nodes`` holds (p1, p2), the parent's (q1, q2), null at the root, and per node ``n_kids`` and the exclusive or (k1, k2)
    of its children's keys, so the only child of a node is known without a lookup. Every round first rakes: leaves
    leave the tree, and their totals go to their parents by one aggregate, so a parent of any number of children is no hot key.
    Then it compresses: of the nodes with one child those go that come before parent and child in a random order of the round; the
    link from the child to its new parent carries their weight. A chain loses a third of its nodes a round,
    so the rounds grow with the logarithm of the tree, and the tables shrink geometrically. Contracted nodes are
    re-expanded afterwards: each points to the child it was cut above, pointers are doubled until
    they reach raked nodes, and the weights on the way are added. Every round is one table in the shared folder.
    """
    live = nodes.select(F.lit(LIVE).alias("kind"), "p1", "p2", "q1", "q2", "n_kids", "k1", "k2", *sums, *[F.lit(0).cast("long").alias(f"{s}_link") for s in sums])
    tables = []
    for turn in count():
        seen = Observation()
        left = F.count(F.when((F.col("kind") == LIVE) & F.col("q1").isNotNull(), 1)).alias("left")
        cut = F.count(F.when(F.col("kind") == CONTRACTED, 1)).alias("cut")
        tables.append((kept_table(_round(live, turn, sums).observe(seen, left, cut), "contraction"), seen.get["cut"]))
        if not seen.get["left"]:
            break
        live = tables[-1][0].where(F.col("kind") == LIVE)
    settled = tables[-1][0].where(F.col("kind") == LIVE)
    for t, _ in tables:
        settled = settled.unionByName(t.where(F.col("kind") == RAKED))
    settled = settled.select("p1", "p2", *sums)
    cuts = [t.where(F.col("kind") == CONTRACTED).select("p1", "p2", "k1", "k2", *sums) for t, n in tables if n]
    if not cuts:
        return settled
    pointing = cuts[0]
    for more in cuts[1:]:
        pointing = pointing.unionByName(more)
    while True:
        seen, known = Observation(), pointing
        ahead = known.select(F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("k1").alias("n1"), F.col("k2").alias("n2"), *[F.col(s).alias(f"{s}_add") for s in sums])
        moved = known.join(ahead, own_exchange(["k1", "k2"], ["a1", "a2"]), "left").observe(seen, F.count("a1").alias("moved"))
        pointing = kept_table(
            moved.select("p1", "p2", F.coalesce("n1", "k1").alias("k1"), F.coalesce("n2", "k2").alias("k2"), *[_plus(s, f"{s}_add").alias(s) for s in sums]),
            "expansion",
        )
        if not seen.get["moved"]:
            break
    ends = settled.select(F.col("p1").alias("a1"), F.col("p2").alias("a2"), *[F.col(s).alias(f"{s}_add") for s in sums])
    opened = pointing.join(ends, own_exchange(["k1", "k2"], ["a1", "a2"])).select("p1", "p2", *[_plus(s, f"{s}_add").alias(s) for s in sums])
    return settled.unionByName(opened)


def _pack_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of up to ``IDS_PER_BLOCK`` ids of one node as one row: their decimals joined by commas."""
    for batch in batches:
        p1, p2, ids = (batch.column(i).to_pylist() for i in range(3))
        starts = [i for i in range(len(ids)) if i == 0 or p1[i] != p1[i - 1] or p2[i] != p2[i - 1]]
        rows = [(a, min(a + IDS_PER_BLOCK, z)) for s, z in zip(starts, [*starts[1:], len(ids)]) for a in range(s, z, IDS_PER_BLOCK)]
        at = pa.array([a for a, _ in rows], pa.int64())
        text = pa.array([",".join(map(str, ids[a:z])) for a, z in rows], pa.string())
        yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in range(3)], text], names=["p1", "p2", "first", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the blocks of every node, which come sorted; only the running digest is held."""
    node, digest = None, None
    for batch in batches:
        done = []
        for p1, p2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (p1, p2) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (p1, p2), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _hashed(done)
    if node is not None:
        yield _hashed([(*node, digest.hexdigest())])


def _hashed(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["p1", "p2", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """Rows (p1, p2, ends_sha256) from rows (p1, p2, conv_id): the hash of each node's ids, ascending, joined by commas.

    The ids are sorted and joined into blocks in ranges of (node, id), so a node's ids fill as many
    tasks as they need. SHA-256 itself goes from block to block; a node with a third of all ids then is one task that
    streams a row per thousand ids.
    """
    dealt = ends.repartitionByRange("p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")
    blocks = dealt.mapInArrow(_pack_ids, "p1 long, p2 long, first long, ids string")
    return blocks.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(_hash_ids, "p1 long, p2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, with the totals of its subtree.

    ``turns`` holds (conv_id, pos, digest, n_bytes, last), ``conversations`` (conv_id, length); both are those of ``shared_heads``.
    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes of last texts that members share, over the subtree) and ``ends_sha256`` (the members that end here).
    Turnless conversations are members of the root only. Without any conversation there is no node.
    """
    paths = kept_table(_paths(turns), "paths")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = root.select(zero.alias("p1"), zero.alias("p2"), none.alias("q1"), none.alias("q2"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("n_bytes"))
    nodes = paths.groupBy("p1", "p2").agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("pos").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
    )
    nodes = kept_table(nodes.unionByName(root), "nodes")
    parents = nodes.where(F.col("q1").isNotNull()).groupBy(F.col("q1").alias("a1"), F.col("q2").alias("a2"))
    kids = parents.agg(F.count(F.lit(1)).alias("kids"), F.bit_xor("p1").alias("x1"), F.bit_xor("p2").alias("x2"))
    known = nodes.join(kids, own_exchange(["p1", "p2"], ["a1", "a2"]), "left").select(
        *nodes.columns, F.coalesce("kids", F.lit(0)).alias("n_kids"), F.coalesce("x1", F.lit(0)).alias("k1"), F.coalesce("x2", F.lit(0)).alias("k2"),
        F.col("kids").isNull().cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    known = kept_table(known, "trie")
    discard(nodes)
    totals = subtree_totals(known, ["n_leaves", "saved_tokens"]).select(F.struct("p1", "p2").alias("at"), "n_leaves", "saved_tokens")
    ends = paths.where("last").select("p1", "p2", "conv_id").unionByName(conversations.where("length = 0").select(zero.alias("p1"), zero.alias("p2"), "conv_id"))
    digests = ends_digest(ends).select(F.struct("p1", "p2").alias("end"), "ends_sha256")
    above = known.select(F.struct("p1", "p2").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    plain = known.drop("n_leaves", "saved_tokens").withColumns({"here": F.struct("p1", "p2"), "from": F.struct(F.col("q1").alias("p1"), F.col("q2").alias("p2"))})
    whole = plain.join(totals, F.col("here") == F.col("at")).join(digests, F.col("here") == F.col("end"), "left").join(above, F.col("from") == F.col("up"), "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_kids").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
