"""Near-duplicate embeddings by hashing to points of the E8 lattice."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import components, discard
from tributary.session import kept_table


def _shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or all +-1/2 with an even number of minus signs."""
    pairs = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(pairs + halves, dtype=np.float64)


NEIGHBOURS = _shortest_vectors()


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest points with integer entries of even sum: round, and where the sum is odd round the
    entry that was furthest from its integer the other way.
    """
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = y[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of the two cosets D8 and D8 + 1/2."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    better = ((y - half) ** 2).sum(axis=1) < ((y - whole) ** 2).sum(axis=1)
    return np.where(better[:, None], half, whole)


class E8Tables:
    """``tables`` hash tables; the cell of a unit vector is one E8 point per block of 8 projections."""

    def __init__(self, dimension: int, tables: int, blocks: int, scale: float, probes: int, seed: int = 0) -> None:
        draw = np.random.default_rng([seed, dimension])
        self.matrix = draw.standard_normal((tables, blocks, dimension, 8)) * (scale / np.sqrt(8))
        self.salt = draw.integers(1, 1 << 62, (tables, blocks, 8), dtype=np.int64) | 1
        self.tables, self.blocks, self.probes = tables, blocks, probes

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home cell per row and table, and per row and table the ``probes`` neighbouring cells that lie nearest.

        A neighbour differs from home by a shortest lattice vector in one block; the smaller the step's
        extra distance, |r - v|^2 = |r|^2 - 2 r.v + 2 for residual r, the nearer it is.
        """
        home = np.empty((len(x), self.tables), dtype=np.int64)
        near = np.empty((len(x), self.tables, self.probes), dtype=np.int64)
        for t in range(self.tables):
            home[:, t], gains, steps = t, [], []
            for b in range(self.blocks):
                y = x @ self.matrix[t, b]
                point = nearest_e8(y)
                home[:, t] += (np.rint(2 * point).astype(np.int64) * self.salt[t, b]).sum(axis=1)
                gains.append((y - point) @ NEIGHBOURS.T)
                steps.append((np.rint(2 * NEIGHBOURS).astype(np.int64) * self.salt[t, b]).sum(axis=1))
            gain, step = np.concatenate(gains, axis=1), np.concatenate(steps)
            best = np.argpartition(-gain, self.probes - 1, axis=1)[:, : self.probes]
            near[:, t] = home[:, t, None] + step[best]
        return home, near


def sketches(x: np.ndarray) -> list[bytes]:
    """Per unit vector its largest component, the length of what rounding takes away, and the components in 8 bits."""
    largest = np.abs(x).max(axis=1, keepdims=True)
    rounded = np.rint(x / largest * 127).astype(np.int8)
    lost = np.sqrt(((x - rounded * (largest / 127)) ** 2).sum(axis=1, keepdims=True))
    return [h.tobytes() + r.tobytes() for h, r in zip(np.concatenate((largest, lost), axis=1), rounded)]


def most_cosine(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """What the cosines of sketched vectors are at most: u v = u' v' + u' (v - v') + (u - u') v."""
    sides = []
    for s in (a, b):
        raw = np.frombuffer(b"".join(s), dtype=np.uint8).reshape(len(s), -1)
        largest, lost = np.ascontiguousarray(raw[:, :16]).view(np.float64).T
        sides.append((raw[:, 16:].view(np.int8) * (largest / 127)[:, None], lost))
    (u, p), (v, q) = sides
    return u @ v.T + p[:, None] + (1 + p[:, None]) * q[None, :] + 1e-9


UNITS = "rep long, members long, unit binary, sketch binary, home_bytes binary, homes array<long>, near array<long>"
PAIRS = "a long, b long"
FOUND = "rep long, linked long, a long, b long"


def _units(tables: int, blocks: int, scale: float, probes: int):
    """Arrow stage: unit vectors in double precision with their home and neighbouring cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, E8Tables] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                vectors = part.column("embedding").to_pylist()
                rep, members = part.column("rep").to_numpy(), part.column("members").to_numpy()
                for d in sorted(set(map(len, vectors))):
                    rows = [i for i, v in enumerate(vectors) if len(v) == d]
                    x = np.array([vectors[i] for i in rows], dtype=np.float64)
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                    if d not in made:
                        made[d] = E8Tables(d, tables, blocks, scale, probes)
                    home, near = made[d].cells(x)
                    near = near.reshape(len(rows), -1)
                    lists = lambda m: pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], m.ravel())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rep[rows]), pa.array(members[rows]), pa.array([u.tobytes() for u in x], pa.binary()),
                            pa.array(sketches(x), pa.binary()), pa.array([h.tobytes() for h in home], pa.binary()), lists(home), lists(near),
                        ],
                        names=["rep", "members", "unit", "sketch", "home_bytes", "homes", "near"],
                    )

    return run


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that keep the components of a bipartite link matrix, one less than nodes per component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges, columns = [], linked.shape[0]
    for i in np.flatnonzero(linked.any(axis=1)).tolist():
        for j in np.flatnonzero(linked[i]).tolist():
            a, b = root(i), root(columns + j)
            if a != b:
                parent[b] = a
                edges.append((i, j))
    return edges


def _compare(threshold: float, tables: int):
    """Arrow stage over pairs of blocks of one cell: exact cosines, links counted per vector.

    Two vectors that share a home cell are counted in the first table where they do, so once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                sides = []
                for s in "lr":
                    reps = np.array(get[f"{s}_rep"], dtype=np.int64)
                    unit = np.frombuffer(b"".join(get[f"{s}_unit"]), dtype=np.float64).reshape(len(reps), -1)
                    homes = np.frombuffer(b"".join(get[f"{s}_home_bytes"]), dtype=np.int64).reshape(len(reps), tables)
                    sides.append((reps, np.array(get[f"{s}_members"], dtype=np.int64), unit, homes))
                (ra, ma, ua, ha), (rb, mb, ub, hb) = sides
                if ua.shape[1] != ub.shape[1]:
                    continue
                linked = ua @ ub.T >= threshold
                for t in range(get["t"]):
                    linked &= ha[:, t, None] != hb[None, :, t]
                if get["same"]:
                    linked = np.triu(linked, 1)
                rep = np.concatenate((ra, rb))
                linked_by = np.concatenate((linked @ mb, ma @ linked))
                some = linked_by > 0
                rep, linked_by = rep[some], linked_by[some]
                edges = np.array(_forest(linked), dtype=np.int64).reshape(-1, 2)
                a, b = ra[edges[:, 0]], rb[edges[:, 1]]
                none = lambda k: pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(rep), none(len(a))]), pa.concat_arrays([pa.array(linked_by), none(len(a))]),
                        pa.concat_arrays([none(len(rep)), pa.array(a)]), pa.concat_arrays([none(len(rep)), pa.array(b)]),
                    ],
                    names=["rep", "linked", "a", "b"],
                )

    return run


def _suspects(threshold: float, tables: int):
    """Arrow stage over a block that probes a cell and a block at home there: pairs that share no home cell and whose sketches
    allow a cosine of ``threshold``. Several probes may find the same pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                if len(get["l_sketch"][0]) != len(get["r_sketch"][0]):
                    continue
                (ra, ha), (rb, hb) = (
                    (np.array(get[f"{s}_rep"], dtype=np.int64), np.frombuffer(b"".join(get[f"{s}_home_bytes"]), dtype=np.int64).reshape(-1, tables))
                    for s in "lr"
                )
                i, j = np.nonzero((most_cosine(get["l_sketch"], get["r_sketch"]) >= threshold) & (ra[:, None] != rb[None, :]))
                apart = (ha[i] != hb[j]).all(axis=1)
                i, j = i[apart], j[apart]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ra[i], rb[j])), pa.array(np.maximum(ra[i], rb[j]))], names=["a", "b"])

    return run


def _confirmed(threshold: float):
    """Arrow stage over pairs with both vectors: those whose cosine is ``threshold`` at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                u, v = part.column("a_unit").to_pylist(), part.column("b_unit").to_pylist()
                linked = [len(x) == len(y) and np.frombuffer(x) @ np.frombuffer(y) >= threshold for x, y in zip(u, v)]
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _in_blocks(members: DataFrame, units: DataFrame, prefix: str, block_rows: int, carried: tuple[str, ...]) -> DataFrame:
    """(t, cell) members gathered into blocks of about ``block_rows``, however many a cell has, with their ``carried`` columns.

    A cell's block count follows from its size, which a partial count finds; the lookup of that count
    and of the carried columns are joins whose big side can be split.
    """
    sizes = members.groupBy(F.struct("t", "cell").alias("cell_key")).agg(F.count(F.lit(1)).alias("n"))
    blocked = members.join(sizes, F.struct("t", "cell") == F.col("cell_key")).select(
        "t", "cell", F.col("who"), F.pmod(F.xxhash64("who"), F.ceil(F.col("n") / block_rows)).alias("block"), "n"
    )
    full = blocked.join(units.select(*carried), F.col("who") == F.col("rep"))
    return full.groupBy("t", "cell", "block").agg(F.collect_list(F.struct(*carried)).alias("m"), F.max("n").alias(f"{prefix}_n")).select(
        "t", "cell", F.col("block").alias(f"{prefix}_block"), f"{prefix}_n", *[F.col(f"m.{c}").alias(f"{prefix}_{c}") for c in carried]
    )


def near_vectors(
    df: DataFrame, threshold: float = 0.9, tables: int = 10, blocks: int = 2, scale: float = 1.45, probes: int = 12,
    block_rows: int = 512, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """Near-duplicate vectors: rows (vec_id, n_links, component_id, kept), one per row of ``df``.

    Vectors are projected at random and decoded to E8 lattice points in ``tables`` tables; vectors of
    the same cell, and of a cell and its nearest neighbours, are compared by exact cosine in double
    precision; neighbours whose 8-bit sketches rule a link out are left out before, so probes carry no vectors.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable. Equal vectors are one class with a count throughout, so copies never form pairs. Vectors of different
    dimension are not compared. Null, empty, zero vectors, those with null or non-finite components,
    and rows without an id link with nothing; a row without an id has a null component and is kept.
    Rows that repeat an id are rows of their own. Other columns are ignored.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    classes = rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("members"))
    # One id on two different vectors: the class is named by id and digest, so that neither is lost.
    named = kept_table(
        classes.withColumn("first_id", F.col("rep")).withColumn("rep", F.monotonically_increasing_id()), "vector-classes"
    )
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: no merging of partitions
    units = kept_table(
        named.select("embedding", "rep", "members").repartition(width, "rep").mapInArrow(_units(tables, blocks, scale, probes), UNITS), "units"
    )
    homes = units.select(F.posexplode("homes").alias("t", "cell"), F.col("rep").alias("who"))
    around = units.select(F.posexplode("near").alias("p", "cell"), F.col("rep").alias("who")).select(
        F.floor(F.col("p") / probes).cast("int").alias("t"), "cell", "who"
    )
    shared = homes.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = homes.join(shared.select(F.struct("t", "cell").alias("cell_key")), F.struct("t", "cell") == F.col("cell_key"), "left_semi")
    home_blocks = kept_table(_in_blocks(crowded, units, "l", block_rows, ("rep", "members", "unit", "home_bytes")), "home-blocks")
    as_other = [F.col(c).alias(c.replace("l_", "r_", 1)) for c in home_blocks.columns[2:]]
    alone = home_blocks.where(F.col("l_n") <= block_rows).select("*", *as_other)  # cells of one block need no join
    large = home_blocks.where(F.col("l_n") > block_rows)
    within = alone.union(large.join(large.select("t", "cell", *as_other), ["t", "cell"]).where("l_block <= r_block"))
    within = within.withColumn("same", F.col("l_block") == F.col("r_block"))
    found = within.drop("l_n", "r_n", "l_block", "r_block", "cell").mapInArrow(_compare(threshold, tables), FOUND)

    occupied = homes.select(F.struct("t", "cell").alias("cell_key")).distinct()
    hits = around.join(occupied, F.struct("t", "cell") == F.col("cell_key"), "left_semi")
    probed = hits.select(F.struct("t", "cell").alias("cell_key")).distinct()
    hit_homes = homes.join(probed, F.struct("t", "cell") == F.col("cell_key"), "left_semi")
    sketched = ("rep", "sketch", "home_bytes")
    across = _in_blocks(hits, units, "l", block_rows, sketched).join(_in_blocks(hit_homes, units, "r", block_rows, sketched), ["t", "cell"])
    extra = across.drop("l_n", "r_n", "l_block", "r_block", "t", "cell").mapInArrow(_suspects(threshold, tables), PAIRS)

    found = kept_table(found, "home-links")
    discard(home_blocks)
    suspects = kept_table(extra.distinct(), "suspects")
    of_a, of_b = (units.select(F.col("rep").alias(f"{s}_rep"), F.col("unit").alias(f"{s}_unit")) for s in "ab")
    both = suspects.join(of_a, F.col("a") == F.col("a_rep")).join(of_b, F.col("b") == F.col("b_rep")).select("a", "b", "a_unit", "b_unit")
    pairs = kept_table(both.mapInArrow(_confirmed(threshold), PAIRS), "probe-links")
    discard(suspects)
    size = units.select(F.col("rep").alias("with"), "members")
    ends = pairs.select(F.col("a").alias("rep"), F.col("b").alias("with")).union(pairs.select(F.col("b").alias("rep"), F.col("a").alias("with")))
    counts = (
        found.where("rep is not null").select("rep", "linked")
        .union(ends.join(size, "with").select("rep", F.col("members").alias("linked")))
        .groupBy("rep").agg(F.sum("linked").alias("linked"))
    )
    edges = found.where("a is not null").select("a", "b").union(pairs.select("a", "b"))
    linked_classes = components(edges).select(F.col("node").alias("c_node"), F.col("component").alias("c_name"))
    per_class = (
        named.join(counts.withColumnRenamed("rep", "n_rep"), F.col("rep") == F.col("n_rep"), "left")
        .join(linked_classes, F.col("rep") == F.col("c_node"), "left")
        .select(
            "embedding", "first_id", F.coalesce("c_name", "rep").alias("name"),
            (F.coalesce("linked", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        )
    )
    per_class = kept_table(per_class, "class-links")
    smallest = per_class.groupBy("name").agg(F.min("first_id").alias("component_id")).withColumnRenamed("name", "named")
    known = per_class.join(smallest, F.col("name") == F.col("named")).select(
        F.struct(F.col("embedding").alias("e")).alias("class_key"), "n_links", "component_id"
    )
    keyed = rows.withColumn("key", F.when(usable, F.struct(F.col("embedding").alias("e"))))
    done = keyed.join(known, F.col("key") == F.col("class_key"), "left")
    component = F.coalesce("component_id", "vec_id")
    return done.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
