"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import contracted, discard, free_name
from tributary.llm.wordhash import Words, mix, text_chunks
from tributary.session import kept_table

HASHES, BAND_ROWS, BATCH, SMALL_BAND = 128, 4, 16, 32
OPENING_BANDS = (4, 8, 16)
_ADD = np.random.default_rng(11).integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MULTIPLY = np.random.default_rng(12).integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_PLACE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
SIGNED = "doc_id long, n_shingles long, digest binary, signature binary"
PAIRS = "a long, b long, name_a long, name_b long"
JUDGED = f"{PAIRS}, alike boolean"


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; fewer words than ``width`` make one shingle."""
    words = Words(texts)
    h, offsets = words.hashes, words.offsets
    places = _PLACE[:width] if width <= len(_PLACE) else [mix(np.array([i + 1], dtype=np.uint64))[0] | np.uint64(1) for i in range(width)]
    runs = np.zeros(max(0, len(h) - width + 1), dtype=np.uint64)
    for i, p in enumerate(places):
        runs += mix(h[i : len(h) - width + 1 + i] + p) * p
    runs = mix(runs)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= width:
            sets.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            short = np.array([b - a], dtype=np.uint64)
            for i in range(a, b):
                short = mix(h[i : i + 1] + short * _PLACE[0])
            sets.append(short)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def signature(shingles: np.ndarray, block: int = 4096) -> np.ndarray:
    """MinHash of a set: per hash function the least value over all its shingles, a block at a time."""
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(shingles), block):
        x = (shingles[start : start + block] >> np.uint64(32)).astype(np.uint32)
        v = x[None, :] * _MULTIPLY[:, None]
        v += _ADD[:, None]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        np.minimum(least, v.min(axis=1), out=least)
    return least


def least_matches(threshold: float, miss: float) -> list[int]:
    """For 16, 32, .. 128 compared hashes, the matches below which a pair is given up.

    With a uniform prior, m matches among n leave the similarity with a Beta(m + 1, n - m + 1)
    posterior, which exceeds the threshold with the probability that n + 1 trials of that chance
    give at most m successes. Below ``miss`` the pair is pruned.
    """
    bounds = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        bounds.append(m)
    return bounds


def digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return mix(shingles).sum(dtype=np.uint64).tobytes() + mix(shingles ^ _PLACE[1]).sum(dtype=np.uint64).tobytes()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow stage: set size, digest and signature of each text."""
    for batch, texts in text_chunks(batches, "text"):
        sets = shingle_sets(texts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest(s) for s in sets], pa.binary()), pa.array([signature(s).tobytes() for s in sets], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "digest", "signature"],
        )


def _prune(bounds: list[int]):
    """Arrow stage: which candidate pairs still may be similar after the signature batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = np.ones(batch.num_rows, dtype=bool)
            sides = [np.frombuffer(b"".join(batch.column(s).to_pylist()), dtype=np.uint32).reshape(-1, HASHES) for s in ("sig_a", "sig_b")]
            matches = np.zeros(batch.num_rows, dtype=np.int64)
            for step, bound in enumerate(bounds):
                left = np.flatnonzero(alike)
                cut = slice(step * BATCH, (step + 1) * BATCH)
                matches[left] += (sides[0][left, cut] == sides[1][left, cut]).sum(axis=1)
                alike[left] = matches[left] >= bound
            yield _judged(batch, alike)

    return run


def _judged(batch: pa.RecordBatch, alike: np.ndarray | list[bool]) -> pa.RecordBatch:
    """The batch's pairs with their verdicts."""
    names = ["a", "b", "name_a", "name_b"]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(alike, pa.bool_())], names=[*names, "alike"])


def _linked(x: np.ndarray, y: np.ndarray, numerator: int, denominator: int) -> bool:
    """Exact test of two sets, ``denominator`` * common >= ``numerator`` * union."""
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return denominator * common >= numerator * (len(both) - common)


def _confirm(numerator: int, denominator: int):
    """Arrow stage: which pairs of full sets are links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                alike.append(_linked(x, y, numerator, denominator))
            yield _judged(batch, alike)

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow stage: full sets of the texts that have the class's set (another text may bear the same id)."""
    for batch, texts in text_chunks(batches, "text"):
        sets, wanted, classes = shingle_sets(texts), batch.column("digest").to_pylist(), batch.column("cls").to_pylist()
        found = [(c, s.tobytes()) for s, d, c in zip(sets, wanted, classes) if digest(s) == d]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], names=["cls", "shingles"]
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow stage: a row per class and band; a band's key is a hash of its place and its MinHashes."""
    n_bands = HASHES // BAND_ROWS
    for batch in batches:
        whole = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=np.uint32).reshape(-1, n_bands, BAND_ROWS)
        keys = np.zeros(whole.shape[:2], dtype=np.uint64) + np.arange(n_bands, dtype=np.uint64)[None, :]
        for r in range(BAND_ROWS):
            keys = mix(keys * _PLACE[0] + whole[:, :, r])
        cls = np.repeat(batch.column("cls").to_numpy(), n_bands)
        places = np.tile(np.arange(n_bands, dtype=np.int32), len(whole))
        yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(keys.view(np.int64).ravel()), pa.array(places)], names=["cls", "band", "place"])


def key(*columns: str) -> Column:
    """The columns as one value: a join on it gets its own exchange on both sides, which lets a hot key be split."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def _open_pairs(bounds: list[int], numerator: int, denominator: int):
    """Arrow stage over pairs of blocks of one band: pairs in different components that the signatures leave open.

    A pair is given out only in the first band it shares, so once. Blocks that carry full sets confirm
    their pairs at once and give out links only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                (ca, na, sa, ga), (cb, nb, sb, gb) = (
                    [np.array(get[f"{s}_{c}"], dtype=np.int64) for c in ("cls", "name", "size")]
                    + [np.frombuffer(b"".join(get[f"{s}_sig"]), dtype=np.uint32).reshape(-1, HASHES)] for s in "lr"
                )
                small, large = np.minimum(sa[:, None], sb[None, :]), np.maximum(sa[:, None], sb[None, :])
                open_ = (na[:, None] != nb[None, :]) & (small * denominator >= large * numerator)
                i, j = np.nonzero(np.triu(open_, 1) if get["same"] else open_)
                matches = np.zeros(len(i), dtype=np.int64)
                for step, bound in enumerate(bounds):
                    cut = slice(step * BATCH, (step + 1) * BATCH)
                    matches += (ga[i, cut] == gb[j, cut]).sum(axis=1)
                    left = matches >= bound
                    i, j, matches = i[left], j[left], matches[left]
                agree = (ga[i].reshape(len(i), HASHES // BAND_ROWS, BAND_ROWS) == gb[j].reshape(len(i), HASHES // BAND_ROWS, BAND_ROWS)).all(axis=2)
                first = agree.argmax(axis=1) == get["place"]
                i, j = i[first], j[first]
                if get["l_set"] is not None:
                    xa, xb = ([np.frombuffer(v, dtype=np.uint64) for v in get[f"{s}_set"]] for s in "lr")
                    sure = np.array([_linked(xa[p], xb[q], numerator, denominator) for p, q in zip(i, j)], dtype=bool)
                    i, j = i[sure], j[sure]
                a, b, name_a, name_b = ca[i], cb[j], na[i], nb[j]
                low = a < b
                columns = [np.where(low, a, b), np.where(low, b, a), np.where(low, name_a, name_b), np.where(low, name_b, name_a)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "name_a", "name_b"])

    return run


def _rest_of_bands(
    still: DataFrame, sizes: DataFrame, signed: DataFrame, sets: DataFrame | None, bounds: list[int], numerator: int, denominator: int, block_rows: int = 256
) -> DataFrame:
    """Open pairs (a, b and the names of their components) of every band's members, found block by block however many members a band has.

    With ``sets`` the blocks carry them, and the pairs returned are links.
    """
    counted = still.join(sizes.select(key("band").alias("sk"), "n"), key("band") == F.col("sk"))
    blocked = counted.withColumn("block", F.pmod(F.xxhash64("cls"), F.ceil(F.col("n") / block_rows))).select("band", "place", "block", "cls", "name")
    info = signed.select(key("cls").alias("ik"), "n_shingles", "signature")
    full = blocked.join(info, key("cls") == F.col("ik")).drop("ik")
    if sets is None:
        full = full.withColumn("shingles", F.lit(None).cast("binary"))
    else:
        full = full.join(sets.select(key("cls").alias("xk"), "shingles"), key("cls") == F.col("xk"))
    blocks = kept_table(
        full.groupBy("band", "place", "block").agg(F.collect_list(F.struct("cls", "name", "n_shingles", "signature", "shingles")).alias("m")), "band-blocks"
    )

    def side(s: str) -> list[Column]:
        columns = (("cls", "cls"), ("name", "name"), ("size", "n_shingles"), ("sig", "signature"))
        full_set = (F.lit(None).cast("array<binary>") if sets is None else F.col("m.shingles")).alias(f"{s}_set")
        return [F.col("block").alias(f"{s}_block"), full_set, *[F.col(f"m.{c}").alias(f"{s}_{n}") for n, c in columns]]

    left, right = blocks.select("band", "place", *side("l")), blocks.select(F.col("band").alias("r_band"), *side("r"))
    met = left.join(right, (F.col("band") == F.col("r_band")) & (F.col("l_block") <= F.col("r_block")))
    met = met.withColumn("same", F.col("l_block") == F.col("r_block")).drop("band", "r_band", "l_block", "r_block")
    return met.mapInArrow(_open_pairs(bounds, numerator, denominator), PAIRS)


def _judge(pairs: DataFrame, signed: DataFrame, sets: DataFrame, bounds: list[int], numerator: int, denominator: int) -> DataFrame:
    """The pairs that are links, with the names of their components: sizes, then signatures in batches, then full sets of the survivors."""
    info = signed.select("cls", "n_shingles", "signature")
    one = info.select(key("cls").alias("ka"), F.col("signature").alias("sig_a"), F.col("n_shingles").alias("n_a"))
    two = info.select(key("cls").alias("kb"), F.col("signature").alias("sig_b"), F.col("n_shingles").alias("n_b"))
    sized = pairs.join(one, key("a") == F.col("ka")).join(two, key("b") == F.col("kb"))
    close = sized.where(F.least("n_a", "n_b") * denominator >= F.greatest("n_a", "n_b") * numerator)
    named = ("a", "b", "name_a", "name_b")
    hopeful = close.select(*named, "sig_a", "sig_b").mapInArrow(_prune(bounds), JUDGED).where("alike")
    first = sets.select(key("cls").alias("ka"), F.col("shingles").alias("set_a"))
    second = sets.select(key("cls").alias("kb"), F.col("shingles").alias("set_b"))
    full = hopeful.join(first, key("a") == F.col("ka")).join(second, key("b") == F.col("kb")).select(*named, "set_a", "set_b")
    return full.mapInArrow(_confirm(numerator, denominator), JUDGED).where("alike").select(*named)


def _renamed(df: DataFrame, renaming: DataFrame) -> DataFrame:
    """``df`` with ``name`` replaced where ``renaming`` (node, name) has another."""
    other = renaming.select(key("node").alias("rk"), F.col("name").alias("to"))
    return df.join(other, key("name") == F.col("rk"), "left").withColumn("name", F.coalesce("to", "name")).drop("rk", "to")


def near_documents(
    df: DataFrame, numerator: int = 75, denominator: int = 100, miss: float = 1e-6, text: str = "text", doc_id: str = "doc_id",
    pivot_rounds: int = 8,
) -> DataFrame:
    """Near-duplicate groups: rows (doc_id, n_shingles, component_id, kept), one per row of ``df``.

    Documents whose sets of five-word shingles (A-Z lower-cased) have a Jaccard similarity of
    ``numerator / denominator`` or more are linked; ``component_id`` is the smallest id reachable.
    Equal sets are one class. Classes that agree in one of 32 bands of 4 MinHashes are candidates. A
    candidate pair's signatures are compared 16 at a time and the pair is given up as soon as the posterior
    probability of a link falls below ``miss``; what survives is confirmed on the full sets.

    Bands of many members are not expanded into pairs. In each round every band compares its members
    with a pivot, the member of smallest random rank, unless they are in one component already; found
    links join components. The opening rounds do so in the first 4, 8 and 16 band places only: they join
    most of a large group, whose members then need not meet a pivot in every band. The rounds go on
    while they shrink what is left open by a tenth, which is counted without making the pairs. What is
    open then, the pairs of a band that lie in different components and were not compared, has its
    signatures compared in blocks of members, so no candidate is lost and only pairs that still may be
    links leave a block.

    Null and empty texts have no shingles and link with nothing. A row with a null id is not linked; its
    component is null and it is kept. Rows that repeat an id count as one document for their links if
    their texts are equal, and as members of each other's component otherwise. Other columns are
    ignored, and an empty table gives no rows.
    """
    return _near_documents(df, numerator, denominator, miss, text, doc_id, pivot_rounds)[0]


def _near_documents(
    df: DataFrame, numerator: int = 75, denominator: int = 100, miss: float = 1e-6, text: str = "text", doc_id: str = "doc_id",
    pivot_rounds: int = 8,
) -> tuple[DataFrame, list[DataFrame]]:
    """What ``near_documents`` returns, and the kept tables that it reads. Others are deleted once their successor is written."""
    bounds = least_matches(numerator / denominator, miss)
    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = kept_table(source.mapInArrow(_sign, SIGNED), "signatures")
    documents = kept_table(signed.drop("signature"), "documents")
    whole = signed.where("doc_id is not null and n_shingles > 0")
    # Equal sets have equal signatures, so any one will do. Two texts under one id are two classes
    # with the same first id, so classes get numbers of their own.
    grouped = whole.groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("first_id"), F.any_value("signature").alias("signature"))
    wide = kept_table(grouped.withColumn("cls", F.monotonically_increasing_id()), "set-classes")
    discard(signed)
    members = wide.select("cls", "signature").mapInArrow(_bands, "cls long, band long, place int")
    n = F.count(F.lit(1))
    crowded = members.groupBy("band").agg(n.alias("n"), n.alias("squares"), n.alias("names")).where("n > 1")
    crowded = kept_table(crowded, "mixed-bands")
    shared = members.join(crowded.select(key("band").alias("bk")), key("band") == F.col("bk"), "left_semi")
    shared = shared.select("band", "place", "cls", F.col("cls").alias("name"))
    state = kept_table(shared, "bands")
    involved = state.select("cls").distinct()
    signed_in = kept_table(wide.join(involved, "cls", "left_semi").select("cls", "n_shingles", "signature", "first_id", "digest"), "involved-signatures")
    classes = kept_table(wide.drop("signature"), "classes")
    discard(wide)
    # The full sets of these, computed once more from the text of the class's first document.
    texts = signed_in.select(key("first_id").alias("tk"), "cls", "digest")
    by_id = source.join(texts, key("doc_id") == F.col("tk"))
    sets = kept_table(by_id.select("cls", "digest", "text").mapInArrow(_sets, "cls long, shingles binary"), "full-sets")

    renamings: list[DataFrame] = []
    tested: list[DataFrame] = []
    open_before = None
    last = len(OPENING_BANDS) + pivot_rounds
    for turn in range(last + 1):
        mixed = crowded  # at first every class has a name of its own
        if turn:
            per_name = state.groupBy("band", "name").agg(n.alias("n"))
            per_band = per_name.groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"), n.alias("names"))
            mixed = kept_table(per_band.where("names > 1"), "mixed-bands")
        rest = mixed.agg(F.sum(F.col("n") * F.col("n") - F.col("squares")), F.sum("n")).first()
        if not rest[0]:
            discard(mixed)
            break
        # Names only fall together, so a band that is not mixed now never is again.
        still = state.join(mixed.select(key("band").alias("mk")), key("band") == F.col("mk"), "left_semi") if turn else state
        opening = turn < len(OPENING_BANDS)
        few = rest[0] <= 4 * rest[1] or turn == last or (open_before is not None and rest[0] > 0.9 * open_before)
        open_before = None if opening else rest[0]
        if few:
            # Pairs of small bands are few per member; those of large ones are confirmed where they are found.
            large = _rest_of_bands(still, mixed.where(F.col("n") > SMALL_BAND), signed_in, sets, bounds, numerator, denominator)
            pairs = _rest_of_bands(still, mixed.where(F.col("n") <= SMALL_BAND), signed_in, None, bounds, numerator, denominator)
        else:
            large = None
            met = state.where(F.col("place") < OPENING_BANDS[turn]) if opening else state
            lowest = F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("r"), F.col("cls").alias("c"), F.col("name").alias("n")))
            pivot = met.groupBy("band").agg(lowest.alias("p")).select(key("band").alias("pk"), "p")
            met = met.join(pivot, key("band") == F.col("pk")).where("name != p.n")
            low = F.col("cls") < F.col("p.c")
            pairs = met.select(
                F.least("cls", "p.c").alias("a"), F.greatest("cls", "p.c").alias("b"),
                F.when(low, F.col("name")).otherwise(F.col("p.n")).alias("name_a"), F.when(low, F.col("p.n")).otherwise(F.col("name")).alias("name_b"),
            )
        pairs = pairs.distinct()
        if tested:
            seen = reduce(DataFrame.union, tested).select(key("a", "b").alias("seen"))
            pairs = pairs.join(seen, key("a", "b") == F.col("seen"), "left_anti")
        pairs = kept_table(pairs, "pairs")
        new = _judge(pairs, signed_in, sets, bounds, numerator, denominator)
        # Only the new links are contracted, over the names so far.
        renaming = contracted(new if large is None else large.union(new), "name_a", "name_b")
        renamings.append(renaming)
        if not few:
            tested.append(pairs)
            renamed = kept_table(_renamed(still, renaming), "bands")
            discard(state)
            state = renamed
        discard(mixed)
        if few:
            break
    for spent in [state, signed_in, sets, *tested]:
        discard(spent)
    named = classes.withColumn("name", F.col("cls"))
    for renaming in renamings:
        named = _renamed(named, renaming)
    named = kept_table(named.select("digest", "n_shingles", "first_id", "name"), "named-classes")
    for spent in [classes, *renamings]:
        discard(spent)
    smallest = named.groupBy("name").agg(F.min("first_id").alias("component_id")).select(key("name").alias("nk"), "component_id")
    final = named.join(smallest, key("name") == F.col("nk")).select(key("digest", "n_shingles").alias("ck"), "component_id")
    known = documents.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), key("digest", "n_shingles")).alias("dk"))
    component = F.coalesce("component_id", "doc_id")
    result = known.join(final, F.col("dk") == F.col("ck"), "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
    return result, [documents, named]


def drop_near_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` without those ``near_documents`` does not keep: one document per group stays.

    Rows of equal id are one document: they stay or go together. Other columns are handed on, whatever their names.
    """
    marked, working = _near_documents(df, text=text, doc_id=doc_id, **options)
    lost_id = free_name(df, "lost")
    lost = kept_table(marked.where("not kept").select(F.col("doc_id").alias(lost_id)).distinct(), "near-copies")
    for spent in working:
        discard(spent)
    return df.join(lost, F.col(f"`{doc_id}`").cast("long") == F.col(lost_id), "left_anti")
