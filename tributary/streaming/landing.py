"""Incremental landing: each new batch of files joins a keyed table whose last write wins."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.keyed import NULL_KEY, all_not_null, keep_one
from tributary.operators.refusals import REASON, sift
from tributary.session import create_text, delete_folder, folder_names, make_folder


def land_increment(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: str,
    file_format: str = "json",
    max_files: int | None = None,
    refused: str | None = None,
) -> None:
    """Take all files not seen before, then stop.

    Every micro-batch keeps its last row per key and is written to its own ``batch_id`` folder,
    replacing what an earlier try of the same batch left there: a batch that runs again gives the
    same table. The work of a batch grows with the batch, not with the table; which batch's row
    counts is settled by the reader, and ``compact_landed`` keeps the number of folders small.
    No watermark is needed, since a late record is just another write to its key.

    Records with a null in the key cannot be told apart and are no rows of the table. With ``refused`` each batch divides its records
    in one pass and writes those to a ``batch_id`` folder there, again replacing an earlier try's; ``read_refused`` reads them.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, batch_id: int) -> None:
        rest = [F.col(c).desc_nulls_last() for c in batch.columns if c not in keys and c != order_by]
        taken = batch.where(all_not_null(keys))
        if refused:
            sifted = sift(batch, {NULL_KEY: ~all_not_null(keys)}, f"{target.rstrip('/')}-sifted")
            taken = sifted.accepted
            if sifted.counts[NULL_KEY]:
                sifted.refused.write.mode("overwrite").parquet(f"{refused.rstrip('/')}/batch_id={batch_id}")
        last = keep_one(taken, keys, F.col(order_by).desc_nulls_last(), *rest)
        last.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch_id={batch_id}")

    query = (
        reader.load(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_refused(spark: SparkSession, refused: str, schema: T.StructType | str) -> DataFrame:
    """All records refused so far, with ``refused_because`` and the batch that brought them."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    make_folder(spark, refused)
    whole = T.StructType([*declared.fields, T.StructField(REASON, T.StringType()), T.StructField("batch_id", T.LongType())])
    return spark.read.schema(whole).parquet(refused)


def read_landed(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The table as it stands: per key the row of the newest batch.

    Only live folders are opened: the runs that the manifest names and the batches that came after them.
    """
    live = _live(spark, target, _manifest(spark, target))
    batches = _opened(spark, target, live or [target])
    return keep_one(batches, keys, F.col("batch_id").desc()).drop("batch_id")


# ------------------------------------------------------------------ compaction

MANIFESTS, RUNS = "_manifests", "_runs"  # readers of the whole folder skip names that begin so


@dataclass(frozen=True)
class Manifest:
    """What is live: runs with their levels, which hold all batches up to ``through``. Later batches are live by being there."""

    version: int = 0
    through: int = -1
    runs: tuple[tuple[str, int], ...] = ()


def _read_manifest(spark: SparkSession, target: str, file: str) -> Manifest:
    """One manifest; the empty one for a file whose writer broke off."""
    text = spark.read.option("wholetext", "true").text(f"{target.rstrip('/')}/{MANIFESTS}/{file}").first()
    try:
        found = json.loads(text[0] if text else "")
    except ValueError:
        return Manifest()
    return Manifest(found["version"], found["through"], tuple((n, level) for n, level in found["runs"]))


def _manifest(spark: SparkSession, target: str) -> Manifest:
    """The newest manifest that was written to its end."""
    for file in reversed(folder_names(spark, f"{target.rstrip('/')}/{MANIFESTS}")):
        if (found := _read_manifest(spark, target, file)).version:
            return found
    return Manifest()


def _batches(spark: SparkSession, target: str) -> list[int]:
    return sorted(int(n.removeprefix("batch_id=")) for n in folder_names(spark, target) if n.startswith("batch_id="))


def _live(spark: SparkSession, target: str, manifest: Manifest) -> list[str]:
    root = target.rstrip("/")
    later = [f"{root}/batch_id={b}" for b in _batches(spark, target) if b > manifest.through]
    return [f"{root}/{RUNS}/{name}" for name, _ in manifest.runs] + later


def _opened(spark: SparkSession, target: str, folders: Sequence[str]) -> DataFrame:
    """Rows of batches and runs together, all with ``batch_id``."""
    reader = spark.read.option("mergeSchema", "true")
    runs = [f for f in folders if f"/{RUNS}/" in f]
    batches = [f for f in folders if f not in runs]
    parts = [reader.parquet(*runs)] if runs else []
    if batches:
        parts.append(reader.option("basePath", target).parquet(*batches).withColumn("batch_id", F.col("batch_id").cast("long")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def compact_landed(spark: SparkSession, target: str, keys: Sequence[str], fan_in: int = 4) -> Manifest:
    """Merge the batches of a landed table into runs, and runs of one level into one of the next.

    A run holds the newest row per key of what it merges, with the batch it came from. ``fan_in`` finished batches make a run of level 1,
    ``fan_in`` runs of a level one of the next, so a row is rewritten once per level and a reader opens a number of folders that grows
    with the logarithm of the batches. The newest batch may still be repeated by the stream and is left out.

    A run is written in full before a manifest names it, and a manifest is a new file of the next number: readers see the old state or the new one. What
    a broken compaction left is named by no manifest and is never read. Of two at once the second finds a newer manifest or its number taken, and
    changes nothing. Folders that the last manifest no longer names are deleted only by the compaction after, so that readers of the state before can end.
    """
    root, manifest = target.rstrip("/"), _manifest(spark, target)
    _delete_dead(spark, target, manifest)
    finished = [b for b in _batches(spark, target) if b > manifest.through][:-1]
    runs, through = list(manifest.runs), manifest.through
    if len(finished) >= fan_in:
        runs.append((_merged(spark, target, [f"{root}/batch_id={b}" for b in finished], keys), 1))
        through = finished[-1]
    level = 1
    while (same := [r for r in runs if r[1] == level]):
        if len(same) >= fan_in:
            merged = _merged(spark, target, [f"{root}/{RUNS}/{name}" for name, _ in same], keys)
            runs = [r for r in runs if r not in same] + [(merged, level + 1)]
        level += 1
    if (through, tuple(runs)) == (manifest.through, manifest.runs):
        return manifest
    taken = folder_names(spark, f"{root}/{MANIFESTS}")
    if taken and _read_manifest(spark, target, taken[-1]).version > manifest.version:
        return _manifest(spark, target)  # another compaction was first
    # A manifest that broke off has taken its number.
    after = Manifest(int(taken[-1].removesuffix(".json")) + 1 if taken else 1, through, tuple(runs))
    written = create_text(spark, f"{root}/{MANIFESTS}/{after.version:012d}.json", json.dumps(asdict(after)))
    return after if written else _manifest(spark, target)


def _merged(spark: SparkSession, target: str, folders: Sequence[str], keys: Sequence[str]) -> str:
    """A new run of the newest row per key."""
    name = f"run-{uuid.uuid4().hex[:12]}"
    newest = keep_one(_opened(spark, target, folders), keys, F.col("batch_id").desc())
    newest.write.parquet(f"{target.rstrip('/')}/{RUNS}/{name}")
    return name


def _delete_dead(spark: SparkSession, target: str, manifest: Manifest) -> None:
    """Delete the batches that the last manifest has in runs, and the runs that an earlier one named and it does not.

    A run that no manifest has named yet may be another compaction's, so it stays.
    """
    root, named = target.rstrip("/"), {name for name, _ in manifest.runs}
    for b in _batches(spark, target):
        if b <= manifest.through:
            delete_folder(spark, f"{root}/batch_id={b}")
    there = set(folder_names(spark, f"{root}/{RUNS}"))
    for file in folder_names(spark, f"{root}/{MANIFESTS}"):
        for name, _ in _read_manifest(spark, target, file).runs:
            if name in there - named:
                delete_folder(spark, f"{root}/{RUNS}/{name}")
                there.discard(name)
