"""Helpers that several corpus operators share."""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import ensure_checkpoint_dir, ensure_skew_handling, kept_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided tables."""
    ensure_skew_handling(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is, null stays null."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def literal_table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A small frame from plain values, as one constant that the JVM parses (no RDD, no Python rows)."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")
    return spark.range(1).select(F.inline(parsed))


def contracted(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the graph whose edges are ``links``: a kept table (node, name).

    All nodes of a component have one of them as their name; nodes without an edge are not listed. In each
    round every node takes the name of smallest random rank among its neighbours and their neighbours (itself
    included), the ends of all edges are renamed and edges within one name go. Two steps let a star fall
    together at once wherever its centre ranks, and a fresh random order per round shrinks the graph by a
    constant factor in expectation, also for long chains, so the rounds grow with the logarithm of the graph.
    Repeated edges do no harm, as minima are taken in part before each shuffle. A round's results are tables in
    the shared folder, so a lost executor costs one round at most; those of the round before are deleted.
    """
    edges = kept_table(
        links.where(F.col(a) != F.col(b)).select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")), "edges"
    )
    names, turn = None, 0
    while names is None or not edges.isEmpty():
        turn += 1

        def ranked(node: str) -> Column:
            return F.struct(F.xxhash64(F.lit(turn), F.col(node)).alias("r"), F.col(node).alias("n"))

        both = edges.union(edges.select("v", "u"))
        near = both.groupBy("u").agg(F.min(ranked("v")).alias("lowest")).select(
            F.struct(F.col("u").alias("k")).alias("near_key"), F.least("lowest", ranked("u")).alias("lowest")
        )
        near = kept_table(near, "near-names")
        far = both.join(near, F.struct(F.col("v").alias("k")) == F.col("near_key")).groupBy("u").agg(F.min("lowest").alias("lowest"))
        joined = kept_table(far.select(F.col("u").alias("node"), F.col("lowest.n").alias("name")), "names")
        to = joined.select(F.struct(F.col("node").alias("k")).alias("key"), F.col("name").alias("to"))
        first = edges.join(to, F.struct(F.col("u").alias("k")) == F.col("key")).select(F.col("to").alias("u"), "v")
        second = first.join(to, F.struct(F.col("v").alias("k")) == F.col("key")).select("u", F.col("to").alias("v"))
        left = kept_table(second.where("u != v"), "edges")
        for spent in [edges, near]:
            discard(spent)
        edges = left
        if names is None:
            names = joined
        else:
            renamed = names.join(to, F.struct(F.col("name").alias("k")) == F.col("key"), "left")
            renamed = kept_table(renamed.select("node", F.coalesce("to", "name").alias("name")), "components")
            for spent in [names, joined]:
                discard(spent)
            names = renamed
    discard(edges)
    return names


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components as ``contracted`` finds them, named by their smallest node: rows (node, component)."""
    names = contracted(links, a, b)
    lowest = names.groupBy(F.struct(F.col("name").alias("k")).alias("key")).agg(F.min("node").alias("component"))
    return names.join(lowest, F.struct(F.col("name").alias("k")) == F.col("key")).select("node", "component")


def whole_row(df: DataFrame, name: str) -> Column:
    """All columns of ``df`` as one struct, so that their names meet no others."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with as many underscores before it as it takes to differ from every column of ``df`` in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{wanted}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def discard(df: DataFrame) -> None:
    """Deletes the folder of a frame that ``kept_table`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files and ensure_checkpoint_dir(spark).removeprefix("file:").lstrip("/") in files[0]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
