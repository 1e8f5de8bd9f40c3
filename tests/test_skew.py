"""A third of the rows on one key: adaptive execution must be able to split it."""

import pytest
from pyspark.sql import functions as F

from tributary.operators.joins import group_value, not_in, splittable_full_join
from tributary.operators.keyed import replace_groups
from tributary.operators import ordinals
from tributary.operators.linkage import Pass, cascade
from tributary.operators.ordinals import number_within

SETTINGS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.files.maxPartitionBytes": "256k",
}


@pytest.fixture
def skew_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(spark):
    n = 60_000
    return spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def final_plan(df):
    kept = df.agg(F.count("*").alias("n"), F.max("payload").alias("m"))
    kept.collect()
    return kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_group_value_splits_a_hot_key(skew_settings, hot):
    plan = final_plan(group_value(hot, "k", F.min("id"), "first"). where("first >= 0"))
    assert "skew=true" in plan


def test_cascade_splits_a_hot_group(skew_settings, hot, spark):
    entities = spark.range(-1, 400).select(F.col("id").alias("key"), F.concat(F.lit("e"), "id").alias("entity"))
    plan = final_plan(cascade(hot, [Pass(entities, "key", "k")], "entity", "k"))
    assert "skew=true" in plan


def test_anti_and_full_joins_split_a_hot_key(skew_settings, hot, spark):
    listed = spark.range(100, 300).withColumnRenamed("id", "o")
    assert "skew=true" in final_plan(not_in(hot, "k", listed, "o"))
    other = spark.range(-1, 600).select(F.col("id").alias("j"), F.lit("x").alias("other"))
    assert "skew=true" in final_plan(splittable_full_join(hot, other, ["k"], ["j"]))
    batch = hot.where("k between 10 and 20")
    assert "skew=true" in final_plan(replace_groups(hot, batch, ["k"]))


def test_numbering_spreads_a_hot_key_over_ranges(skew_settings, spark):
    """One key, one long prefix in all texts: the rows still fall into many ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("k"), F.format_string("Customer#%09d", "id").alias("t"), "id")
        sizes = []
        keep = ordinals.kept_table
        ordinals.kept_table = lambda dealt, name: sizes.extend(r["count"] for r in dealt.groupBy("_range").count().collect()) or keep(dealt, name)
        numbered = number_within(df, ["k"], ["t"])
    finally:
        ordinals.kept_table = keep
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 16 and max(sizes) < 0.2 * 20_000
    assert numbered.where("ordinal != id + 1").count() == 0 and numbered.count() == 20_000
