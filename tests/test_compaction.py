"""Compaction of a landed stream: broken off at every step, repeated, two at once, readers of the state before."""

import pytest
from pyspark.sql import functions as F

from tributary.session import create_text, folder_names
from tributary.streaming import landing

KEYS = ["k"]


def put(spark, target, batch, rows):
    """A batch as the stream writes it."""
    spark.createDataFrame(rows, "k long, v string").write.mode("overwrite").parquet(f"{target}/batch_id={batch}")


def state(spark, target):
    return sorted(tuple(r) for r in landing.read_landed(spark, target, KEYS).select("k", "v").collect())


def filled(spark, target, batches):
    for b in batches:
        put(spark, target, b, [(1, f"one {b}"), (b + 10, f"own {b}")])
    return sorted([(1, f"one {max(batches)}"), *[(b + 10, f"own {b}") for b in batches]])


def test_levels(spark, tmp_path):
    target, folders = str(tmp_path / "t"), []
    for b in range(10):
        expected = filled(spark, target, range(b, b + 1)) if b == 0 else None
        put(spark, target, b, [(1, f"one {b}"), (b + 10, f"own {b}")])
        manifest = landing.compact_landed(spark, target, KEYS, fan_in=2)
        folders.append(len(landing._live(spark, target, manifest)))
        assert state(spark, target) == sorted([(1, f"one {b}"), *[(i + 10, f"own {i}") for i in range(b + 1)]]), expected
    assert max(folders) <= 4 and max(level for _, level in manifest.runs) >= 3
    assert landing.compact_landed(spark, target, KEYS, fan_in=2) == manifest  # again: nothing changes
    assert len(landing._batches(spark, target)) <= 3 and state(spark, target)[0] == (1, "one 9")


@pytest.mark.parametrize("step", ["_merged", "create_text", "half a manifest"])
def test_a_compaction_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch, step):
    target = str(tmp_path / "t")
    expected = filled(spark, target, range(5))

    def fail(*args):
        if step == "_merged":
            landing._opened(args[0], args[1], args[2]).write.parquet(f"{target}/_runs/run-broken")
        elif step == "half a manifest":
            create_text(spark, args[1], args[2][: len(args[2]) // 2])
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(landing, "_merged" if step == "_merged" else "create_text", fail)
        with pytest.raises(RuntimeError, match="lost"):
            landing.compact_landed(spark, target, KEYS)
    assert state(spark, target) == expected and landing._manifest(spark, target) == landing.Manifest()
    manifest = landing.compact_landed(spark, target, KEYS)
    assert state(spark, target) == expected and manifest.through == 3 and len(manifest.runs) == 1
    put(spark, target, 5, [(1, "last"), (2, "x")])
    landing.compact_landed(spark, target, KEYS)
    assert state(spark, target) == sorted([(1, "last"), (2, "x"), *[r for r in expected if r[0] != 1]])


def test_two_at_once_and_readers_of_the_state_before(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    expected = filled(spark, target, range(5))
    before = landing.read_landed(spark, target, KEYS)
    merged = landing._merged

    def other_is_faster(*args):
        monkeypatch.setattr(landing, "_merged", merged)
        landing.compact_landed(spark, target, KEYS)
        return merged(*args)

    monkeypatch.setattr(landing, "_merged", other_is_faster)
    manifest = landing.compact_landed(spark, target, KEYS)
    assert len(folder_names(spark, f"{target}/_manifests")) == 1 and len(manifest.runs) == 1
    assert state(spark, target) == expected == sorted(tuple(r) for r in before.select("k", "v").collect())


def test_later_columns_and_the_newest_batch(spark, tmp_path):
    target = str(tmp_path / "t")
    filled(spark, target, range(5))
    spark.range(1).select(F.col("id").alias("k"), F.lit("n").alias("note")).write.parquet(f"{target}/batch_id=5")
    landing.compact_landed(spark, target, KEYS)
    put(spark, target, 5, [(0, "again")])  # the stream may repeat its newest batch
    assert (0, "again") in state(spark, target)
