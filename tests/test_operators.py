"""Operators against small brute-force or hand-computed results."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tributary.operators import history, quality
from tributary.operators.joins import group_value, not_in, origin_flag, splittable_full_join, unique_groups
from tributary.operators.keyed import add_missing_columns, append_evolving, drop_copies, keep_one, merge_rows, upsert
from tributary.operators.linkage import Pass, cascade
from tributary.operators.months import fill_months, month_spine
from tributary.operators.ordinals import match_nth, number_within, rank_within
from tributary.operators.tree import tree_paths


def test_upsert_last_write_wins_and_is_idempotent(spark, rows):
    current = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 1)], "id int, v string, old string, at int")
    batch = spark.createDataFrame(
        [(2, "early", 2), (2, "late", 3), (3, "new", 2), (None, "lost", 9)], "id int, v string, at int")
    once = upsert(current, batch, ["id"], "at")
    expected = [(1, "a", "x", 1), (2, "late", "y", 3), (3, "new", None, 2)]
    assert rows(once, "id", "v", "old", "at") == expected
    assert rows(upsert(once, batch, ["id"], "at"), "id", "v", "old", "at") == expected


def test_upsert_with_new_column(spark, rows):
    current = spark.createDataFrame([(1, "a")], "id int, v string")
    batch = spark.createDataFrame([(2, "b", "n")], "id int, v string, extra string")
    assert rows(upsert(current, batch, ["id"]), "id", "v", "extra") == [(1, "a", None), (2, "b", "n")]


def test_merge_never_matches_null_keys(spark, rows):
    current = spark.createDataFrame([("a", None, 1), ("a", "b", 1)], "k1 string, k2 string, v int")
    batch = spark.createDataFrame([("a", None, 2), ("a", "b", 2)], "k1 string, k2 string, v int")
    merged = merge_rows(current, batch, ["k1", "k2"])
    assert rows(merged) == sorted([("a", None, 1), ("a", None, 2), ("a", "b", 2)], key=str)


def test_drop_copies_keeps_earliest_and_groups_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, None, 5, "p"), (1, None, 3, "q"), (1, None, None, "r"), (2, "x", 1, "s")], "a int, b string, at int, n string")
    assert rows(drop_copies(df, ["a", "b"], "at")) == [(1, None, 3, "q"), (2, "x", 1, "s")]
    assert rows(drop_copies(df.drop("n"), ["a", "b"], "at")) == [(1, None, 3), (2, "x", 1)]


def test_evolving_columns(spark, rows):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "n")], "x int, y string")
    assert rows(append_evolving(a, b)) == [(1, None), (2, "n")]
    assert rows(add_missing_columns(a, ["x", "z"])) == [(1, None)]


@pytest.mark.parametrize("listed, expected", [
    ([(1,)], [(2,)]), ([(1,), (None,)], []), ([], [(1,), (2,), (None,)]),
])
def test_not_in_null_rules(spark, rows, listed, expected):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    others = spark.createDataFrame(listed, "o int")
    assert rows(not_in(df, "k", others, "o")) == sorted(expected, key=str)


def test_splittable_full_join_equals_full_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (1, "w")], "j int, r string")
    expected = left.join(right, F.col("k") == F.col("j"), "full")
    assert rows(splittable_full_join(left, right, ["k"], ["j"]), "k", "l", "j", "r") == rows(expected, "k", "l", "j", "r")
    flagged = expected.select(origin_flag(F.col("l"), F.col("r"), "both", "left", "right").alias("o"))
    assert sorted(r[0] for r in flagged.collect()) == ["both"] * 4 + ["left"] * 2 + ["right"] * 2


def test_unique_groups_and_group_value(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    assert rows(unique_groups(df, "k")) == [("b", 3)]
    assert rows(group_value(df, "k", F.min("v"), "m")) == sorted([("a", 1, 1), ("a", 2, 1), ("b", 3, 3), (None, 4, 4)], key=str)


@pytest.mark.parametrize("order", [["n", "id"], ["t", "id"], ["d", "id"]])
def test_numbering_with_a_hot_key_equals_plain_window(spark, rows, order):
    """A third of the rows share one key, and all texts share a long prefix."""
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919) % 1000).alias("n"),
        F.when(F.col("id") % 13 != 0, F.concat(F.lit("Customer#0000ç"), (F.col("id") * 31) % 500)).alias("t"),
        F.date_add(F.lit("2020-01-01").cast("date"), ((F.col("id") * 17) % 900).cast("int")).alias("d"),
    )
    window = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    plain = df.withColumn("ordinal", F.row_number().over(window))
    assert rows(plain, "id", "ordinal") == rows(number_within(df, ["k"], order), "id", "ordinal")


def test_rank_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("b", None, 4)], "k string, v int, id int")
    expected = [(1, 1), (2, 1), (3, 3), (4, 1)]
    assert rows(rank_within(df, ["k"], "v"), "id", "rank") == expected
    many = spark.range(4000).select("id", F.lit("hot").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("v"))
    plain = many.withColumn("rank", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first())))
    assert rows(rank_within(many, ["k"], "v"), "id", "rank") == rows(plain, "id", "rank")


def test_match_nth_two_posts_three_holders(spark, rows):
    posts = spark.createDataFrame([("c", "p2"), ("c", "p1"), ("z", "p9")], "code string, post string")
    holders = spark.createDataFrame([("c", "h3"), ("c", "h1"), ("c", "h2"), (None, "h0")], "held string, holder string")
    joined = match_nth(posts, holders, [("code", "held")], ["post"], ["holder"])
    assert rows(joined, "post", "holder") == sorted(
        [("p1", "h1"), ("p2", "h2"), (None, "h3"), ("p9", None), (None, "h0")], key=str)


def _brute_cascade(facts, candidates):
    """facts: (group, keys tuple); candidates: list of {key: [entities]}."""
    rest, found = [f for f in facts if f[0] is not None], []
    for i, known in enumerate(candidates):
        linked = [(e, *f, i + 1) for f in rest for e in known.get(f[1][i], []) if f[1][i] is not None]
        found += linked
        gone = {f[1] for f in linked}
        rest = [f for f in rest if f[0] not in gone]
    return sorted(((e, g, *k, p) for e, g, k, p in found), key=str)


def test_cascade_equals_pass_by_pass(spark, rows):
    facts = [(f"g{i % 40}" if i % 17 else None, (f"a{i % 13}", f"b{i % 7}" if i % 5 else None, f"c{i % 11}")) for i in range(400)]
    known = [{"a1": ["e1"], "a2": ["e2", "e3"]}, {"b3": ["e4"], "b4": ["e1"]}, {"c5": ["e5"], "c6": ["e6", "e7"]}]
    frame = spark.createDataFrame([(g, *k) for g, k in facts], "g string, a string, b string, c string")
    passes = [
        Pass(spark.createDataFrame([(e, k) for k, es in c.items() for e in es], "entity string, key string"), "key", column)
        for c, column in zip(known, "abc")
    ]
    linked = cascade(frame, passes, "entity", "g")
    assert rows(linked) == _brute_cascade(facts, known)
    groups = {}
    for r in linked.collect():
        groups.setdefault(r["g"], set()).add(r["link_pass"])
    assert all(len(p) == 1 for p in groups.values())  # passes are disjoint by group


def test_fill_months(spark, rows):
    d = lambda m: date(2024, m, 1)
    spans = spark.createDataFrame(
        [("a", d(1), d(3)), ("b", d(5), d(5)), ("none", None, None), ("gap", d(6), d(6)), ("back", d(3), d(1))],
        "k string, x date, y date")
    calendar = spark.createDataFrame([(d(1),), (date(2023, 12, 1),), (d(3),), (d(5),), (d(2),), (d(2),), (None,)], "m date")
    got = rows(fill_months(spans, calendar, "x", "y", "m"), "k", "m")
    assert got == sorted([("a", d(1)), ("a", d(2)), ("a", d(3)), ("b", d(5)), ("none", None), ("gap", None), ("back", None)], key=str)


def test_month_spine_crosses_years(spark, rows):
    df = spark.createDataFrame([("a", date(2023, 12, 1)), ("a", date(2024, 2, 1)), ("b", date(2024, 1, 1))], "k string, m date")
    assert rows(month_spine(df, "k", "m")) == [
        ("a", date(2023, 12, 1)), ("a", date(2024, 1, 1)), ("a", date(2024, 2, 1)), ("b", date(2024, 1, 1))]


def test_tree_paths(spark, rows):
    nodes = spark.createDataFrame(
        [("7", None, "ROOT"), ("1", "7", "ab"), ("2", "1", "abcdefg"), ("9", "8", "orphan"), ("3", "7", None)],
        "code string, parent string, label string")
    tree = tree_paths(nodes, "code", "parent", "label", F.col("code") == "7")
    assert rows(tree, "code", "depth", "path") == [
        ("1", 2, "ROOT-000ab"), ("2", 3, "ROOT-000ab-abcde"), ("3", 2, None), ("7", 1, "ROOT")]


def test_tree_depth_costs_its_logarithm(spark, monkeypatch):
    """A chain of 5,000 nodes beside a loop that hangs on nothing: 14 rounds at most, all paths right."""
    from tributary.operators import tree

    rounds = []
    monkeypatch.setattr(tree, "kept_table", lambda df, name, keep=tree.kept_table: rounds.append(name) or keep(df, name))
    nodes = spark.range(5003).selectExpr(
        "id AS code", "CASE id WHEN 0 THEN NULL WHEN 5000 THEN 5002 WHEN 5001 THEN 5000 WHEN 5002 THEN 5001 ELSE id - 1 END AS parent", "'x' AS label", "'kept' AS other")
    paths = tree_paths(nodes, "code", "parent", "label", F.col("code") == 0, width=1)
    assert paths.columns == ["code", "parent", "label", "other", "depth", "path"]
    assert {(r.code, r.depth, r.path) for r in paths.collect()} == {(i, i + 1, "-".join("x" * (i + 1))) for i in range(5000)}
    assert rounds.count("tree") <= 14


def test_tree_paths_of_a_deep_tree_are_not_kept(spark, monkeypatch):
    """A chain of 6,000 nodes with labels that do not compress: its paths take 108 MB, what is kept a tenth of it at most."""
    from hashlib import md5
    from pathlib import Path

    from tributary.operators import tree

    paths = []
    monkeypatch.setattr(tree, "kept_table", lambda df, name, keep=tree.kept_table: paths.append(keep(df, name)) or paths[-1])
    names = [md5(str(i).encode()).hexdigest()[:5] for i in range(6000)]
    nodes = spark.createDataFrame([(i, i - 1, n) for i, n in enumerate(names)], "code long, parent int, label string")
    found = {r.code: (r.depth, r.path) for r in tree.tree_paths(nodes, "code", "parent", "label", F.col("code") == 0).collect()}
    assert found == {i: (i + 1, "-".join(names[: i + 1])) for i in range(6000)}
    assert sum(Path(f.removeprefix("file:")).stat().st_size for p in paths for f in p.inputFiles()) < 11_000_000


def test_tree_with_codes_on_several_rows(spark, monkeypatch):
    """Two ways into every hundredth node: a path for each, also where the node is an anchor."""
    up = {0: [None], **{i: [i - 1] + ([i - 3] if i % 100 == 50 else []) for i in range(1, 700)}}
    nodes = spark.createDataFrame([(i, p, str(i)) for i, ps in up.items() for p in ps], "code int, parent int, label string")
    expected = {0: ["0"]}
    for i in range(1, 700):
        expected[i] = [f"{path}-{i:05d}" for p in up[i] for path in expected[p]]
    got = tree_paths(nodes, "code", "parent", "label", F.col("code") == 0).select("code", "depth", "path").collect()
    assert sorted(map(tuple, got)) == sorted((i, p.count("-") + 1, p) for i, ps in expected.items() for p in ps)


def test_tree_cycle_is_reported(spark):
    rooted = spark.createDataFrame([("7", "1", "a"), ("1", "7", "b")], "code string, parent string, label string")
    assert tree_paths(rooted, "code", "parent", "label", F.col("code") == "7").count() == 2  # a root's parent is ignored
    nodes = rooted.union(spark.createDataFrame([("2", "1", "c"), ("1", "2", "d")], rooted.schema))
    with pytest.raises(ValueError, match="cycle"):
        tree_paths(nodes, "code", "parent", "label", F.col("code") == "7")


def test_snapshot_versions(spark, rows):
    ddl = "id int, k string, v string, note string"
    first = spark.createDataFrame(
        [(1, "a", "same", "n"), (2, "a", "old", "n"), (3, "a", "quiet", "n"), (4, "a", "gone", "n"), (5, "a", None, "n")], ddl)
    second = spark.createDataFrame(
        [(1, "a", "same", "n"), (2, "a", "new", "n"), (3, "a", "quiet", "changed"), (5, "a", "value", "n"), (6, "a", "added", "n")], ddl)
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    state = history.start_history(first, F.lit(t1))
    after = history.snapshot(state, second, ["id", "k"], ["v"], F.lit(t2))
    assert rows(after) == sorted([
        (1, "a", "same", "n", t1, None), (2, "a", "old", "n", t1, t2), (2, "a", "new", "n", t2, None),
        (3, "a", "quiet", "n", t1, None), (4, "a", "gone", "n", t1, None), (5, "a", None, "n", t1, t2),
        (5, "a", "value", "n", t2, None), (6, "a", "added", "n", t2, None)], key=str)
    open_versions = after.where("valid_to is null").groupBy("id", "k").count().where("count <> 1")
    assert open_versions.isEmpty()
    again = history.snapshot(after, second, ["id", "k"], ["v"], F.lit(datetime(2024, 3, 1)))
    assert rows(again) == rows(after)


def test_history_table_leaves_closed_versions_alone(spark, tmp_path, rows):
    from tributary.sources.catalog import create_history, read_table, update_history

    path = str(tmp_path / "h")
    state = lambda *data: spark.createDataFrame(list(data), "id int, v string")
    create_history(path, state((1, "a"), (2, "b")), ["id"], F.lit("2024-01-01"))
    update_history(spark, path, state((1, "x"), (2, "b")), ["id"], ["v"], F.lit("2024-02-01"))
    closed = tmp_path / "h" / "version=20240201T000000.000000"
    before = sorted(f.name for f in closed.iterdir())
    update_history(spark, path, state((1, "y"), (3, "c")), ["id"], ["v"], F.lit("2024-03-01"))
    update_history(spark, path, state((1, "y"), (3, "c")), ["id"], ["v"], F.lit("2024-03-01"))  # run again
    assert rows(read_table(spark, path), "id", "v", "version") == sorted([
        (1, "a", "20240201T000000.000000"), (1, "x", "20240301T000000.000000"), (1, "y", "open"), (2, "b", "open"), (3, "c", "open")], key=str)
    assert sorted(f.name for f in closed.iterdir()) == before


def test_quality_checks(spark, rows):
    a, b = spark.range(3), spark.range(4)
    assert rows(quality.row_count_match(a, b)) == [(3, 4)]
    assert quality.row_count_match(a, a).isEmpty()
    df = spark.createDataFrame([], "x int, m decimal(15,2)")
    assert rows(quality.type_check(df, "t", {"x": "date", "m": "decimal", "absent": "int"})) == [("t", "x", "date", "int")]


def test_keep_one_priority(spark, rows):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, 5), ("a", 1, 9), (None, 3, 1)], "k string, p int, v int")
    assert rows(keep_one(df, ["k"], F.col("p"), F.col("v").desc_nulls_last())) == [("a", 1, 9), (None, 3, 1)]


def test_cascade_hands_on_links_found_before_once(spark, rows):
    facts = spark.createDataFrame([("g1", "a", 1), ("g1", "b", 2), ("g2", "c", 3), (None, "a", 4)], "g string, k string, v int")
    entities = spark.createDataFrame([("a", "e1"), ("a", "e2"), ("x", "e3")], "key string, entity string")
    found = spark.createDataFrame([("e1", "g1", "a", 1), ("e9", "g1", "a", 1), ("e1", "g2", "c", 3), ("e1", None, "a", 4)], "entity string, g string, k string, v int")
    got = cascade(facts, [Pass(entities, "key", "k")], "entity", "g", found=found)
    assert rows(got, "entity", "v", "link_pass") == sorted([("e1", 1, 1), ("e2", 1, 1), ("e9", 1, 0), ("e1", 3, 0), ("e1", 4, 0)], key=str)
    shape = got._jdf.queryExecution().optimizedPlan().toString()
    assert shape.startswith("Union")  # links are not folded behind the joins


def test_cascade_offers_keys_in_one_shuffle(spark, rows):
    facts = spark.createDataFrame([("g1", "a", "x", 1), ("g1", "a", "x", 2), ("g2", "b", "y", 3), ("g3", "a", None, 4)], "g string, k string, l string, v int")
    first = spark.createDataFrame([("a", "e1")], "key string, entity string")
    second = spark.createDataFrame([("x", "e2"), ("y", "e3")], "key string, entity string")
    passes = [Pass(first, "key", "k"), Pass(second, "key", "l")]
    got = cascade(facts, passes, "entity", "g")
    assert rows(got, "entity", "v", "link_pass") == [("e1", 1, 1), ("e1", 2, 1), ("e1", 4, 1), ("e3", 3, 2)]
    shape = got._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[_group#\d+, _(pass|key)#\d+", shape)  # triples are not folded before the lookup of their keys
    left = spark.createDataFrame([("g2",), ("g3",)], "g string")
    got = cascade(facts, passes, "entity", "g", residue=left)
    assert rows(got, "entity", "v", "link_pass") == [("e1", 4, 1), ("e3", 3, 2)]
