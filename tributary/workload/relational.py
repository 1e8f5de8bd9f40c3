"""Filters, joins, aggregates, windows and set operations over the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators.joins import group_value, not_in, origin_flag, unique_groups
from tributary.operators.keyed import keep_one
from tributary.operators.linkage import Pass, cascade
from tributary.operators.months import month_spine
from tributary.operators.ordinals import match_nth, number_within, rank_within
from tributary.operators.quality import row_count_match, type_check
from tributary.operators.tree import tree_paths
from tributary.workload.query import query


def _money(column: str):
    return F.col(column).cast("decimal(15,2)")


@query("""
    SELECT coalesce(nullif(c_mktsegment, 'MACHINERY'), 'N/A') AS segment, coalesce(n_name, 'N/A') AS nation,
           count(DISTINCT c_custkey) AS customers
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey
    GROUP BY 1, 2""")
def headcount_summary(t, spark):
    known = t.nation.where("n_regionkey <> 2")
    people = t.customer.join(known, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return people.groupBy(
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")), F.lit("N/A")).alias("segment"),
        F.coalesce("n_name", F.lit("N/A")).alias("nation"),
    ).agg(F.count_distinct("c_custkey").alias("customers"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_quantity > 25 THEN 'big' WHEN l_quantity > 10 THEN 'mid' ELSE 'small' END AS size_class,
           'fixed' AS origin, CAST(NULL AS VARCHAR) AS placeholder
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '%MEDIUM%') AND l_returnflag IN ('A', 'R')
      AND l_linenumber NOT IN (2, 5) AND l_linestatus <> 'X' AND o_orderstatus IS NOT NULL
      AND regexp_matches(o_orderpriority, '^[0-9]-')""")
def filters_mix(t, spark):
    priority = F.col("o_orderpriority")
    kept = t.orders.where(
        (priority.startswith("1") | priority.contains("MEDIUM"))
        & priority.rlike("^[0-9]-") & F.col("o_orderstatus").isNotNull()
    )
    lines = t.lineitem.where(
        F.col("l_returnflag").isin("A", "R") & ~F.col("l_linenumber").isin(2, 5) & (F.col("l_linestatus") != "X")
    )
    q = F.col("l_quantity")
    return lines.join(kept, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(q > 25, "big").when(q > 10, "mid").otherwise("small").alias("size_class"),
        F.lit("fixed").alias("origin"), F.lit(None).cast("string").alias("placeholder"),
    )


@query("""
    SELECT l_orderkey, min(l_returnflag) AS l_returnflag
    FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)
    GROUP BY l_orderkey HAVING count(*) = 1""")
def unique_group_having(t, spark):
    pairs = t.lineitem.select("l_orderkey", "l_returnflag").distinct()
    return unique_groups(pairs, "l_orderkey")


@query("""
    SELECT o_orderkey, o_custkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS total
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderkey % 100 = l_partkey % 100
    GROUP BY 1, 2""")
def inner_using(t, spark):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), (F.col("l_partkey") % 100).alias("slot"),
        _money("l_extendedprice").alias("v"),
    )
    orders = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 100).alias("slot"))
    return orders.join(lines, ["o_orderkey", "slot"]).groupBy("o_orderkey", "o_custkey").agg(F.sum("v").alias("total"))


@query("""
    SELECT o_orderkey, c_name, n_name, r_name
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey""")
def left_star(t, spark):
    customers = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_nationkey")
    regions = t.region.where("r_name <> 'ASIA'")
    return (
        t.orders.select("o_orderkey", "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query("""
    SELECT c_custkey, c_name, count(o_orderkey) AS orders
    FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') RIGHT JOIN customer ON o_custkey = c_custkey
    GROUP BY 1, 2""")
def right_residue(t, spark):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return urgent.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "right").groupBy(
        "c_custkey", "c_name"
    ).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))


@query("""
    WITH ordered AS (
        SELECT o_custkey AS custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
               sum(CAST(o_totalprice AS DECIMAL(15,2))) AS ordered FROM orders GROUP BY 1, 2),
    shipped AS (
        SELECT o_custkey AS custkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
               sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS shipped
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT custkey, CAST(month AS VARCHAR) AS month, CAST(ordered AS DOUBLE) AS ordered,
           CAST(shipped AS DOUBLE) AS shipped,
           CASE WHEN ordered IS NOT NULL AND shipped IS NOT NULL THEN 'both'
                WHEN ordered IS NOT NULL THEN 'left only' ELSE 'right only' END AS origin
    FROM ordered FULL JOIN shipped USING (custkey, month)""")
def full_outer_months(t, spark):
    ordered = t.orders.groupBy(
        F.col("o_custkey").alias("custkey"), F.trunc("o_orderdate", "month").alias("month")
    ).agg(F.sum(_money("o_totalprice")).alias("ordered"))
    shipped = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.col("o_custkey").alias("custkey"), F.trunc("l_shipdate", "month").alias("month")
    ).agg(F.sum(_money("l_extendedprice")).alias("shipped"))
    return ordered.join(shipped, ["custkey", "month"], "full").withColumn(
        "origin", origin_flag(F.col("ordered"), F.col("shipped"), "both", "left only", "right only")
    )


@query("""
    WITH o AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
    spans AS (SELECT o_custkey, min(month) AS a, max(month) AS b FROM o GROUP BY 1),
    months AS (SELECT DISTINCT month FROM o)
    SELECT o_custkey, CAST(month AS VARCHAR) AS month FROM spans LEFT JOIN months ON month BETWEEN a AND b""")
def month_spine_per_customer(t, spark):
    monthly = t.orders.select("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
    return month_spine(monthly, "o_custkey", "month")


@query("""
    SELECT p_partkey, p_name, p_size FROM part
    WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)""")
def semi_join(t, spark):
    wanted = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 40").select("l_partkey").distinct()
    return t.part.join(wanted, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select(
        "p_partkey", "p_name", "p_size"
    )


@query("""
    SELECT 'known' AS list, c_custkey FROM (SELECT nullif(c_custkey, 0) AS c_custkey FROM customer)
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH')
    UNION ALL
    SELECT 'with null', c_custkey FROM customer
    WHERE c_custkey NOT IN (SELECT nullif(o_custkey, (SELECT min(o_custkey) FROM orders)) FROM orders)
    UNION ALL
    SELECT 'empty', c_custkey FROM (SELECT nullif(c_custkey, 0) AS c_custkey FROM customer)
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = 'none')""")
def anti_null_aware(t, spark):
    customers = t.customer.select(F.nullif(F.col("c_custkey"), F.lit(0)).alias("c_custkey"))
    high = t.orders.where("o_orderpriority = '2-HIGH'")
    lowest = t.orders.agg(F.min("o_custkey")).scalar()
    holed = t.orders.select(F.nullif(F.col("o_custkey"), lowest).alias("o_custkey"))
    nothing = t.orders.where("o_orderpriority = 'none'")

    def left_over(name, frame, listed):
        return not_in(frame, "c_custkey", listed, "o_custkey").select(F.lit(name).alias("list"), "c_custkey")

    return (
        left_over("known", customers, high)
        .union(left_over("with null", t.customer.select("c_custkey"), holed))
        .union(left_over("empty", customers, nothing))
    )


URGENT_FREE = """
    SELECT c_custkey, c_nationkey FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')"""


@query(URGENT_FREE)
def anti_not_exists(t, spark):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    return t.customer.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(
        "c_custkey", "c_nationkey"
    )


@query("""
    SELECT DISTINCT c_custkey, c_nationkey, o.k IS NULL AS without_urgent, s.k IS NULL AS without_supplier
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT') o ON c_custkey = o.k
    LEFT JOIN (SELECT s_suppkey AS k FROM supplier) s ON c_custkey = s.k
    WHERE o.k IS NULL OR s.k IS NULL""")
def anti_outer(t, spark):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k1")).distinct()
    suppliers = t.supplier.select(F.col("s_suppkey").alias("k2")).distinct()
    joined = t.customer.join(urgent, F.col("c_custkey") == F.col("k1"), "left").join(
        suppliers, F.col("c_custkey") == F.col("k2"), "left"
    )
    return joined.where("k1 is null or k2 is null").select(
        "c_custkey", "c_nationkey",
        F.col("k1").isNull().alias("without_urgent"), F.col("k2").isNull().alias("without_supplier"),
    )


@query("""
    WITH RECURSIVE edges AS (
        SELECT 'root' AS code, CAST(NULL AS VARCHAR) AS parent, 'WORLD' AS label
        UNION ALL SELECT 'r' || r_regionkey, 'root', r_name FROM region
        UNION ALL SELECT 'n' || n_nationkey, CASE WHEN n_nationkey % 7 = 6 THEN 'gone' ELSE 'r' || n_regionkey END, n_name FROM nation
        UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, CAST(c_custkey AS VARCHAR) FROM customer),
    tree AS (
        SELECT code, parent, label, 1 AS depth, label AS path FROM edges WHERE code = 'root'
        UNION ALL
        SELECT e.code, e.parent, e.label, t.depth + 1, t.path || '-' || lpad(e.label, 5, '0')
        FROM edges e JOIN tree t ON e.parent = t.code)
    SELECT code, parent, label, depth, path FROM tree""")
def tree_descent(t, spark):
    root = t.region.where("r_regionkey = 0").selectExpr("'root' AS code", "CAST(NULL AS STRING) AS parent", "'WORLD' AS label")
    regions = t.region.selectExpr("'r' || r_regionkey AS code", "'root' AS parent", "r_name AS label")
    nations = t.nation.selectExpr(
        "'n' || n_nationkey AS code",
        "CASE WHEN n_nationkey % 7 = 6 THEN 'gone' ELSE 'r' || n_regionkey END AS parent", "n_name AS label")
    customers = t.customer.selectExpr(
        "'c' || c_custkey AS code", "'n' || c_nationkey AS parent", "CAST(c_custkey AS STRING) AS label")
    edges = root.union(regions).union(nations).union(customers)
    return tree_paths(edges, "code", "parent", "label", F.col("code") == "root")


@query("""
    WITH RECURSIVE chain(code, depth, path) AS (
        SELECT c_custkey, 1, c_custkey::VARCHAR FROM customer WHERE c_custkey < 5
        UNION ALL
        SELECT c_custkey, depth + 1, path || '-' || left(lpad(c_custkey::VARCHAR, 5, '0'), 5) FROM chain JOIN customer ON c_custkey = code + 5)
    SELECT code, depth, length(path) AS length, md5(path) AS path_md5 FROM chain""")
def tree_chains(t, spark):
    """All customers in five chains, each below the one five numbers before: as deep as a fifth of the table."""
    nodes = t.customer.select(F.col("c_custkey").alias("code"), (F.col("c_custkey") - 5).alias("parent"), F.col("c_custkey").cast("string").alias("label"))
    paths = tree_paths(nodes, "code", "parent", "label", F.col("code") < 5)
    return paths.select("code", "depth", F.length("path").alias("length"), F.md5(F.col("path").cast("binary")).alias("path_md5"))


@query("""
    WITH c AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer),
    s AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k FROM supplier)
    SELECT c_custkey, s_suppkey, coalesce(c_nationkey, s_nationkey) AS nationkey, coalesce(c.k, s.k) AS k
    FROM c FULL JOIN s ON c_nationkey = s_nationkey AND c.k = s.k""")
def occurrence_match(t, spark):
    joined = match_nth(
        t.customer.select("c_custkey", "c_nationkey"), t.supplier.select("s_suppkey", "s_nationkey"),
        [("c_nationkey", "s_nationkey")], ["c_custkey"], ["s_suppkey"],
    )
    return joined.select(
        "c_custkey", "s_suppkey",
        F.coalesce("c_nationkey", "s_nationkey").alias("nationkey"),
        F.coalesce("ordinal_left", "ordinal_right").alias("k"),
    )


@query("""
    SELECT o_orderkey, o_custkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ordinal
    FROM orders""")
def occurrence_number(t, spark):
    return number_within(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"],
    ).drop("o_orderdate")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           rank() OVER (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE)) AS rank
    FROM lineitem""")
def rank_in_group(t, spark):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("d"))
    return rank_within(lines, ["l_suppkey"], "d").drop("l_suppkey", "d")


@query("""
    WITH facts AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
               l_orderkey * 10000 + l_partkey AS pair FROM lineitem),
    c1 AS (SELECT DISTINCT o_orderkey AS entity, o_orderkey * 10000 + o_custkey AS key FROM orders),
    c2 AS (SELECT min(p_partkey) AS entity, min(p_partkey) AS key FROM part GROUP BY p_retailprice, p_size HAVING count(*) = 1),
    c3 AS (SELECT s_suppkey AS entity, s_suppkey AS key FROM supplier WHERE s_nationkey < 12),
    r1 AS (SELECT entity, facts.*, 1 AS link_pass FROM facts JOIN c1 ON pair = key),
    f2 AS (SELECT * FROM facts WHERE l_orderkey NOT IN (SELECT l_orderkey FROM r1)),
    r2 AS (SELECT entity, f2.*, 2 AS link_pass FROM f2 JOIN c2 ON l_partkey = key AND l_quantity < 10),
    f3 AS (SELECT * FROM f2 WHERE l_orderkey NOT IN (SELECT l_orderkey FROM r2)),
    r3 AS (SELECT entity, f3.*, 3 AS link_pass FROM f3 JOIN c3 ON l_suppkey = key)
    SELECT entity, l_orderkey, l_linenumber, l_partkey, l_suppkey, link_pass
    FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3)""")
def cascade_link(t, spark):
    facts = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_orderkey") * 10000 + F.col("l_partkey")).alias("pair"),
        F.when(F.col("l_quantity") < 10, F.col("l_partkey")).alias("small_part"),
    )
    by_pair = t.orders.select(
        F.col("o_orderkey").alias("entity"), (F.col("o_orderkey") * 10000 + F.col("o_custkey")).alias("key"))
    single = t.part.groupBy("p_retailprice", "p_size").agg(
        F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("entity")).where("n = 1")
    by_part = single.select("entity", F.col("entity").alias("key"))
    by_supplier = t.supplier.where("s_nationkey < 12").select(
        F.col("s_suppkey").alias("entity"), F.col("s_suppkey").alias("key"))
    linked = cascade(
        facts,
        [Pass(by_pair, "key", "pair"), Pass(by_part, "key", "small_part"), Pass(by_supplier, "key", "l_suppkey")],
        "entity", "l_orderkey",
    )
    return linked.drop("pair", "small_part")


@query("""
    SELECT a.n_name, b.n_name AS parent_name
    FROM nation a LEFT JOIN nation b ON CAST(floor(a.n_nationkey / 5) AS INT) = b.n_nationkey AND a.n_nationkey > 4""")
def self_lookup(t, spark):
    above = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("parent_name"))
    parent = F.floor(F.col("n_nationkey") / 5)
    return t.nation.join(above, (parent == F.col("k")) & (F.col("n_nationkey") > 4), "left").select("n_name", "parent_name")


@query("""
    WITH l AS (SELECT l_suppkey, l_returnflag, CAST(l_extendedprice AS DECIMAL(15,2)) AS v,
                      CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS DECIMAL(15,2)) END AS q,
                      CASE WHEN l_linestatus = 'F' THEN -CAST(l_extendedprice AS DECIMAL(15,2))
                           ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS signed
               FROM lineitem)
    SELECT l_suppkey, CAST(sum(v) AS DOUBLE) AS total,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN v ELSE 0 END) AS DOUBLE) AS returned,
           CAST(sum(v + q) AS DOUBLE) AS row_sum,
           CAST(sum(CASE WHEN signed > 0 THEN signed ELSE 0 END) AS DOUBLE) AS positive,
           CAST(sum(CASE WHEN signed < 0 THEN -signed ELSE 0 END) AS DOUBLE) AS negative,
           count(*) AS n
    FROM l GROUP BY l_suppkey""")
def sums_conditional(t, spark):
    v, q = _money("l_extendedprice"), F.when(F.col("l_linenumber") != 7, _money("l_quantity"))
    signed = F.when(F.col("l_linestatus") == "F", -v).otherwise(v)
    return t.lineitem.groupBy("l_suppkey").agg(
        F.sum(v).alias("total"),
        F.sum(F.when(F.col("l_returnflag") == "R", v).otherwise(0)).alias("returned"),
        F.sum(v + q).alias("row_sum"),
        F.sum(F.greatest(signed, F.lit(0))).alias("positive"),
        F.sum(F.greatest(-signed, F.lit(0))).alias("negative"),
        F.count(F.lit(1)).alias("n"),
    )


@query("""
    SELECT 'differ' AS check_name, (SELECT count(*) FROM orders) AS source_row_count,
           (SELECT count(*) FROM lineitem) AS target_row_count""")
def counts_scalar(t, spark):
    differ = row_count_match(t.orders, t.lineitem).select(F.lit("differ").alias("check_name"), "*")
    same = row_count_match(t.orders, t.orders).select(F.lit("same").alias("check_name"), "*")
    return differ.union(same)


@query("""
    SELECT 'orders' AS table_name, column_name, expected_type, actual_type
    FROM (SELECT * FROM orders LIMIT 0) o
    RIGHT JOIN (VALUES ('o_custkey', 'int', 'bigint'), ('o_orderdate', 'date', 'timestamp_ntz'))
         AS v(column_name, expected_type, actual_type) ON false""")
def type_check_orders(t, spark):
    return type_check(t.orders, "orders", {
        "o_orderkey": "bigint", "o_custkey": "int", "o_totalprice": "double", "o_orderdate": "date",
        "not_a_column": "string",
    })


@query("""
    SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, event_type
    FROM events
    QUALIFY row_number() OVER (
        PARTITION BY user_id, CAST(ts AS DATE)
        ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END, ts DESC, event_id) = 1""")
def top1_priority(t, spark):
    kind = F.col("event_type")
    daily = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_id", "event_type", "ts")
    priority = F.when(kind == "purchase", 1).when(kind == "signup", 2).otherwise(3)
    return keep_one(daily, ["user_id", "day"], priority, F.col("ts").desc(), F.col("event_id")).drop("ts")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(CAST(min(l_shipdate) OVER (PARTITION BY l_orderkey) AS DATE) AS VARCHAR) AS first_ship
    FROM lineitem""")
def window_min(t, spark):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("d"))
    return group_value(lines, "l_orderkey", F.min("d"), "first_ship").drop("d")


@query("""
    SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders WHERE o_orderstatus = 'F'
    UNION
    SELECT o_custkey, nullif(o_orderpriority, '5-LOW') FROM orders WHERE o_totalprice > 200000""")
def union_distinct(t, spark):
    p = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p")
    a = t.orders.where("o_orderstatus = 'F'").select("o_custkey", p)
    b = t.orders.where("o_totalprice > 200000").select("o_custkey", p)
    return a.union(b).distinct()


@query("""
    SELECT o_orderkey, 'a' AS part FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, 'b' FROM orders WHERE o_totalprice > 200000""")
def union_all(t, spark):
    a = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("a").alias("part"))
    b = t.orders.where("o_totalprice > 200000").select("o_orderkey", F.lit("b").alias("part"))
    return a.unionByName(b)


@query("""
    SELECT o_custkey, min(o_orderpriority) AS first_priority, max(o_orderpriority) AS last_priority,
           CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_day
    FROM orders GROUP BY o_custkey ORDER BY o_custkey""")
def min_max_group(t, spark):
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderpriority").alias("first_priority"), F.max("o_orderpriority").alias("last_priority"),
        F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"),
    ).orderBy("o_custkey")
