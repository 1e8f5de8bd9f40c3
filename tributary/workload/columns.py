"""Column functions over the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import dates, money, text
from tributary.functions.sql import register
from tributary.plans.shape import clean
from tributary.workload.derived import br, day, iso, month, month_name, padded, year
from tributary.workload.query import query

PRICE = br("o_totalprice")
ACCOUNTING = (
    f"CASE o_orderkey % 6 WHEN 0 THEN '(' || {PRICE} || ')' WHEN 1 THEN '  ' WHEN 2 THEN 'NaN'"
    f" WHEN 3 THEN NULL WHEN 4 THEN '-' || {PRICE} ELSE {PRICE} END"
)


@query("""
    SELECT o_orderkey,
           CAST(CASE o_orderkey % 6 WHEN 0 THEN -o_totalprice WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 0
                WHEN 4 THEN -o_totalprice ELSE o_totalprice END AS DOUBLE) AS amount,
           o_totalprice AS plain_amount,
           CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS comma_amount
    FROM orders""")
def money_parse(t, spark):
    rendered = t.orders.select(
        "o_orderkey",
        F.expr(ACCOUNTING).alias("accounting"),
        F.expr(PRICE).alias("plain"),
        F.expr(
            "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a'"
            " ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), '.', ',') END"
        ).alias("comma"),
    )
    return rendered.select(
        "o_orderkey",
        money.parse_money("accounting").alias("amount"),
        money.plain_money("plain").alias("plain_amount"),
        money.comma_decimal("comma").alias("comma_amount"),
    )


@query("""
    SELECT CAST(CASE WHEN o_orderkey % 12 = 0 THEN make_date(CAST(year(o_orderdate) - 1 AS INT), 12, 1)
                ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS VARCHAR) AS month,
           CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END
                AS VARCHAR) AS compact_month,
           count(*) AS n
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)
    GROUP BY ALL""")
def month_label_parse(t, spark):
    labelled = t.orders.select(
        F.expr(
            f"CASE WHEN o_orderkey % 12 = 0 THEN '000/' || {year('o_orderdate')}"
            f" ELSE {month_name('o_orderdate')} || '/' || {year('o_orderdate')} END"
        ).alias("label"),
        F.expr(
            f"CASE WHEN o_orderkey % 5 = 0 THEN 'XYZ' || {year('o_orderdate')}"
            f" ELSE lower({month_name('o_orderdate')}) || {year('o_orderdate')} END"
        ).alias("compact"),
    )
    return labelled.groupBy(
        dates.parse_month_label("label").alias("month"),
        dates.parse_compact_month_label("compact").alias("compact_month"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS iso_date,
           CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS compact_date,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL
                ELSE CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) END AS month_date,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS slashed_date
    FROM orders""")
def guarded_dates(t, spark):
    d, m, y = day("o_orderdate"), month("o_orderdate"), year("o_orderdate")
    texts = t.orders.select(
        "o_orderkey",
        F.expr(f"CASE WHEN o_orderkey % 4 = 3 THEN {d} || '/' || {m} ELSE {iso('o_orderdate')} END").alias("a"),
        F.expr(f"CASE WHEN o_orderkey % 3 = 2 THEN '0' ELSE {d} || {m} || {y} END").alias("b"),
        F.expr(f"CASE WHEN o_orderkey % 7 = 0 THEN {y} || '13' ELSE {y} || {m} END").alias("c"),
        F.expr(f"{d} || '/' || {m} || '/' || {y}").alias("e"),
    )
    return texts.select(
        "o_orderkey",
        dates.guarded_iso("a").alias("iso_date"),
        dates.guarded_compact("b").alias("compact_date"),
        dates.month_start("c").alias("month_date"),
        dates.parsed("e", dates.DAY_FIRST).alias("slashed_date"),
    )


@query("""
    SELECT event_type, count(*) AS n,
           count(CASE WHEN event_id % 6 IN (0, 1, 2, 3, 4) THEN NULL ELSE 1 END) AS cleaned,
           count(CASE WHEN event_id % 6 IN (0, 1) THEN NULL ELSE 1 END) AS not_blank
    FROM events GROUP BY event_type""")
def sentinel_clean(t, spark):
    raw = t.events.select("event_type", F.expr(
        "CASE event_id % 6 WHEN 0 THEN '  ' WHEN 1 THEN NULL WHEN 2 THEN 'NaN' WHEN 3 THEN ' [null] '"
        " WHEN 4 THEN '00000000' ELSE event_type END").alias("raw"))
    return raw.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(text.sentinel_to_null("raw", "NaN", "[null]", "00000000")).alias("cleaned"),
        F.count(clean(F.col("raw"))).alias("not_blank"),
    )


@query("""
    SELECT s_suppkey,
           lpad(CAST(s_suppkey AS VARCHAR), 5, '0') || '123/2020-10' AS first_only,
           lpad(CAST(s_suppkey AS VARCHAR), 5, '0') || '123202010' AS all_of_them
    FROM supplier""")
def first_match_replace(t, spark):
    raw = t.supplier.select("s_suppkey", F.expr(f"{padded('s_suppkey', 5)} || '.123/2020-10'").alias("p"))
    return raw.select(
        "s_suppkey",
        text.strip_first("p", "./-").alias("first_only"),
        text.drop_chars("p", "./-").alias("all_of_them"),
    )


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL
                ELSE '2024NC' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') END AS found,
           CASE WHEN o_orderkey % 3 = 0 THEN ''
                ELSE '2024NC' || substr(lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0'), 1, 1) || '0'
                     || substr(lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0'), 3, 4) END AS canonical,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer
    FROM orders""")
def regex_mine(t, spark):
    described = t.orders.select("o_orderkey", F.expr(
        f"CASE WHEN o_orderkey % 3 = 0 THEN 'NOTA SEM NUMERO'"
        f" ELSE 'NOTA 2024NC' || {padded('o_orderkey % 1000000', 6)} || ' DO CLIENTE ' || o_custkey END"
    ).alias("d"))
    found = F.regexp_substr("d", F.lit("([0-9]{4}NC[0-9]+)"))
    return described.select(
        "o_orderkey",
        found.alias("found"),
        text.canonical_document(found).alias("canonical"),
        text.capture("d", "CLIENTE ([0-9]+)$").alias("customer"),
    )


@query("""
    SELECT c_custkey,
           coalesce(nullif(c_mktsegment, 'BUILDING'), '') || ' - ' || c_name AS skipping,
           nullif(c_mktsegment, 'BUILDING') || '-' || CAST(c_nationkey AS VARCHAR) AS strict,
           coalesce(nullif(c_mktsegment, 'BUILDING'), 'N/A') AS labelled,
           upper(left(c_name, 4)) || lower(right(c_name, 3)) AS ends,
           substr(lpad(c_name, 5, '0'), 1, 5) AS cut
    FROM customer""")
def null_safe_label(t, spark):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return t.customer.select(
        "c_custkey",
        text.join_text(segment, F.lit(" - "), "c_name").alias("skipping"),
        F.concat(segment, F.lit("-"), F.col("c_nationkey").cast("string")).alias("strict"),
        F.coalesce(segment, F.lit("N/A")).alias("labelled"),
        F.concat(F.upper(F.left("c_name", F.lit(4))), F.lower(F.right("c_name", F.lit(3)))).alias("ends"),
        F.lpad("c_name", 5, "0").alias("cut"),
    )


@query("""
    SELECT page_id, split_part(url, '/', -1) AS tail, split_part(url, '/', 3) AS host, length(url) AS n,
           regexp_replace(url, '[^0-9]', '', 'g') AS digits_only,
           regexp_replace(url, '[^0-9A-Za-z]', '', 'g') AS plain
    FROM pages""")
def path_strip(t, spark):
    return t.pages.select(
        "page_id",
        text.uri_tail("url").alias("tail"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
        F.length("url").alias("n"),
        text.digits("url").alias("digits_only"),
        text.alphanumerics("url").alias("plain"),
    )


@query("""
    WITH spans AS (
        SELECT CAST(l_shipdate AS DATE) AS shipped,
               CAST(o_orderdate AS DATE) - CAST((o_orderkey % 1200) AS INT) AS ordered
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT CAST(datepart('year', age(shipped, ordered)) AS INT) AS years,
           CAST(datepart('month', age(shipped, ordered)) AS INT) AS months,
           CAST(datepart('day', age(shipped, ordered)) AS INT) AS days,
           (shipped - ordered) >= 730 AS long_running,
           CAST(CAST(date_trunc('month', shipped) AS DATE) AS VARCHAR) AS shipped_month,
           count(*) AS n
    FROM spans GROUP BY ALL""")
def service_length(t, spark):
    spans = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.date_sub(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 1200).cast("int")).alias("ordered"),
    )
    aged = spans.select(
        dates.calendar_age("shipped", "ordered").alias("age"),
        (F.date_diff("shipped", "ordered") >= 730).alias("long_running"),
        F.trunc("shipped", "month").alias("shipped_month"),
    )
    return aged.groupBy(
        F.col("age.years").alias("years"), F.col("age.months").alias("months"),
        F.col("age.days").alias("days"), "long_running", "shipped_month",
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT CAST(json_extract(props, '$.k') AS INT) AS k, count(*) * 2 AS n,
           CAST(2 * sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS total
    FROM events WHERE event_id % 3 <> 0 GROUP BY 1""")
def json_explode(t, spark):
    listed = t.events.select("value", F.expr(
        "CASE WHEN event_id % 3 = 0 THEN '[]' ELSE replace('[' || props || ', ' || props || ']', chr(34), chr(39)) END"
    ).alias("items"))
    items = listed.select("value", F.explode(text.python_list("items", "k: int")).alias("i"))
    return items.groupBy(F.col("i.k").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).alias("total")
    )


@query("""
    WITH placed AS (
        SELECT year(l_shipdate) AS y, month(l_shipdate) AS m, CAST(l_extendedprice AS DECIMAL(15,2)) AS v FROM lineitem
        UNION ALL
        SELECT year(l_shipdate) - 1, 12, -CAST(l_extendedprice AS DECIMAL(15,2)) FROM lineitem WHERE l_returnflag = 'R')
    SELECT CAST(y AS INT) AS y, CAST(m AS INT) AS m, CAST(sum(v) AS DOUBLE) AS balance, count(*) AS n
    FROM placed GROUP BY y, m""")
def array_unnest_sign(t, spark):
    y, v = F.year("l_shipdate"), F.col("l_extendedprice").cast("decimal(15,2)")
    here = F.struct(y.alias("y"), F.month("l_shipdate").alias("m"), v.alias("v"))
    before = F.struct((y - 1).alias("y"), F.lit(12).alias("m"), (-v).cast("decimal(15,2)").alias("v"))
    placed = t.lineitem.select(
        F.explode(F.when(F.col("l_returnflag") == "R", F.array(before, here)).otherwise(F.array(here))).alias("p")
    ).select("p.*")
    return placed.groupBy("y", "m").agg(F.sum("v").alias("balance"), F.count(F.lit(1)).alias("n"))


@query("""
    SELECT o_orderkey,
           CAST(CASE WHEN o_orderkey % 12 = 0 THEN make_date(CAST(year(o_orderdate) - 1 AS INT), 12, 1)
                ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS VARCHAR) AS month,
           CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '2024NC0' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 5, '0') END AS note,
           CAST(CASE o_orderkey % 6 WHEN 0 THEN -o_totalprice WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 0
                WHEN 4 THEN -o_totalprice ELSE o_totalprice END AS DOUBLE) AS amount
    FROM orders""")
def sql_functions(t, spark):
    """The same functions called by name from SQL."""
    register(spark)
    raw = t.orders.select(
        "o_orderkey",
        F.expr(
            f"CASE WHEN o_orderkey % 12 = 0 THEN '000/' || {year('o_orderdate')}"
            f" ELSE {month_name('o_orderdate')} || '/' || {year('o_orderdate')} END"
        ).alias("label"),
        F.expr(f"CASE WHEN o_orderkey % 7 <> 0 THEN '2024NC00' || {padded('o_orderkey % 10000', 4)} END").alias("number"),
        F.expr(ACCOUNTING).alias("value"),
    )
    return spark.sql(
        "SELECT o_orderkey, parse_date(label) AS month, format_nc(number) AS note,"
        " parse_financial_value(value) AS amount FROM {raw}", raw=raw)
