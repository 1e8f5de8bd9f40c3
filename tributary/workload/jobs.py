"""Landing, keyed writes, history and streaming, on inputs derived from the provided tables.

Jobs that need files or a stream write them first, below the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import money
from tributary.operators.history import snapshot, start_history
from tributary.operators.keyed import NULL_KEY, add_missing_columns, append_evolving, drop_copies, merge_rows, upsert, upsert_sifted
from tributary.session import fresh_folder
from tributary.sources import landing, reports, soap, worklists
from tributary.sources.catalog import (
    EXTRACT_COLUMNS, create_history, land_batch, merge_table, publish_view, read_landing, read_table, update_history, upsert_table, write_table,
)
from tributary.streaming.landing import compact_landed, land_increment, read_landed, read_refused
from tributary.workload.derived import br, day, iso, month, padded, year
from tributary.workload.query import query


@query("""
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 7 = 3 THEN 'second' WHEN o_orderkey % 3 = 0 THEN 'first' ELSE o_orderstatus END AS status,
           CAST(CASE WHEN o_orderkey % 7 = 3 THEN 2 * o_totalprice ELSE o_totalprice END AS DOUBLE) AS price,
           o_orderpriority AS carried
    FROM orders""")
def upsert_latest(t, spark):
    current = t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.lit("2024-01-01").alias("dt_ingest"), F.col("o_orderpriority").alias("carried"))

    def batch(kept, status, factor, at):
        return t.orders.where(kept).select(
            "o_orderkey", "o_custkey", F.lit(status).alias("status"),
            (F.col("o_totalprice") * factor).alias("price"), F.lit(at).alias("dt_ingest"))

    first = batch("o_orderkey % 3 = 0", "first", 1, "2024-01-02")
    second = batch("o_orderkey % 7 = 3", "stale", 5, "2024-01-03").union(
        batch("o_orderkey % 7 = 3", "second", 2, "2024-01-04"))
    without_key = batch("o_orderkey % 50 = 0", "no key", 1, "2024-01-05").withColumn("o_orderkey", F.lit(None).cast("long"))
    after_first = upsert(current, first, ["o_orderkey"], "dt_ingest")
    return upsert(after_first, second.union(without_key), ["o_orderkey"], "dt_ingest").drop("dt_ingest")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 50 <> 0 THEN 'new' ELSE o_orderstatus END AS status, NULL AS refused_because, NULL AS counted FROM orders
    UNION ALL SELECT NULL, o_orderstatus || o_orderkey, 'null in the key', NULL FROM orders WHERE o_orderkey % 150 = 0
    UNION ALL SELECT NULL, NULL, 'null in the key', count(*) FROM orders WHERE o_orderkey % 150 = 0""")
def upsert_refused(t, spark):
    """A batch with keyless rows: what the table takes, what it refuses and how many, from one pass over the batch."""
    current = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    keyless = F.col("o_orderkey") % 50 == 0
    batch = t.orders.where("o_orderkey % 3 = 0").select(
        F.when(~keyless, F.col("o_orderkey")).alias("o_orderkey"),
        F.when(keyless, F.concat("o_orderstatus", F.col("o_orderkey").cast("string"))).otherwise("new").alias("status"))
    after, sifted = upsert_sifted(current, batch, ["o_orderkey"])
    count = spark.range(1).select(F.lit(NULL_KEY).alias("refused_because"), F.lit(sifted.counts[NULL_KEY]).cast("long").alias("counted"))
    return after.unionByName(sifted.refused, allowMissingColumns=True).unionByName(count, allowMissingColumns=True)


@query("""
    WITH target AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS p, 'old' AS state FROM orders),
    batch AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS p, 'new' AS state
              FROM orders WHERE o_orderkey % 4 = 0)
    SELECT target.* FROM target LEFT JOIN batch b ON target.o_orderkey = b.o_orderkey AND target.p = b.p WHERE b.state IS NULL
    UNION ALL SELECT * FROM batch""")
def merge_null_keys(t, spark):
    keyed = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("p"))
    target = keyed.withColumn("state", F.lit("old"))
    batch = keyed.where("o_orderkey % 4 = 0").withColumn("state", F.lit("new"))
    return merge_rows(target, batch, ["o_orderkey", "p"])


@query("""
    WITH target AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS p, o_orderstatus AS state FROM orders),
    batch AS (SELECT o_orderkey, p, CASE WHEN o_orderkey < 40 THEN 'new' ELSE state END AS state FROM target)
    SELECT *, CAST(NULL AS BOOLEAN) AS rewritten FROM batch
    UNION ALL SELECT *, NULL FROM target WHERE p IS NULL
    UNION ALL SELECT NULL, NULL, 'buckets', (SELECT count(*) > 0 FROM batch WHERE state = 'new')""")
def merge_changed(t, spark):
    """The whole source comes again with forty rows changed: the merged table, and whether buckets were rewritten, fewer than all."""
    path = fresh_folder(spark, "merged")
    rows = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("p"), F.col("o_orderstatus").alias("state"))
    merge_table(spark, path, rows, ["o_orderkey", "p"], buckets=64)
    changed = F.when(F.col("o_orderkey") < 40, "new").otherwise(F.col("state"))
    touched = merge_table(spark, path, rows.withColumn("state", changed), ["o_orderkey", "p"], buckets=64)
    note = spark.range(1).select(F.lit("buckets").alias("state"), F.lit(0 < len(touched) < 64).alias("rewritten"))
    return read_landing(spark, path).unionByName(note, allowMissingColumns=True)


@query("""
    SELECT event_type, user_id, CAST(value AS DOUBLE) AS value, min(batch) AS dt_ingest
    FROM (SELECT *, '2024-02-01' AS batch FROM events UNION ALL SELECT *, '2024-02-02' AS batch FROM events)
    GROUP BY ALL""")
def dedupe_business_key(t, spark):
    events = t.events.select("event_type", "user_id", "value")
    twice = events.withColumn("dt_ingest", F.lit("2024-02-02")).union(events.withColumn("dt_ingest", F.lit("2024-02-01")))
    return drop_copies(twice, ["event_type", "user_id", "value"], "dt_ingest")


@query("""
    SELECT emissao, nc, nc_valor, parcel, min(batch) AS since, count(*) > 1 AS came_again FROM (
        SELECT CAST(year(o_orderdate) AS VARCHAR) AS emissao, 'NC' || o_custkey AS nc,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS nc_valor, o_orderkey % 3 = 0 AS parcel, b.batch
        FROM orders, (VALUES (1, '2024-01-01'), (2, '2024-01-02'), (3, '2024-01-03')) AS b(i, batch)
        WHERE o_orderkey % 4 + 1 = b.i OR o_orderkey % 4 = 3 AND b.i > 1) GROUP BY ALL""")
def extract_batches(t, spark):
    """Sent and received extracts as one batch; three batches that overlap, landed one after the other."""
    path = fresh_folder(spark, "extracts")
    names = EXTRACT_COLUMNS["nc_tesouro"]
    year, note = F.year("o_orderdate").cast("string"), F.concat(F.lit("NC"), F.col("o_custkey").cast("string"))
    for i in (1, 2, 3):
        rows = t.orders.where((F.col("o_orderkey") % 4 + 1 == i) | ((F.col("o_orderkey") % 4 == 3) & F.lit(i > 1)))
        base = [year.alias(names[0]), note.alias(names[1]), (F.col("o_orderkey") % 3 == 0).cast("string").alias(names[3])]
        sent = rows.where("o_orderkey % 2 = 0").select(*base)
        received = rows.where("o_orderkey % 2 = 1").select(F.col("o_orderpriority").alias(names[2]), *base)
        batch = add_missing_columns(reports.combine(sent, received), names).withColumn("dt_ingest", F.lit(f"2024-01-0{i}"))
        land_batch(spark, path, "nc_tesouro", batch)
        whole = batch if i == 1 else whole.unionByName(batch)
    again = whole.groupBy(names[:4]).agg((F.count(F.lit(1)) > 1).alias("came_again")).select(F.struct(*names[:4]).alias("k"), "came_again")
    landed = read_landing(spark, path).withColumn("key", F.struct(*names[:4]))
    return landed.join(again, F.col("key") == F.col("k")).select(
        F.col(names[0]).alias("emissao"), F.col(names[1]).alias("nc"), F.col(names[2]).alias("nc_valor"),
        F.col(names[3]).cast("boolean").alias("parcel"), F.col("dt_ingest").alias("since"), "came_again")


@query("""
    WITH b(i) AS (VALUES (1), (2), (3)),
    people AS (SELECT o_orderkey, o_custkey, i FROM orders, b WHERE o_custkey % 4 + 1 >= i)
    SELECT 'contratos' AS table_name, CAST(o_orderkey AS VARCHAR) AS key, 'v' || max(i) AS v FROM orders, b WHERE i = 1 OR o_orderkey % (i * 5) = 0 GROUP BY o_orderkey
    UNION ALL
    SELECT 'dados_financeiros', CAST(o_custkey AS VARCHAR), 'v' || i || '-' || o_orderkey FROM people
    QUALIFY i = max(i) OVER (PARTITION BY o_custkey)
    UNION ALL
    SELECT 'afastamento_historico', CAST(o_orderkey AS VARCHAR), 'v' || i FROM orders, b WHERE o_orderkey % i = 0
    UNION ALL
    SELECT 'cronograma', CAST(o_orderkey AS VARCHAR), 'v3' FROM orders WHERE o_orderkey % 3 = 0""")
def landed_batches(t, spark):
    """Three batches each into a table that is upserted, replaced by person, appended to, refreshed."""
    paths = {n: fresh_folder(spark, n) for n in ("contratos", "dados_financeiros", "afastamento_historico", "cronograma")}
    key = F.col("o_orderkey").cast("string")
    for i in (1, 2, 3):
        value = F.lit(f"v{i}")
        land_batch(spark, paths["contratos"], "contratos", t.orders.where(F.lit(i == 1) | (F.col("o_orderkey") % (i * 5) == 0)).select(key.alias("id"), value.alias("v")))
        person = t.orders.where(F.col("o_custkey") % 4 + 1 >= i).select(F.col("o_custkey").cast("string").alias("cpf"), F.concat(value, F.lit("-"), key).alias("v"))
        land_batch(spark, paths["dados_financeiros"], "dados_financeiros", person)
        some = t.orders.where(F.col("o_orderkey") % i == 0).select(key.alias("id"), value.alias("v"))
        land_batch(spark, paths["afastamento_historico"], "afastamento_historico", some)
        land_batch(spark, paths["cronograma"], "cronograma", some)
    parts = [
        read_landing(spark, path).select(F.lit(name).alias("table_name"), F.col("cpf" if name == "dados_financeiros" else "id").alias("key"), "v")
        for name, path in paths.items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("""
    SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS note, 'sent' AS extract FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL
    SELECT o_orderkey, NULL, o_orderpriority, 'received' FROM orders WHERE o_orderkey % 2 = 1""")
def evolve_columns(t, spark):
    sent = t.orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", F.lit("sent").alias("extract"))
    received = t.orders.where("o_orderkey % 2 = 1").select(
        "o_orderkey", F.col("o_orderpriority").alias("note"), F.lit("received").alias("extract"))
    return append_evolving(sent, received)


@query("""
    WITH s AS (
        SELECT o_orderkey AS id, o_custkey AS part, o_orderkey % 5 = 1 AS changed, o_orderkey % 7 = 0 AS gone,
               o_orderkey % 11 = 0 AS added, nullif(o_orderstatus, 'P') AS status, o_orderpriority AS note FROM orders)
    SELECT id, part, status, note, '2024-01-01' AS since,
           CASE WHEN changed AND NOT gone THEN '2024-02-01' END AS until FROM s WHERE NOT added
    UNION ALL
    SELECT id, part, coalesce(status, 'new') || '!', note || '!', '2024-02-01', NULL
    FROM s WHERE NOT added AND changed AND NOT gone
    UNION ALL
    SELECT id, part, CASE WHEN changed THEN coalesce(status, 'new') || '!' ELSE status END, note || '!', '2024-02-01', NULL
    FROM s WHERE added AND NOT gone""")
def snapshot_scd2(t, spark):
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("part"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), F.col("o_orderpriority").alias("note"))
    changed = F.col("id") % 5 == 1
    later = rows.where("id % 7 <> 0").select(
        "id", "part",
        F.when(changed, F.concat(F.coalesce("status", F.lit("new")), F.lit("!"))).otherwise(F.col("status")).alias("status"),
        F.concat("note", F.lit("!")).alias("note"))
    history = start_history(rows.where("id % 11 <> 0"), F.lit("2024-01-01"))
    after = snapshot(history, later, ["id", "part"], ["status"], F.lit("2024-02-01"))
    return after.select(
        "id", "part", "status", "note",
        F.date_format("valid_from", "yyyy-MM-dd").alias("since"), F.date_format("valid_to", "yyyy-MM-dd").alias("until"))


@query("""
    SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 5 = 1 THEN '2024-02-01' END AS until, '2024-01-01' AS since FROM orders
    UNION ALL
    SELECT o_orderkey, o_orderstatus || '!', CASE WHEN o_orderkey % 35 = 1 THEN '2024-03-01' END, '2024-02-01' FROM orders WHERE o_orderkey % 5 = 1
    UNION ALL
    SELECT o_orderkey, o_orderstatus || '?', NULL, '2024-03-01' FROM orders WHERE o_orderkey % 35 = 1""")
def history_table(t, spark):
    """Three states of a history kept on disk; closed versions are not rewritten."""
    path = fresh_folder(spark, "history")
    first = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))

    def marked(df, every, mark):
        changed = F.col("id") % every == 1
        return df.withColumn("status", F.when(changed, F.concat(first_letter, F.lit(mark))).otherwise(F.col("status")))

    first_letter = F.left("status", F.lit(1))
    second = marked(first, 5, "!")
    create_history(path, first, ["id"], F.lit("2024-01-01"))
    update_history(spark, path, second, ["id"], ["status"], F.lit("2024-02-01"))
    update_history(spark, path, marked(second, 35, "?"), ["id"], ["status"], F.lit("2024-03-01"))
    return read_table(spark, path).select(
        "id", "status", F.date_format("valid_to", "yyyy-MM-dd").alias("until"),
        F.date_format("valid_from", "yyyy-MM-dd").alias("since"))


# ------------------------------------------------------------------ landing


NESTED_ORDERS = (
    "id long, Detalhe struct<Cliente: struct<Codigo: long, Nome: string>, Valor: double>, Ativo boolean,"
    " itens array<struct<n: int>>"
)


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS detalhe__cliente__codigo,
           'Cliente ' || o_custkey AS detalhe__cliente__nome,
           CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS ativo,
           CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 2 END AS items
    FROM orders""")
def json_landing(t, spark):
    nested = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.struct(F.col("o_custkey").alias("Codigo"), F.concat(F.lit("Cliente "), "o_custkey").alias("Nome")).alias("Cliente"),
            F.col("o_totalprice").alias("Valor")).alias("Detalhe"),
        (F.col("o_orderstatus") == "F").alias("Ativo"),
        F.when(F.col("o_orderkey") % 3 == 0, F.expr("array()")).otherwise(
            F.array(F.struct(F.lit(1).alias("n")), F.struct(F.lit(2).alias("n")))).alias("itens"))
    path = fresh_folder(spark, "json")
    nested.write.json(path)
    flat = landing.land_json(spark, path, NESTED_ORDERS)
    return flat.select("id", "detalhe__cliente__codigo", "detalhe__cliente__nome", "ativo", F.size("itens").alias("items"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS cliente__codigo,
           CASE WHEN o_orderkey % 1000 = 7 THEN 'M' || o_custkey END AS cliente__matricula_nova,
           CASE WHEN o_orderkey % 1000 = 7 THEN CAST(o_orderkey % 3 AS VARCHAR) END AS cliente__endereco__andar,
           CASE WHEN o_orderkey % 1000 = 9 THEN '[1,' || o_custkey || ']' END AS marcas,
           CASE WHEN o_orderkey % 1000 = 11 THEN 'sim' WHEN o_orderkey % 1000 = 13 THEN '{"motivo":"' || o_orderpriority || '"}' END AS retido,
           CASE WHEN o_orderkey % 1000 = 15 THEN 'novo' END AS itens_0_lote,
           CAST(NULL AS VARCHAR) AS refused, 1 AS n
    FROM orders WHERE o_orderkey % 500 <> 3
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{"id":' || o_orderkey, 1 FROM orders WHERE o_orderkey % 500 = 3 AND o_orderkey % 1000 <> 3
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'counted', count(*) FROM orders WHERE o_orderkey % 500 = 3""")
def json_undeclared(t, spark):
    """One record in a thousand brings nested keys, lists or kinds that nobody declared; two lines in a thousand are no records."""
    def now_and_then(rest, text):
        return f"CASE WHEN o_orderkey % 1000 = {rest} THEN {text} ELSE '' END"

    more = now_and_then(7, """',"Matricula_Nova":"M' || o_custkey || '","Endereco":{"Andar":' || o_orderkey % 3 || '}'""")
    lists = now_and_then(9, """',"Marcas":[1, ' || o_custkey || ']'""")
    kinds = now_and_then(11, """',"retido":"sim"'""") + " || " + now_and_then(13, """',"RETIDO":{"motivo":"' || o_orderpriority || '"}'""")
    item = now_and_then(15, """',"lote":"novo"'""")
    record = f"""'{{"id":' || o_orderkey || ',"Cliente":{{"Codigo":' || o_custkey || {more} || '}}' || {lists} || {kinds} || ',"itens":[{{"n":1' || {item} || '}}]}}'"""
    broken = """CASE WHEN o_orderkey % 1000 = 3 THEN '[1, 2]' ELSE '{"id":' || o_orderkey END"""
    path = fresh_folder(spark, "json")
    t.orders.select(F.expr(f"CASE WHEN o_orderkey % 500 = 3 THEN {broken} ELSE {record} END").alias("value")).write.text(path)
    landed = landing.land_json_records(spark, path, "id long, Cliente struct<Codigo: long>, itens array<struct<n: int>>")
    names = ["id", "cliente__codigo", "cliente__matricula_nova", "cliente__endereco__andar", "marcas", "retido"]
    rows = landed.accepted.select(*names, F.col("itens")[0]["lote"].alias("itens_0_lote"), F.lit(None).cast("string").alias("refused"), F.lit(1).alias("n"))
    bad = landed.refused.where("value like '{%'").select(F.col("value").alias("refused"), F.lit(1).alias("n"))
    counted = spark.range(1).select(F.lit("counted").alias("refused"), F.lit(landed.counts["not a JSON object"]).alias("n"))
    return rows.unionByName(bad, allowMissingColumns=True).unionByName(counted, allowMissingColumns=True)


@query("""
    SELECT o_orderstatus AS nome, o_orderkey * 10 + i AS codigocargofuncao, 'cargo ' || i AS categoria
    FROM orders, (VALUES (1), (2)) AS v(i) WHERE o_orderkey % 4 <> 0""")
def nested_children(t, spark):
    posts = F.array(*[
        F.struct((F.col("o_orderkey") * 10 + i).alias("codigoCargoFuncao"), F.lit(f"cargo {i}").alias("categoria"))
        for i in (1, 2)])
    types = t.orders.select(
        F.col("o_orderstatus").alias("nome"),
        F.struct(F.when(F.col("o_orderkey") % 4 != 0, posts).alias("cargoFuncao")).alias("cargosFuncoes"))
    flat = landing.posts_by_type(types)
    return flat.select("nome", F.col("codigocargofuncao").cast("long").alias("codigocargofuncao"), "categoria")


LINES = (
    "SELECT l_suppkey, year(l_shipdate) AS y, l_returnflag AS f,"
    " CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS total, count(*) AS n"
    " FROM {lines} GROUP BY l_suppkey, year(l_shipdate), l_returnflag"
)


@query("SELECT CAST(y AS VARCHAR) AS year, CAST(l_suppkey AS VARCHAR) AS unit, f AS flag, CAST(total AS DOUBLE) AS total, n"
       f" FROM ({LINES.format(lines='lineitem')})")
def year_block_report(t, spark):
    """Each report covers a hundred suppliers at most, with one block per year."""
    empty = "''"
    cells = [
        "CAST(l_suppkey AS STRING)", *[empty] * 12, "f", *[empty] * 6,
        "replace(CAST(total AS STRING), '.', ',')", "CAST(n AS STRING)",
    ]
    tab, quote, newline = "chr(9)", "chr(34)", "chr(10)"
    line = f" || {tab} || ".join(f"{quote} || {c} || {quote}" for c in cells)
    rows = spark.sql(LINES, lines=t.lineitem).select(
        F.floor(F.col("l_suppkey") / 100).alias("report"), "y", F.expr(line).alias("line"))
    blocks = rows.groupBy("report", "y").agg(F.concat_ws("\n", F.collect_list("line")).alias("lines"))
    heading = F.concat(
        F.lit("Ano Lançamento: "), F.col("y").cast("string"),
        F.lit('\nPáginas: 1\n\nUnidade Orçamentária\t"UG Executora"\n"PROJETO INICIAL DA LOA"\n \n'))
    texts = blocks.select("report", F.concat(heading, "lines", F.lit("\n\nrodapé\n")).alias("value"))
    path = fresh_folder(spark, "year-blocks")
    texts.write.partitionBy("report").text(path)
    names = [f"c{i}" for i in range(22)]
    read = reports.read_year_blocks(spark, f"{path}/*", names, encoding="UTF-8")
    return read.select(
        F.col("ano_exercicio").alias("year"), F.col("c0").alias("unit"), F.col("c13").alias("flag"),
        money.parse_money("c20").alias("total"), F.col("c21").cast("long").alias("n"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS emissao_mes, 'a, "b"' AS emissao_dia,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS ne, CAST(o_custkey AS VARCHAR) AS col_3
    FROM orders""")
def headerless_extract(t, spark):
    """Each extract holds up to five hundred rows below a preamble of three lines."""
    quoted = "chr(34) || 'a, ' || chr(34) || chr(34) || 'b' || chr(34) || chr(34) || chr(34)"
    line = (f"CAST(o_orderkey AS STRING) || ',' || {quoted} || ',' ||"
            " CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END || ',' || CAST(o_custkey AS STRING)")
    rows = t.orders.select(F.floor(F.col("o_orderkey") / 500).alias("extract"), F.expr(line).alias("line"))
    texts = rows.groupBy("extract").agg(F.concat(
        F.lit("Relatório\n\nGerado em 2024, hoje\n"), F.concat_ws("\n", F.collect_list("line"))).alias("value"))
    path = fresh_folder(spark, "extract")
    texts.write.partitionBy("extract").text(path)
    return reports.read_headerless(spark, f"{path}/*", ["emissao_mes", "emissao_dia", "ne"], skip=3)


def _envelope(body: str) -> str:
    return (
        "'<soapenv:Envelope xmlns:soapenv=\"http://schemas.xmlsoap.org/soap/envelope/\">"
        "<soapenv:Body><ns1:resposta xmlns:ns1=\"http://exemplo\"><out>' || "
        f"{body}"
        " || '</out></ns1:resposta></soapenv:Body></soapenv:Envelope>'"
    )


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS cpf, c_name || ' & co' AS nome,
           CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey + 1 AS VARCHAR) END AS codigo
    FROM customer WHERE c_custkey % 10 <> 0""")
def xml_flat_record(t, spark):
    body = (
        "'<ns1:cpf> ' || c_custkey || ' </ns1:cpf><nome>' || c_name || ' &amp; co</nome><codigo>' || c_custkey || '</codigo>"
        "<grupo><codigo>' || CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE CAST(c_custkey + 1 AS STRING) END || '</codigo></grupo>'"
    )
    xml = f"CASE WHEN c_custkey % 10 = 0 THEN '<fault>no body</fault>' ELSE {_envelope(body)} END"
    # Of a repeated tag the last non-blank text stays, so a blank second code leaves the first.
    responses = t.customer.select(F.expr(xml).alias("xml"))
    return soap.flat_record(responses, "xml", ["cpf", "nome", "codigo"])


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS cpf, i AS pos, CAST(o_orderkey AS VARCHAR) AS codigo,
           CASE WHEN i = 0 THEN o_orderpriority ELSE NULL END AS nome,
           o_custkey || '_' || i || '_' || o_orderkey || '_' || CASE WHEN i = 0 THEN o_orderpriority ELSE '' END AS id_registro
    FROM orders, (VALUES (0), (1)) AS v(i) WHERE o_orderkey % 5 <> 0""")
def xml_repeated(t, spark):
    item = "'<ns1:Pensao><codigo>' || o_orderkey || '</codigo>{name}<arrayFicha><codigo>9</codigo></arrayFicha></ns1:Pensao>'"
    first = item.format(name="<nome>' || o_orderpriority || '</nome>")
    second = item.format(name="")
    xml = f"CASE WHEN o_orderkey % 5 = 0 THEN {_envelope(chr(39) * 2)} ELSE {_envelope(first + ' || ' + second)} END"
    responses = t.orders.select(F.col("o_custkey").cast("string").alias("cpf"), F.expr(xml).alias("xml"))
    rows = soap.records(responses, "xml", "Pensao", ["codigo", "nome"], keep=["cpf"])
    named = rows.withColumnsRenamed({"codigo": "cpfpensionista", "nome": "matriculapensionista"})
    with_id = landing.pension_ids(named.withColumn("place", F.col("pos")))
    return with_id.select(
        "cpf", F.col("place").alias("pos"), F.col("cpfpensionista").alias("codigo"),
        F.nullif(F.col("matriculapensionista"), F.lit("")).alias("nome"), "id_registro")


@query("""
    SELECT 'record' AS kind, CAST(o_custkey AS VARCHAR) AS cpf, 0 AS pos, CAST(o_orderkey AS VARCHAR) AS codigo,
           CASE WHEN o_orderkey % 1000 = 7 THEN 'a < ' || o_custkey END AS observacao,
           CASE WHEN o_orderkey % 1000 = 9 THEN 'dentro' END AS grupo, CAST(NULL AS VARCHAR) AS andar
    FROM orders
    UNION ALL
    SELECT 'record', CAST(o_custkey AS VARCHAR), 1, 'i' || o_orderkey, NULL, NULL, NULL FROM orders WHERE o_orderkey % 1000 = 11
    UNION ALL
    SELECT 'leaves', CAST(o_custkey AS VARCHAR), NULL, CASE WHEN o_orderkey % 1000 = 11 THEN 'i' ELSE '' END || o_orderkey, CASE WHEN o_orderkey % 1000 = 7 THEN 'a < ' || o_custkey END, NULL,
           CASE WHEN o_orderkey % 1000 = 9 THEN CAST(o_orderkey % 3 AS VARCHAR) END
    FROM orders""")
def xml_undeclared(t, spark):
    """One response in a thousand brings a tag that nobody declared, or an element of the record's own name inside it."""
    note = "CASE WHEN o_orderkey % 1000 = 7 THEN '<observacao>a &lt; ' || o_custkey || '</observacao>' ELSE '' END"
    group = "CASE WHEN o_orderkey % 1000 = 9 THEN '<grupo>dentro<andar>' || o_orderkey % 3 || '</andar></grupo>' ELSE '' END"
    inner = "CASE WHEN o_orderkey % 1000 = 11 THEN '<lista><ns1:Pensao><codigo>i' || o_orderkey || '</codigo></ns1:Pensao></lista>' ELSE '' END"
    body = f"'<ns1:Pensao><codigo>' || o_orderkey || '</codigo>' || {note} || {group} || {inner} || '</ns1:Pensao>'"
    responses = t.orders.select(F.col("o_custkey").cast("string").alias("cpf"), F.expr(_envelope(body)).alias("xml"))
    rows = soap.records(responses, "xml", "Pensao", ["codigo"], keep=["cpf"], undeclared=True).withColumn("kind", F.lit("record"))
    leaves = soap.flat_record(responses, "xml", ["codigo"], keep=["cpf"], undeclared=True).withColumn("kind", F.lit("leaves"))
    names = ["kind", "cpf", "pos", "codigo", "observacao", "grupo", "andar"]
    return add_missing_columns(rows, names).select(*names).unionByName(add_missing_columns(leaves, names).select(*names))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS pessoa, CAST(o_custkey AS VARCHAR) AS dataini, NULL AS codocorrencia FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), '7', o_orderpriority FROM orders""")
def xml_two_kinds(t, spark):
    holiday = "CASE WHEN o_orderkey % 2 = 0 THEN '<n:DadosFerias><dataIni>' || o_custkey || '</dataIni></n:DadosFerias>' ELSE '' END"
    event = "'<n:DadosOcorrencias><codOcorrencia>' || o_orderpriority || '</codOcorrencia><dataIni>7</dataIni></n:DadosOcorrencias>'"
    responses = t.orders.select(
        F.col("o_orderkey").cast("string").alias("pessoa"), F.expr(_envelope(f"{holiday} || {event}")).alias("xml"))
    return soap.two_kinds(
        responses, "xml", {"DadosFerias": ["dataIni"], "DadosOcorrencias": ["dataIni", "codOcorrencia"]}, keep=["pessoa"])


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS nome, CAST(i AS VARCHAR) AS codbeneficio
    FROM orders JOIN (VALUES (1), (2)) AS v(i) ON i <= o_orderkey % 3
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderkey % 3 = 0""")
def xml_nested(t, spark):
    one = "<Beneficio><codBeneficio>{n}</codBeneficio></Beneficio>"
    benefits = (
        "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN"
        f" '<arrayBeneficios>{one.format(n=1)}</arrayBeneficios>' ELSE"
        f" '<arrayBeneficios>{one.format(n=1)}{one.format(n=2)}</arrayBeneficios>' END"
    )
    body = f"'<n:DadosDependentes><nome>' || o_orderkey || '</nome>' || {benefits} || '</n:DadosDependentes>'"
    responses = t.orders.select(F.expr(_envelope(body)).alias("xml"))
    return soap.with_nested(
        responses, "xml", "DadosDependentes", ["nome"], "arrayBeneficios", "Beneficio", ["codBeneficio"])


@query("""
    SELECT o_custkey, o_orderkey FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END,
                 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END DESC NULLS LAST, o_orderkey) = 1""")
def best_record(t, spark):
    text_date = F.expr(f"CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE {day('o_orderdate')} || {month('o_orderdate')} || {year('o_orderdate')} END")
    rows = t.orders.select(
        "o_custkey", "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "01012020").otherwise("").alias("dataocorrexclusao"),
        text_date.alias("dataingressofuncao"))
    return soap.best_record(
        rows, "o_custkey", F.col("dataocorrexclusao"), F.try_to_date("dataingressofuncao", "ddMMyyyy"), pos="o_orderkey"
    ).select("o_custkey", "o_orderkey")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS dt_ultima_transacao
    FROM orders WHERE year(o_orderdate) >= 2000""")
def landing_filters(t, spark):
    raw = t.orders.select(
        "o_orderkey", F.expr(year("o_orderdate")).alias("ne_ccor_ano_emissao"),
        F.expr(f"CASE WHEN o_orderkey % 4 = 0 THEN '0' ELSE {day('o_orderdate')} || {month('o_orderdate')} || {year('o_orderdate')} END")
        .alias("dataultimatransacao"))
    recent = landing.recent_commitments(raw)
    return landing.compact_date_to_iso(recent, "dataultimatransacao", "dt_ultima_transacao").select(
        "o_orderkey", "dt_ultima_transacao")


@query("""
    SELECT 'customers' AS worklist, CAST(o_custkey AS VARCHAR) AS a, '' AS b, '' AS c FROM orders GROUP BY 2
    UNION ALL
    SELECT 'documents', CAST(o_custkey AS VARCHAR), '2024', lpad(CAST(o_orderkey AS VARCHAR), 6, '0') FROM orders
    WHERE o_orderkey % 6 <> 0
    UNION ALL
    SELECT 'years', s_name, CAST(y AS VARCHAR), '' FROM supplier, (VALUES (2022), (2023), (2024)) AS v(y)""")
def worklist_keys(t, spark):
    customers = worklists.distinct_keys(t.orders, "o_custkey").select(
        F.lit("customers").alias("worklist"), F.col("o_custkey").cast("string").alias("a"), F.lit("").alias("b"), F.lit("").alias("c"))
    numbered = t.orders.select(
        F.expr(f"CASE o_orderkey % 6 WHEN 0 THEN NULL ELSE '2024NC' || {padded('o_orderkey', 6)} END").alias("nota"),
        F.col("o_custkey").cast("string").alias("a"))
    documents = worklists.document_keys(numbered, "nota", "a").select(
        F.lit("documents").alias("worklist"), "a", F.col("ano").alias("b"), F.col("numero").alias("c"))
    years = worklists.units_by_year(t.supplier, "s_name", 2022, 2024).select(
        F.lit("years").alias("worklist"), F.col("s_name").alias("a"), F.col("ano").cast("string").alias("b"), F.lit("").alias("c"))
    return customers.union(documents).union(years)


@query("""
    SELECT c_custkey, n_regionkey + 2 AS ordem_grandeza FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 2 = 0""")
def depth_enrichment(t, spark):
    units = t.nation.where("n_nationkey % 2 = 0").select(
        F.col("n_nationkey").alias("codigounidade"), (F.col("n_regionkey") + 2).alias("ordem_grandeza"))
    posts = t.customer.select("c_custkey", F.col("c_nationkey").alias("codigounidade"))
    return landing.with_tree_depth(posts, units).select("c_custkey", "ordem_grandeza")


@query("""
    SELECT o_orderkey, CASE year(o_orderdate) WHEN 1998 THEN 'replaced' WHEN 1997 THEN 'appended' ELSE o_orderstatus END AS status,
           CASE WHEN year(o_orderdate) = 1998 THEN o_orderpriority END AS note, CAST(year(o_orderdate) AS INT) AS y
    FROM orders""")
def table_writes(t, spark):
    """Full refresh, append, refresh of one partition with a new column, and a view over the table."""
    path = fresh_folder(spark, "table")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("y"))
    write_table(rows.where("y <> 1997"), path + "-b", partition_by=["y"])
    write_table(rows.where("y = 1997").withColumn("status", F.lit("appended")), path + "-b", mode="append", partition_by=["y"])
    changed = t.orders.where(F.year("o_orderdate") == 1998).select(
        "o_orderkey", F.lit("replaced").alias("status"), F.col("o_orderpriority").alias("note"), F.lit(1998).alias("y"))
    write_table(changed, path + "-b", partition_by=["y"])
    name = "orders_" + path.rsplit("-", 1)[1]
    publish_view(read_table(spark, path + "-b"), name)
    return spark.table(name).select("o_orderkey", "status", "note", "y")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 16 IN (3, 5) AND o_orderkey % 3 = 0 THEN 'updated' ELSE o_orderstatus END AS status,
           CAST(o_orderkey % 16 AS INT) AS slot
    FROM orders
    UNION ALL SELECT -o_orderkey - 1, 'inserted', 3 FROM orders WHERE o_orderkey % 100 = 0""")
def upsert_partitions(t, spark):
    """A batch that falls into two of sixteen partitions rewrites those two."""
    path = fresh_folder(spark, "slots")
    slot = (F.col("o_orderkey") % 16).cast("int")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), slot.alias("slot"))
    write_table(rows, path, partition_by=["slot"])
    updated = rows.where("slot IN (3, 5) AND o_orderkey % 3 = 0").withColumn("status", F.lit("updated"))
    inserted = t.orders.where("o_orderkey % 100 = 0").select(
        (-F.col("o_orderkey") - 1).alias("o_orderkey"), F.lit("inserted").alias("status"), F.lit(3).alias("slot"))
    upsert_table(spark, path, updated.union(inserted), ["o_orderkey"], "slot")
    return read_table(spark, path).select("o_orderkey", "status", "slot")


@query("""
    SELECT user_id, event_id, event_type FROM events
    WHERE user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def incremental_landing(t, spark):
    """Two runs of the stream over a growing folder; each user's last event stays."""
    root = fresh_folder(spark, "stream")
    schema = T.StructType.fromDDL("event_id long, ts timestamp, user_id long, event_type string")
    events = t.events.select("event_id", "ts", "user_id", "event_type")
    middle = "timestamp'2024-01-15 00:00:00'"
    for part in (f"ts < {middle}", f"ts >= {middle}"):
        events.where(part).write.mode("append").json(f"{root}/in")
        land_increment(spark, f"{root}/in", schema, f"{root}/table", f"{root}/progress", ["user_id"], "ts")
    return read_landed(spark, f"{root}/table", ["user_id"]).select("user_id", "event_id", "event_type")


@query("""
    SELECT user_id, event_id, NULL AS refused_because, NULL AS batch_id FROM events
    WHERE user_id IS NOT NULL AND event_id % 100 <> 7
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    UNION ALL
    SELECT NULL, event_id, 'null in the key', CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END FROM events WHERE user_id IS NULL OR event_id % 100 = 7""")
def incremental_refused(t, spark):
    """Two runs of the stream over records that partly lack their key: the table, and beside it what it refused, by batch."""
    root = fresh_folder(spark, "stream")
    schema = "event_id long, ts timestamp, user_id long, event_type string"
    events = t.events.select("event_id", "ts", F.when(F.col("event_id") % 100 != 7, F.col("user_id")).alias("user_id"), "event_type")
    middle = "timestamp'2024-01-15 00:00:00'"
    for part in (f"ts < {middle}", f"ts >= {middle}"):
        events.where(part).write.mode("append").json(f"{root}/in")
        land_increment(spark, f"{root}/in", T.StructType.fromDDL(schema), f"{root}/table", f"{root}/progress", ["user_id"], "ts", refused=f"{root}/refused")
    landed = read_landed(spark, f"{root}/table", ["user_id"]).select("user_id", "event_id")
    refused = read_refused(spark, f"{root}/refused", schema).select("user_id", "event_id", "refused_because", "batch_id")
    return landed.unionByName(refused, allowMissingColumns=True)


@query("""
    SELECT user_id, event_id, event_type, 2 AS levels FROM events WHERE user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def compacted_landing(t, spark):
    """Ten batches of the stream, compacted after five and after ten: batches become runs, runs a run of the next level."""
    root = fresh_folder(spark, "stream")
    schema = T.StructType.fromDDL("event_id long, ts timestamp, user_id long, event_type string")
    events = t.events.select("event_id", "ts", "user_id", "event_type")
    day = F.dayofmonth("ts")
    for first in (0, 5):
        for i in range(first, first + 5):
            part = events.where((day > 3 * i) & (day <= 3 * i + 3)) if i < 9 else events.where(day > 27)
            part.repartition(1).write.mode("append").json(f"{root}/in")
        land_increment(spark, f"{root}/in", schema, f"{root}/table", f"{root}/progress", ["user_id"], "ts", max_files=1)
        manifest = compact_landed(spark, f"{root}/table", ["user_id"], fan_in=2)
    landed = read_landed(spark, f"{root}/table", ["user_id"])
    return landed.select("user_id", "event_id", "event_type", F.lit(max(level for _, level in manifest.runs)).alias("levels"))
