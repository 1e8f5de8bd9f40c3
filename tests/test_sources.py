"""Landing jobs on small files."""

import json
import pathlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tributary.operators.keyed import merge_rows
from tributary.sources import catalog, landing, reports, soap, worklists
from tributary.streaming.landing import land_increment, read_landed

NS = 'xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/" xmlns:n="http://tipo.exemplo"'


def envelope(body):
    return f"<soapenv:Envelope {NS}><soapenv:Body><n:resp><out>{body}</out></n:resp></soapenv:Body></soapenv:Envelope>"


def test_land_json_flattens_and_lowers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(
        {"Id": 1, "Orgao": {"Codigo": 5, "Unidade": {"Nome": "x"}}, "itens": [{"n": 1}], "Ativo": True, "vazio": None}))
    schema = "Id long, Orgao struct<Codigo: long, Unidade: struct<Nome: string>>, itens array<struct<n: int>>, Ativo boolean, vazio double"
    df = landing.land_json(spark, str(tmp_path), schema)
    assert df.columns == ["id", "orgao__codigo", "orgao__unidade__nome", "itens", "ativo", "vazio", "dt_ingest"]
    row = df.first()
    assert row[:3] == ("1", "5", "x") and row["ativo"] == "true" and row["vazio"] is None
    assert row["itens"][0]["n"] == 1


def test_headerless_extract(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('Título, com vírgula\n\nperíodo\n1,"a, ""b""\nc",,x\r\n\n2,,"3",\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("h\nh\nh\n9,8,7", encoding="utf-8")
    df = reports.read_headerless(spark, str(tmp_path / "*.csv"), ["p", "q", "r"], skip=3)
    assert df.columns == ["p", "q", "r", "col_3"]
    assert rows(df) == [("1", 'a, "b"\nc', None, "x"), ("2", None, "3", None), ("9", "8", "7", None)]


def test_sent_and_received_extracts_combine_by_name(spark, rows):
    sent = spark.createDataFrame([("1", "a")], "nc string, ptres string")
    received = spark.createDataFrame([("b", "2", "x")], "ptres string, nc string, extra string")
    assert rows(reports.combine(sent, received)) == sorted([("1", "a", None), ("2", "b", "x")], key=str)


def _report_line(first, fourteenth, n=22, **cells):
    values = [""] * n
    values[0], values[13] = first, fourteenth
    for i, v in cells.items():
        values[int(i[1:])] = v
    return "\t".join(f'"{v}"' for v in values)


def test_year_blocks_utf16(spark, tmp_path, rows):
    lines = [
        "Relatório", "Ano Lançamento: 2023", "a", "b", "c", "d", "e",
        _report_line("U1", "E1", c20="1,50"), "", "curta\tlinha", _report_line("", "E2"), _report_line("U3", ""),
        "Páginas: 1\t" + _report_line("U9", "E9"), _report_line("U2", "nan", c20="nan"),
        "cut 1", "cut 2",
        "Ano Lançamento:  2024", "a", "b", "c", "d", "e",
        _report_line("U4", "E4", c1="x"), _report_line("U5", "E5", n=19),
    ]
    (tmp_path / "r.csv").write_bytes("\n".join(lines).encode("utf-16"))
    names = [f"c{i}" for i in range(30)]
    df = reports.read_year_blocks(spark, str(tmp_path), names)
    assert df.columns == [*names, "ano_exercicio"]
    assert rows(df, "ano_exercicio", "c0", "c1", "c13", "c20", "c29") == [
        ("2023", "U1", "", "E1", "1,50", ""), ("2023", "U2", "", "", "", ""), ("2024", "U4", "x", "E4", "", "")]


def test_year_blocks_without_data(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes("nada\nAno Lançamento: 2024\nx".encode("utf-16"))
    assert reports.read_year_blocks(spark, str(tmp_path), ["a"]).isEmpty()


def test_flat_record_last_tag_wins(spark, rows):
    xml = envelope("<n:cpf> 1 </n:cpf><nome>A &amp; B</nome><g><cod>1</cod></g><g><cod>2</cod></g><g><cod> </cod></g><vazio/>")
    df = spark.createDataFrame([(xml,), ("<x>sem corpo</x>",)], "xml string")
    assert rows(soap.flat_record(df, "xml", ["cpf", "nome", "cod", "vazio"])) == [("1", "A & B", "2", None)]


def test_repeated_records(spark, rows):
    xml = envelope("<lista><n:Uorg><codigo>1</codigo></n:Uorg><n:Uorg><codigo>2</codigo><nome> x </nome></n:Uorg><n:Uorg/></lista>")
    df = spark.createDataFrame([("k", xml), ("m", "<x/>")], "key string, xml string")
    got = rows(soap.records(df, "xml", "Uorg", ["codigo", "nome"], keep=["key"]))
    assert [r[:3] for r in got][:2] == [("k", 0, "1"), ("k", 1, "2")]
    assert len(got) == 3 and got[1][3] == "x"


def test_two_kinds_and_nested(spark, rows):
    xml = envelope(
        "<n:DadosFerias><dataIni>1</dataIni></n:DadosFerias>"
        "<n:DadosOcorrencias><codOcorrencia>7</codOcorrencia></n:DadosOcorrencias>"
        "<n:DadosDependentes><nome>sem</nome></n:DadosDependentes>"
        "<n:DadosDependentes><nome>com</nome><n:arrayBeneficios><n:Beneficio><codBeneficio>1</codBeneficio></n:Beneficio>"
        "<n:Beneficio><codBeneficio>2</codBeneficio></n:Beneficio></n:arrayBeneficios></n:DadosDependentes>")
    df = spark.createDataFrame([(xml,)], "xml string")
    kinds = soap.two_kinds(df, "xml", {"DadosFerias": ["dataIni"], "DadosOcorrencias": ["codOcorrencia"]})
    assert rows(kinds) == [("1", None), (None, "7")]
    nested = soap.with_nested(df, "xml", "DadosDependentes", ["nome"], "arrayBeneficios", "Beneficio", ["codBeneficio"])
    assert rows(nested) == [("com", "1"), ("com", "2"), ("sem", None)]


def test_best_record_compares_dates_not_text(spark, rows):
    df = spark.createDataFrame([
        ("a", 0, "", "01122020"), ("a", 1, None, "15012024"), ("a", 2, "01012020", "01012025"),
        ("b", 0, "x", None), ("b", 1, "x", "01012001"), ("c", 0, None, None), ("c", 1, None, None),
    ], "cpf string, pos int, out string, entered string")
    best = soap.best_record(df, "cpf", F.col("out"), F.try_to_date("entered", "ddMMyyyy"))
    assert rows(best, "cpf", "pos") == [("a", 1), ("b", 1), ("c", 0)]


def test_small_landing_steps(spark, rows):
    df = spark.createDataFrame([("01022024",), ("31022024",), ("0",), (None,)], "dataultimatransacao string")
    iso = landing.compact_date_to_iso(df, "dataultimatransacao", "dt")
    assert [r[0] for r in iso.collect()] == ["2024-02-01", None, None, None]
    ids = landing.pension_ids(spark.createDataFrame(
        [("1", 0, "2", None)], "cpf string, pos int, cpfpensionista string, matriculapensionista string"))
    assert ids.first()["id_registro"] == "1_0_2_"
    years = spark.createDataFrame([("2024",), ("-9",), (None,)], "ne_ccor_ano_emissao string")
    assert landing.recent_commitments(years).count() == 1


def test_worklists(spark, rows):
    df = spark.createDataFrame([("2024NC000123", "1"), (None, "1"), ("2024NC000124", ""), ("2024NC000123", "1")], "n string, ug string")
    assert rows(worklists.document_keys(df, "n", "ug").distinct()) == [("1", "2024", "000123")]
    assert rows(worklists.distinct_keys(df, "n")) == [("2024NC000123",), ("2024NC000124",)]
    assert rows(worklists.units_by_year(df, "ug", 2023, 2024).where("ug = '1'")) == [("1", 2023), ("1", 2024)]


def test_apply_batch_rules(spark, rows):
    at = datetime(2024, 1, 1)
    old = spark.createDataFrame([("1", "a", at)], "id string, v string, dt_ingest timestamp")
    new = spark.createDataFrame([("1", "b", at), ("2", "c", at)], "id string, v string, dt_ingest timestamp")
    assert rows(catalog.apply_batch("contratos", old, new), "id", "v") == [("1", "b"), ("2", "c")]
    assert catalog.apply_batch("afastamento_historico", old, new).count() == 3
    assert rows(catalog.apply_batch("cronograma", old, new), "id", "v") == [("1", "b"), ("2", "c")]
    assert catalog.apply_batch("contratos", None, new).count() == 2
    names = catalog.EXTRACT_COLUMNS["nc_tesouro"]
    extract = catalog.text_columns(spark.createDataFrame([("x",)], "nc string"), names)
    stamped = lambda day: extract.withColumn("dt_ingest", F.lit(datetime(2024, 1, day)))
    assert rows(catalog.apply_batch("nc_tesouro", stamped(1), stamped(2)), "nc", "dt_ingest") == [("x", at)]
    assert len(catalog.LANDINGS) == 33


def test_several_rows_per_person_are_replaced_together(spark, rows):
    ddl = "cpf string, nome string, codbeneficio string"
    old = spark.createDataFrame([("1", "a", "x"), ("1", "a", "y"), ("2", "b", None)], ddl)
    new = spark.createDataFrame([("1", "a", "z"), ("1", "c", None), (None, "lost", None)], ddl)
    assert rows(catalog.apply_batch("dados_dependentes", old, new)) == sorted(
        [("1", "a", "z"), ("1", "c", None), ("2", "b", None)], key=str)


def test_extract_rows_with_empty_keys_are_kept(spark, rows):
    names = catalog.EXTRACT_COLUMNS["empenhos_tesouro"]
    row = catalog.text_columns(spark.createDataFrame([("n1",)], "ne_ccor string"), names)
    once = catalog.apply_batch("empenhos_tesouro", None, row)
    twice = catalog.apply_batch("empenhos_tesouro", once, row.withColumn("ptres", F.lit("9")))
    assert rows(twice, "ne_ccor", "doc_observacao", "ptres") == [("n1", "NaN", "9")]


def test_partition_refresh_keeps_other_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    catalog.write_table(spark.createDataFrame([(1, 2023), (2, 2024)], "v int, y int"), path, partition_by=["y"])
    catalog.write_table(spark.createDataFrame([(3, "n", 2024)], "v int, c string, y int"), path, partition_by=["y"])
    assert rows(catalog.read_table(spark, path), "v", "c", "y") == [(1, None, 2023), (3, "n", 2024)]


def test_upsert_table_rewrites_touched_partitions_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    ddl = "id int, v string, y int"
    catalog.write_table(spark.createDataFrame([(1, "a", 2023), (2, "b", 2024)], ddl), path, partition_by=["y"])
    untouched = sorted(f.name for f in (tmp_path / "t" / "y=2023").iterdir())
    batch = spark.createDataFrame([(2, "c", 2024), (3, "d", 2025)], ddl)
    for _ in range(2):
        catalog.upsert_table(spark, path, batch, ["id"], "y")
        assert rows(catalog.read_table(spark, path), "id", "v", "y") == [(1, "a", 2023), (2, "c", 2024), (3, "d", 2025)]
    assert sorted(f.name for f in (tmp_path / "t" / "y=2023").iterdir()) == untouched


def test_incremental_landing(spark, tmp_path, rows):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    put = lambda data: spark.createDataFrame(data, "id string, v string, at long").write.mode("append").json(source)
    go = lambda: land_increment(spark, source, "id string, v string, at long", target, progress, ["id"], "at")
    put([("1", "a", 1), ("1", "b", 2), ("2", "c", 1), (None, "x", 1)])
    go()
    assert rows(read_landed(spark, target, ["id"]), "id", "v") == [("1", "b"), ("2", "c")]
    put([("2", "d", 3), ("3", "e", 3)])
    go()
    go()  # nothing new: nothing changes
    assert rows(read_landed(spark, target, ["id"]), "id", "v") == [("1", "b"), ("2", "d"), ("3", "e")]
    assert spark.read.parquet(target).groupBy("batch_id", "id").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("name", ["empenhos_tesouro", "nc_tesouro", "pf_tesouro"])
def test_extract_columns_have_no_repeats(name):
    columns = catalog.EXTRACT_COLUMNS[name]
    assert len(columns) == len(set(columns)) and name in catalog.PREAMBLE_LINES


def test_short_extract_is_reported(spark, tmp_path):
    (tmp_path / "short.csv").write_text("only\none", encoding="utf-8")
    with pytest.raises(Exception, match="fewer lines than the preamble"):
        reports.read_headerless(spark, str(tmp_path / "*.csv"), ["p"], skip=3, width=1).collect()


def test_self_closed_elements_and_comments(spark, rows):
    xml = '<Body><P nil="true"/><!-- <P><A>0</A></P> --><P u="a/b"><A>1</A></P><P><A>2</A></P></Body>'
    found = soap.records(spark.createDataFrame([(xml,)], ["x"]), "x", "P", ["A"])
    assert rows(found, "pos", "a") == [(0, None), (1, "1"), (2, "2")]


def test_flat_record_reads_cdata_and_numeric_entities(spark, rows):
    xml = "<Body><A>caf&#233; &amp; co</A><B><![CDATA[x < y]]></B><C>&lt;</C></Body>"
    assert rows(soap.flat_record(spark.createDataFrame([(xml,)], ["x"]), "x", ["A", "B", "C"])) == [("caf\u00e9 & co", "x < y", "<")]


def test_upsert_table_keeps_rows_without_partition(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k string, v string, y string"
    catalog.write_table(spark.createDataFrame([("a", "1", "2024"), ("b", "1", None), ("c", "1", None)], schema), path, partition_by=["y"])
    catalog.upsert_table(spark, path, spark.createDataFrame([("b", "2", None)], schema), ["k"], "y")
    assert rows(catalog.read_table(spark, path), "k", "v") == [("a", "1"), ("b", "2"), ("c", "1")]


def test_history_runs_within_a_second(spark, tmp_path, rows):
    path, state = str(tmp_path / "h"), lambda v: spark.createDataFrame([(1, v)], "id int, v string")
    stamp = lambda part: F.lit(f"2024-02-01 00:00:00.{part}").cast("timestamp_ntz")
    catalog.create_history(path, state("a"), ["id"], stamp("000"))
    for value, part in (("b", "100"), ("c", "900")):
        catalog.update_history(spark, path, state(value), ["id"], ["v"], stamp(part))
    assert rows(catalog.read_table(spark, path), "v") == [("a",), ("b",), ("c",)]


def files_by_folder(path):
    return {f.parent.relative_to(path): sorted(x.name for x in f.parent.glob("*.parquet")) for f in path.rglob("*.parquet")}


def test_append_reads_only_its_buckets_and_adds_what_is_new(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    history = spark.range(3000).selectExpr("CAST(id % 2500 AS STRING) AS nc", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS v", "'2024-01-01' AS dt_ingest", "id AS more")
    catalog.append_unseen(spark, path, history, ["nc", "v"], "dt_ingest")
    before = files_by_folder(tmp_path / "t")
    batch = spark.createDataFrame([("0", None, "2024-01-02", 1), ("1", None, "2024-01-02", 1), ("new", "", "2024-01-03", 2), ("new", "", "2024-01-02", 3), (None, None, "2024-01-02", 4)], history.schema)
    known = catalog.read_table(spark, path).where(catalog._in_partitions(catalog.with_digest(batch, ["nc", "v"], 1024), catalog.BUCKET))
    plan = known.select(catalog.BUCKET, catalog.DIGEST)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan and "more" not in plan.split("ReadSchema")[1]
    catalog.append_unseen(spark, path, batch, ["nc", "v"], "dt_ingest")
    catalog.append_unseen(spark, path, batch, ["nc", "v"], "dt_ingest")  # again: nothing
    expected = catalog.drop_copies(history.union(batch), ["nc", "v"], "dt_ingest")
    assert rows(catalog.read_landing(spark, path), "nc", "v", "dt_ingest") == rows(expected, "nc", "v", "dt_ingest")
    after = files_by_folder(tmp_path / "t")
    assert all(set(after[k]) >= set(v) for k, v in before.items())  # no file of the history was rewritten
    assert len({k for k in after if after[k] != before.get(k)}) <= 3


def test_history_rewrites_changed_buckets_only(spark, tmp_path, rows):
    path = str(tmp_path / "h")

    def state(changed, gone=()):
        return spark.createDataFrame([(i, "n" if i in changed else None, i) for i in range(500) if i not in gone], "id long, v string, w long")

    catalog.create_history(path, state(()), ["id"], F.lit("2024-01-01"))
    before = files_by_folder(tmp_path / "h")
    assert catalog.update_history(spark, path, state((), gone=(7, 8)), ["id"], ["v"], F.lit("2024-01-15")) == []  # vanished rows stay open
    assert files_by_folder(tmp_path / "h") == before
    touched = catalog.update_history(spark, path, state((3, 4)), ["id"], ["v"], F.lit("2024-02-01"))
    after = files_by_folder(tmp_path / "h")
    rewritten = {k for k in before if after[k] != before[k]}
    assert len(rewritten) == len(touched) <= 2 and len(after) == len(before) + len(touched)
    table = catalog.read_table(spark, path)
    assert table.count() == 502 and rows(table.where("valid_to is not null"), "id", "v") == [(3, None), (4, None)]
    assert rows(table.where("valid_to is null and id < 6"), "id", "v") == [(0, None), (1, None), (2, None), (3, "n"), (4, "n"), (5, None)]


def test_landing_rules_on_tables(spark, tmp_path, rows):
    path = lambda n: str(tmp_path / n)
    ddl = "id string, v string"
    for batch in ([("1", "a"), ("2", "a")], [("2", "b"), (None, "lost"), ("3", "b")], []):
        catalog.land_batch(spark, path("contratos"), "contratos", spark.createDataFrame(batch, ddl))
    assert rows(catalog.read_landing(spark, path("contratos"))) == [("1", "a"), ("2", "b"), ("3", "b")]
    for batch in ([("1", "a"), ("1", "b"), ("2", "a")], [("1", "c")]):
        catalog.land_batch(spark, path("d"), "dados_dependentes", spark.createDataFrame(batch, "cpf string, v string"))
    assert rows(catalog.read_landing(spark, path("d"))) == [("1", "c"), ("2", "a")]


def test_columns_are_kept_beside_the_table(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    catalog.write_table(spark.createDataFrame([(1, "a", 1)], "id int, v string, p int"), path, partition_by=["p"])
    catalog.write_table(spark.createDataFrame([(2, "n", 2)], "id int, note string, p int"), path, partition_by=["p"])
    catalog.write_table(spark.createDataFrame([(3, 1)], "id int, p int"), path, mode="append", partition_by=["p"])
    assert catalog.table_schema(spark, path).names == ["id", "v", "p", "note"]
    assert len(catalog.folder_names(spark, f"{path}/_schemas")) == 2  # the third write brought no column
    assert rows(catalog.read_table(spark, path), "id", "v", "note", "p") == [(1, "a", None, 1), (2, None, "n", 2), (3, None, None, 1)]
    with pytest.raises(ValueError, match="v: the table holds another type"):
        catalog.write_table(spark.createDataFrame([(4, 5, 3)], "id int, v int, p int"), path, partition_by=["p"])
    assert catalog.read_table(spark, path).count() == 3
    (tmp_path / "t" / "_schemas" / "000003.json").write_text('{"type":"stru')  # a writer that broke off
    catalog.write_table(spark.createDataFrame([(5, "x", 3)], "id int, later string, p int"), path, partition_by=["p"])
    assert catalog.table_schema(spark, path).names == ["id", "v", "p", "note", "later"]
    catalog.write_table(spark.createDataFrame([("new",)], "v string"), path)  # a full overwrite starts anew
    assert rows(catalog.read_table(spark, path)) == [("new",)]


def test_a_table_from_elsewhere_is_read_by_its_footers(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(path)
    spark.createDataFrame([(2, "b")], "id int, w string").write.mode("append").parquet(path)
    assert rows(catalog.read_table(spark, path).select("id", "v", "w")) == [(1, "a", None), (2, None, "b")]
    catalog.write_table(spark.createDataFrame([(3, "c")], "id int, x string"), path, mode="append")
    assert set(catalog.table_schema(spark, path).names) == {"id", "v", "w", "x"} and catalog.read_table(spark, path).count() == 3


def test_merge_rewrites_changed_buckets_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")

    def batch(changed=(), more=()):
        plain = [(i, str(i % 7), "new" if i in changed else None, 1.5) for i in range(300)]
        return spark.createDataFrame([*plain, *more], "k int, l string, v string, w double")

    keys, odd = ["k", "l"], [(None, "x", "odd", 0.0), (1, None, "odd", 0.0)]
    catalog.merge_table(spark, path, batch(more=odd), keys)
    before = files_by_folder(tmp_path / "t")
    assert catalog.merge_table(spark, path, batch(), keys) == [] and files_by_folder(tmp_path / "t") == before  # all of it again
    touched = catalog.merge_table(spark, path, batch((5, 6), [(999, "y", None, 2.0), *odd]), keys)
    after = files_by_folder(tmp_path / "t")
    assert 1 <= len(touched) <= 3
    assert {k for k in before if not set(before[k]) <= set(after[k])} <= {pathlib.Path(f"key_bucket={b}") for b in touched}
    expected = merge_rows(batch(more=odd), batch((5, 6), [(999, "y", None, 2.0), *odd]), keys)
    assert rows(catalog.read_landing(spark, path), "k", "l", "v", "w") == rows(expected, "k", "l", "v", "w")
    twice = str(tmp_path / "twice")
    for times in (2, 1):  # a first batch that holds a key twice, then the same again
        again = spark.createDataFrame([(1, "a", "x", 1.0)] * times, "k int, l string, v string, w double")
        catalog.merge_table(spark, twice, again, keys)
        assert catalog.read_landing(spark, twice).count() == times
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="not laid out"):
        catalog.merge_table(spark, str(tmp_path / "other"), batch(), keys)


def test_soap_undeclared_parses_only_what_holds_other_tags(spark, rows, monkeypatch):
    body = "<E><Body>{}</Body></E>"
    xml = [
        body.format("<R a='1'><x>1</x></R><R/>"), body.format("<R><n:x>2</n:x><y>b &lt; c</y></R>"), body.format("<R><x><![CDATA[<z>]]></x></R>"),
        body.format("<R><x>4</x><R><x>5</x></R></R>"), "<E></E>", None,
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xml)], "i int, xml string")
    kept, write = [], soap.kept_table
    monkeypatch.setattr(soap, "kept_table", lambda frame, name: kept.append(write(frame, name)) or kept[-1])
    got = soap.records(df, "xml", "R", ["x"], keep=["i"], undeclared=True)
    assert got.columns == ["i", "pos", "x", "r", "y"]
    assert rows(got, "i", "pos", "x", "y") == sorted([
        (0, 0, "1", None), (0, 1, None, None), (1, 0, "2", "b < c"), (2, 0, "<z>", None), (3, 0, "4", None), (3, 1, "5", None)], key=str)
    assert kept[0].where("_all is not null").select("i").distinct().count() == 3  # rows 1, 2 and 3 alone
    leaves = soap.flat_record(df, "xml", ["x"], keep=["i"], undeclared=True)
    assert rows(leaves) == sorted([(0, "1", None), (1, "2", "b < c"), (2, "<z>", None), (3, "5", None)], key=str)
    assert [k for k in kept[1].dtypes if k[0] == "_leaves"] == [("_leaves", "array<struct<tag:string,text:string>>")]
