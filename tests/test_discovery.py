"""Undeclared fields and refused rows: odd records, empty inputs, nothing lost and nothing doubled."""

import json

import pytest
from pyspark.sql import functions as F

from tributary.operators.keyed import NULL_KEY, upsert_sifted
from tributary.operators.refusals import sift
from tributary.plans.catalog import build_all, sift_lists
from tributary.sources import landing, soap
from tributary.streaming.landing import land_increment, read_refused


def land(spark, folder, lines, schema=""):
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(lines), encoding="utf-8")
    return landing.land_json_records(spark, str(folder), schema)


def test_keys_are_found_at_every_depth(spark, tmp_path):
    lines = [json.dumps(r) for r in [
        {"id": 1, "A": {"x": 1.10}}, {"id": 2, "A": {"x": None, "Y z": {"deep.er": True}}}, {"id": 3, "l": [{"k": 1}, 2], "e": {}},
        {"id": 4, "B`q": "é"}, {"id": 5, "items": [{"n": 1, "new": {"in": [1]}}, {"n": "text"}]}, {}]]
    got = land(spark, tmp_path / "in", lines, "id long, A struct<x: double>, items array<struct<n: int>>")
    rows = {r["id"]: r.asDict() for r in got.accepted.drop("dt_ingest").collect()}
    assert got.accepted.columns == ["id", "a__x", "a__y z__deep.er", "items", "b`q", "e", "l", "dt_ingest"]
    assert rows["1"]["a__x"] == "1.1" and rows["2"]["a__y z__deep.er"] == "true" and rows["3"]["l"] == '[{"k":1},2]' and rows["4"]["b`q"] == "é"
    assert set(rows) == {"1", "2", "3", "4", "5", None} and rows["5"]["items"][0]["new"]["in"] == "[1]" and rows["5"]["items"][1]["n"] is None and None in rows
    assert got.counts == {"not a JSON object": 0} and got.refused.count() == 0


def test_lines_that_are_no_records_are_refused(spark, tmp_path):
    lines = ['{"a": 1}', "", "   ", "[1, 2]", '"text"', "17", "null", '{"a": ', "{'a': 2}", '{"a": 3, "a": 4}', '{"A": 5}']
    got = land(spark, tmp_path / "in", lines, "a long")
    assert sorted(r.a or "" for r in got.accepted.collect()) == ["1", "2", "4", "5"]
    assert sorted(r.value for r in got.refused.collect()) == sorted(["[1, 2]", '"text"', "17", "null", '{"a": ']) and got.counts["not a JSON object"] == 5


def test_nothing_declared_and_nothing_landed(spark, tmp_path):
    assert land(spark, tmp_path / "one", ['{"b": 1, "a": {"c": "x"}}', '{"a": "y"}']).accepted.drop("dt_ingest").collect()[0].asDict().keys() == {"a", "b"}
    none = land(spark, tmp_path / "two", [], "id long")
    assert none.accepted.columns == ["id", "dt_ingest"] and none.accepted.count() == 0 and none.refused.count() == 0


def envelope(body):
    return f'<s:Envelope xmlns:s="u"><s:Body><r><out>{body}</out></r></s:Body></s:Envelope>'


def test_elements_of_one_name_inside_each_other(spark, rows):
    body = '<n:P a="1/2"><cod>1</cod><sub><P><cod>2</cod><P/></P></sub><obs tipo="x">b &amp; c</obs></n:P><P><cod>3</cod><sub>t<q>9</q></sub></P>'
    df = spark.createDataFrame([(1, envelope(body)), (2, envelope("<P><cod>4</cod></P>")), (3, "<fault/>"), (4, None)], "k int, xml string")
    assert rows(soap.records(df, "xml", "P", ["cod"], keep=["k"])) == [(1, 0, "1"), (1, 1, "2"), (1, 2, None), (1, 3, "3"), (2, 0, "4")]
    found = soap.records(df, "xml", "P", ["cod"], keep=["k"], undeclared=True)
    assert found.columns == ["k", "pos", "cod", "P".lower(), "obs", "sub"]
    assert {(r.k, r.pos, r.obs, r.sub) for r in found.collect()} == {(1, 0, "b & c", ""), (1, 1, None, None), (1, 2, None, None), (1, 3, None, "t"), (2, 0, None, None)}


def test_leaves_are_found(spark, rows):
    df = spark.createDataFrame([(envelope("<cod>1</cod><Novo> x &lt; y </Novo><g><Novo/><fim>7</fim></g>"),), (envelope("<vazio> </vazio>"),), ("<fault/>",)], "xml string")
    flat = soap.flat_record(df, "xml", ["cod"], undeclared=True)
    assert flat.columns == ["cod", "novo", "fim"][:1] + sorted(["novo", "fim"], key=lambda n: {"novo": "Novo", "fim": "fim"}[n])
    assert {(r.cod, r.novo, r.fim) for r in flat.collect()} == {("1", "x < y", "7"), (None, None, None)}


def test_every_row_is_on_one_side(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "x", i % 5) for i in range(100)], "id int, t string, n int")
    got = sift(df, {"no text": F.col("t").isNull(), "four": F.col("n") == 4})
    refused = {(r.id, r.refused_because) for r in got.refused.collect()}
    assert refused == {(i, "no text" if i % 3 == 0 else "four") for i in range(100) if i % 3 == 0 or i % 5 == 4}
    assert {r.id for r in got.accepted.collect()} == set(range(100)) - {i for i, _ in refused} and got.accepted.columns == df.columns
    assert got.counts == {"no text": 34, "four": 13}
    none = sift(df.limit(0), {"no text": F.col("t").isNull()})
    assert none.accepted.count() == none.refused.count() == 0 and none.counts == {"no text": 0}
    with pytest.raises(ValueError, match="refused_because"):
        sift(got.refused, {"x": F.lit(True)})


def test_upsert_names_what_it_refuses(spark, rows):
    current = spark.createDataFrame([(1, "a", "old")], "k int, l string, v string")
    batch = spark.createDataFrame([(1, "a", "new"), (None, "a", "x"), (2, None, "y"), (3, "c", "z")], current.schema)
    after, sifted = upsert_sifted(current, batch, ["k", "l"])
    assert rows(after) == [(1, "a", "new"), (3, "c", "z")] and sifted.counts == {NULL_KEY: 2}
    assert rows(sifted.refused) == [(2, None, "y", NULL_KEY), (None, "a", "x", NULL_KEY)]


def test_products_leave_unread_lists_behind(spark, tmp_path):
    good = "[{'id_empenho': '1', 'numero_empenho': '2023ne1', 'valor_empenho': None, 'subelemento': '01'}]"
    raw = spark.createDataFrame([("1", good), ("2", "[{'id_empenho': "), ("3", "[]"), ("4", None), ("5", " ")], "id string, dados_empenho string")
    sifted = sift_lists("faturas", raw)
    assert [r.id for r in sifted.refused.collect()] == ["2"] and sifted.accepted.count() == 4
    fields = "contrato_id numero emissao vencimento valor juros multa glosa valorliquido situacao mesref anoref prazo protocolo ateste processo tipolistafatura_id justificativafatura_id sfpadrao_id tipo_de_instrumento_de_cobranca chave_nfe informacao_complementar repactuacao infcomplementar serie dados_referencia dados_item_faturado".split()
    whole = raw.select("*", *[F.lit(None).cast("string").alias(f) for f in fields])
    built = build_all(lambda _: whole, str(tmp_path), ["faturas"])
    assert built["faturas"].count() == 1
    assert [(r.id, r.refused_because) for r in spark.read.parquet(f"{tmp_path}/refused/faturas").collect()] == [("2", "list does not parse")]


def test_stream_without_refusals_has_none_to_read(spark, tmp_path):
    spark.createDataFrame([(1, 1)], "k long, at long").write.json(str(tmp_path / "in"))
    land_increment(spark, str(tmp_path / "in"), "k long, at long", str(tmp_path / "t"), str(tmp_path / "c"), ["k"], "at", refused=str(tmp_path / "no"))
    assert read_refused(spark, str(tmp_path / "no"), "k long, at long").count() == 0
