"""Data products on micro-fixtures with hand-computed results, one test per rule that is easy to lose."""

from datetime import date, datetime
from decimal import Decimal as D
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tributary.plans import budget, checks, contracts, people, transfers
from tributary.plans.catalog import PRODUCTS, build_all, product


def text_frame(spark, *records):
    """All-text raw table from dicts; absent values are null."""
    names = list(dict.fromkeys(k for r in records for k in r))
    ddl = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ddl)


# ------------------------------------------------------------------ contracts


def test_contract_typing(spark):
    raw = text_frame(
        spark,
        {"id": "1", "valor_global": "1.234,56", "data_assinatura": "2024-01-31", "vigencia_fim": "31/01/2024",
         "processo": "23000.1/2020-10", "fornecedor__cnpj_cpf_idgener": "12.3/4-x", "num_parcelas": "x"},
    )
    row = contracts.contratos(raw).first()
    assert row["valor_global"] == D("1234.56") and row["data_assinatura"] == date(2024, 1, 31)
    assert row["vigencia_fim"] is None and row["processo"] == "230001202010" and row["num_parcelas"] is None
    assert row["fornecedor_cnpj_cpf_idgener"] == "1234x" and row["valor_inicial"] is None


def test_schedule_is_distinct(spark):
    line = {"id": "1", "contrato_id": "5", "valor": "10,00", "vencimento": "2024-01-01"}
    assert contracts.cronogramas(text_frame(spark, line, line, {**line, "vencimento": "2024-01-15"})).count() == 2


def test_invoices_unfold_and_drop_those_without_commitment(spark, rows):
    two = "[{'id_empenho': '1', 'numero_empenho': '2024ne1', 'valor_empenho': '1,00', 'subelemento': None}, {'id_empenho': '2', 'numero_empenho': None, 'valor_empenho': None, 'subelemento': '01'}]"
    raw = text_frame(spark, {"id": "1", "dados_empenho": two}, {"id": "2", "dados_empenho": "[]"}, {"id": "3", "dados_empenho": None})
    expected = [(1, "1", "2024NE1", None), (1, "2", None, "01")]
    assert rows(contracts.faturas(raw), "id", "id_empenho", "numero_empenho", "subelemento") == expected
    native = raw.withColumn("dados_empenho", F.from_json(
        F.when(F.col("id") == "1", '[{"id_empenho":"1"}]'), "array<struct<id_empenho:string,numero_empenho:string,valor_empenho:string,subelemento:string>>"))
    assert rows(contracts.faturas(native), "id", "id_empenho") == [(1, "1")]


TREASURY = {
    "emissao_mes": "MAR/2024", "emissao_dia": "15/03/2024", "ne_ccor": "113601000012024NE000001", "ne_num_processo": "23000.1",
    "ne_info_complementar": "texto", "doc_observacao": "o", "natureza_despesa": "33", "ne_ccor_favorecido": "s1",
    "ne_ccor_ano_emissao": "2024", "despesas_empenhadas": "(1.234,56)", "despesas_liquidadas": " ", "despesas_pagas": "NaN",
    "restos_a_pagar_inscritos": "5,00", "restos_a_pagar_pagos": None,
}


def treasury(spark, *changes, **options):
    return contracts.empenhos_tesouro(text_frame(spark, *[{**TREASURY, **c} for c in changes]), **options)


def test_treasury_typing_and_year_filter(spark):
    df = treasury(spark, {}, {"ne_ccor_ano_emissao": "-9"}, {"ne_ccor_ano_emissao": None})
    row = df.first()
    assert df.count() == 1 and row["ne_ccor_favorecido"] == "S1" and row["ne_ccor_ano_emissao"] == 2024
    assert [row[c] for c in ("despesas_empenhadas", "despesas_liquidadas", "despesas_pagas", "restos_a_pagar_pagos")] == [
        D("-1234.56"), D("0.00"), D("0.00"), D("0.00")]


def test_treasury_process_separator_option(spark):
    first = treasury(spark, {"ne_num_processo": "23000.1/2020-10"}).first()
    every = treasury(spark, {"ne_num_processo": "23000.1/2020-10"}, first_separator_only=False).first()
    assert (first["ne_num_processo"], every["ne_num_processo"]) == ("230001/2020-10", "230001202010")


def test_treasury_merge_appends_null_keys(spark):
    once = treasury(spark, {}, {"doc_observacao": None})
    twice = contracts.empenhos_tesouro(
        text_frame(spark, {**TREASURY, "ptres": "new"}, {**TREASURY, "doc_observacao": None, "ptres": "new"}), current=once)
    assert sorted((r["doc_observacao"] or "", r["ptres"] or "") for r in twice.collect()) == [("", ""), ("", "new"), ("o", "new")]


def ids_frame(spark, *tuples):
    return spark.createDataFrame(
        list(tuples), "contrato_id string, categoria string, processo string, cnpj_cpf string, info_complementar string, ne string")


def test_identifiers(spark, rows):
    raw = text_frame(
        spark,
        {"id": "1", "numero": "2024NE000009", "codigo_modalidade": "05", "contratante__orgao__unidade_gestora__codigo": "11", "processo": "1.2", "fornecedor__cnpj_cpf_idgener": "9"},
        {"id": "2", "numero": "3/2024", "licitacao_numero": "7/2023", "codigo_modalidade": "07", "processo": "x"},
        {"id": "3", "numero": "4/2024", "codigo_modalidade": "12"},
    )
    commitments = text_frame(spark, {"id": "1", "contrato_id": "2", "numero": "2024ne1"}, {"id": "2", "contrato_id": "2", "numero": None}, {"id": "3", "contrato_id": "99", "numero": "2024ne3"})
    invoices = text_frame(spark, {"id": "1", "contrato_id": "2", "dados_empenho": "[{'numero_empenho': '2024ne1'}, {'numero_empenho': None}, {'numero_empenho': '2024ne2'}]"})
    got = contracts.identificadores(contracts.contratos(raw), contracts.empenhos(commitments), contracts.faturas(invoices))
    assert rows(got, "contrato_id", "info_complementar", "ne") == sorted([
        ("1", "11052024NE000009", "2024NE000009"), ("2", "0772023", "2024NE1"), ("2", "0772023", "2024NE2"),
        ("2", "0772023", None), ("2", "0772023", None),  # a null number of each source stays apart
        ("3", None, None), (None, None, "2024NE3"),
    ], key=str)


def test_contract_linkage_passes(spark, rows):
    ids = ids_frame(
        spark,
        ("c1", "x", "p0", "S1", None, "2024NE000001"),
        ("c2", "x", "230001", "S2", None, None),         # one contract of its process
        ("c3", "x", "p3", "S3", None, None),             # one contract of its supplier
        ("c4", "x", "p4", "S4", "777", None), ("c5", "x", "p4", "S4", "778", None),
        ("c6", "x", "p6", "S6", None, "2024NE000099"),   # number the treasury does not know
        (None, None, None, None, None, "2024NE000050"),
    )
    e = lambda n, **kw: {"ne_ccor": f"113601000012024ne{n:06d}", "ne_num_processo": "none", **kw}
    facts = treasury(
        spark,
        e(1), e(1, ne_ccor_favorecido="zz"),             # linked once, and a second supplier that stays in the residue
        e(2, ne_num_processo="23000.1", ne_ccor_favorecido="s9"),
        e(3, ne_ccor_favorecido="s3"),
        e(4, ne_ccor_favorecido="s4", ne_info_complementar="777 - texto"),
        e(5, ne_ccor_favorecido="s4", ne_info_complementar="texto 777 - "),
        e(6, ne_ccor_favorecido=None, ne_num_processo="23000.1"),   # no supplier: never in the residue
    )
    got = contracts.contratos_empenhos(ids, facts)
    assert rows(got, "contrato_id", "ne_transformed", "ne_ccor_favorecido") == sorted([
        ("c1", "2024NE000001", "S1"), ("c6", "2024NE000099", None), ("c2", "2024NE000002", "S9"),
        ("c3", "2024NE000003", "S3"), ("c4", "2024NE000004", "S4"),
    ], key=str)


def test_linkage_number_with_two_suppliers_links_twice(spark, rows):
    """The residue holds every number with some unmatched row, also numbers linked before."""
    ids = ids_frame(spark, ("c1", "x", "p0", "S1", None, "2024NE000001"), ("c2", "x", "p1", "S2", None, None))
    facts = treasury(spark, {"ne_num_processo": "n"}, {"ne_num_processo": "n", "ne_ccor_favorecido": "s2"})
    got = contracts.contratos_empenhos(ids, facts)
    assert rows(got, "contrato_id", "ne_ccor_favorecido") == [("c1", "S1"), ("c2", "S2")]


def test_monthly_stages_carry_over(spark, rows):
    df = contracts.estagios_mensal(treasury(
        spark,
        {"despesas_pagas": "10,00"}, {"despesas_pagas": "1,00"},
        {"emissao_dia": "000/2024", "emissao_mes": "000/2024", "despesas_pagas": "7,00", "restos_a_pagar_inscritos": "3,00"},
        {"ne_ccor": "Total"},
    ))
    assert rows(df, "ne", "mes_lancamento", "valor_pago", "restos_a_pagar") == [
        ("2024NE000001", date(2023, 12, 1), D("7.00"), D("-3.00")),
        ("2024NE000001", date(2024, 1, 1), D("7.00"), D("3.00")),
        ("2024NE000001", date(2024, 3, 1), D("11.00"), D("10.00")),
    ]


def stage(spark, *tuples):
    values = ", ".join(f"{v} decimal(25,2)" for v in contracts.STAGE_VALUES)
    ddl = f"ne string, cnpj_cpf string, info_complementar string, num_processo string, mes_lancamento date, {values}"
    return spark.createDataFrame([(*t, date(2024, 1, 1), *[D(n)] * 5) for n, t in enumerate(tuples, 1)], ddl)


def test_stage_linkage(spark, rows):
    ids = ids_frame(
        spark, ("c1", "x", "p1", "s", "r1", "n1"), ("c2", "x", "p2", "s", "r2", "n2"),
        ("c3", "Cessão", "p3", "s", "r3", "n3"), ("c4", None, "p4", "s", "r4", "n4"))
    stages = stage(
        spark, ("n1", "s", "r9", "p9"), ("n8", "s", "r9", "p2"), ("n8", "s", "r1", "p1"),
        ("n3", "s", "r3", "p3"), ("n4", "s", "r4", "p4"))
    # n1 by number; p2 by process; p1 belongs to a contract already linked, so only its reference finds it.
    got = contracts.contratos_estagios(ids, stages)
    assert rows(got, "contrato_id", "valor_pago") == [("c1", D("4.00")), ("c2", D("2.00"))]
    strict = contracts.contratos_estagios(ids, stages, unlinked_only=True)
    assert rows(strict, "contrato_id", "valor_pago") == [("c1", D("1.00")), ("c2", D("2.00"))]


def test_schedule_against_invoices(spark, rows):
    schedule = contracts.cronogramas(text_frame(
        spark, {"id": "1", "contrato_id": "5", "valor": "100,00", "vencimento": "2024-03-01"},
        {"id": "2", "contrato_id": "5", "valor": "50,00", "vencimento": "2024-04-15"}))
    bill = {"contrato_id": "5", "juros": "1,00", "multa": "1,00", "glosa": "0,00", "valorliquido": "8,00", "emissao": "2024-03-20"}
    invoices = text_frame(
        spark, {**bill, "situacao": "Pago"}, {**bill, "situacao": "Pago", "multa": None}, {**bill, "situacao": "Pendente"},
        {**bill, "situacao": "Outro"}, {**bill, "situacao": "Pago", "emissao": "2024-04-10"})
    columns = ["mes_ref", "valor_faturas_pagas", "valor_faturas_pendentes", "saldo_contratual_disponivel"]
    assert rows(contracts.cronogramas_faturas_mensal(schedule, invoices), *columns) == [
        (date(2024, 3, 1), D("10.00"), D("10.00"), D("80.00")), (date(2024, 4, 15), D("0.00"), D("0.00"), D("50.00"))]
    assert rows(contracts.cronogramas_faturas_mensal(schedule, invoices, truncate_month=True), *columns)[1] == (
        date(2024, 4, 1), D("10.00"), D("0.00"), D("40.00"))


def test_contract_card_flags(spark, rows):
    raw = text_frame(
        spark,
        {"id": "1", "vigencia_inicio": "2020-01-01", "vigencia_fim": "2021-12-31", "num_parcelas": "2", "valor_global": "10,00", "fornecedor__tipo": "IDGENERICO"},
        {"id": "2", "vigencia_inicio": "2020-01-01", "vigencia_fim": "2021-12-30", "num_parcelas": "2", "valor_global": "10,00"},
        {"id": "3", "vigencia_inicio": "2020-01-01", "vigencia_fim": "2021-12-31", "num_parcelas": "1", "valor_global": None})
    linked = spark.createDataFrame([("1", D("4.00")), ("1", D("6.00")), ("2", D("1.00")), (None, D("9.00"))], "contrato_id string, despesas_pagas decimal(15,2)")
    got = contracts.contratos_resumo(contracts.contratos(raw), linked)
    assert rows(got, "contrato_id", "pendente_baixa", "continuado", "fornecedor_tipo", "Unidade") == [
        ("1", "Sim", "Sim", "Empresa do Exterior", " - "), ("2", "Não", "Não", None, " - "), ("3", "Não", "Não", None, " - ")]


# ------------------------------------------------------------------ budget, transfers


def test_budget(spark):
    row = budget.visao_orcamentaria_total(text_frame(
        spark, {"ano_exercicio": "2024", "dotacao_inicial": "1.000,00", "despesas_pagas": "", "dt_ingest": "2024-01-01T10:00:00"})).first()
    assert row["dotacao_inicial"] == D("1000.00") and row["despesas_pagas"] == D("0.00") and row["dt_ingest"] == datetime(2024, 1, 1, 10)


def test_transfer_to_plan_prefers_a_plan(spark, rows):
    notes = text_frame(spark, {"id_plano_acao": "20", "tx_numero_nota": "2024NC000001", "cd_ug_emitente_nota": "110001"},
                       {"id_plano_acao": None, "tx_numero_nota": "2024NC000002", "cd_ug_emitente_nota": "110001"}, {"id_plano_acao": "30", "tx_numero_nota": None, "cd_ug_emitente_nota": "110001"})
    nc = lambda n, t: {"nc": f"110001000012024NC{n:06d}", "nc_transferencia": t}
    raw = text_frame(spark, nc(1, "T1"), nc(2, "T1"), nc(2, "T2"), nc(3, "T3"), nc(1, "-8"), nc(1, None))
    assert rows(transfers.num_transf_n_plano_acao(notes, raw)) == sorted([("T1", "20"), ("T2", None), ("T3", None)], key=str)


@pytest.mark.parametrize("description, number, note", [
    ("TRANSFERENCIA 123456 REF", "123456", ""), ("TED 1AAXYZ, X", "1AAXYZ", ""), ("TRANSF. 123.456", "123456", ""),
    ("TED Nº1ÇÃÉÍÓ-", "1ÇÃÉÍÓ", ""), ("NOTA 2024NC000123", None, "2024NC000123"), ("NUMERO 1234567", None, None), ("nada", None, None),
])
def test_transfer_numbers_in_free_text(spark, description, number, note):
    plans = spark.createDataFrame([("123456", "9"), ("1AAXYZ", None)], "num_transf string, plano_acao string")
    got = transfers.empenhos_plano_acao(treasury(spark, {"ne_ccor_descricao": description}), plans).collect()
    if number is None and note is None:
        assert got == []
        return
    expected = note[:7] + "0" + note[-4:] if note else ""
    assert [(r["num_transf"], r["nc"], r["plano_acao"]) for r in got] == [(number, expected, "9" if number == "123456" else None)]


def test_credit_note_signs_and_dates(spark, rows):
    base = {"nc": "110001000012024NC000001", "nc_transferencia": "T1", "nc_valor_linha": "10,50", "emissao_mes": "000/2024", "emissao_dia": "05/02/2024"}
    raw = text_frame(spark, *[{**base, "nc_evento": e} for e in ("300302", "300308", "300311", "300083", "300301", None)], {**base, "nc_transferencia": "-8"})
    typed = transfers.nc_tesouro(raw)
    assert typed.first()["emissao_mes"] == date(2023, 12, 1) and typed.first()["emissao_dia"] == date(2024, 2, 5)
    got = transfers.nc_plano_acao(typed, spark.createDataFrame([("T1", "20")], "num_transf string, plano_acao string"))
    assert rows(got.groupBy("nc_valor", "plano_acao", "nc", "ug_emitente").count()) == [
        (D("-10.50"), "20", "2024NC000001", "110001", 4), (D("10.50"), "20", "2024NC000001", "110001", 2)]


def test_programmings_by_two_routes(spark, rows):
    pf = transfers.pf_tesouro(text_frame(
        spark, {"pf": "113601000012024PF000001", "ug_emitente": "11", "pf_inscricao": "T1", "pf_acao_descricao": "DEVOLUÇÃO DE RECURSO", "pf_valor_linha": "1,00"},
        {"pf": "113601000012024PF000002", "ug_emitente": "11", "pf_inscricao": "T2", "pf_acao_descricao": "OUTRA", "pf_valor_linha": "2,00"}))
    documents = text_frame(spark, {"tx_numero_programacao": "2024PF000001", "ug_emitente_programacao": "11", "id_plano_acao": "20"})
    plans = spark.createDataFrame([("T1", "20"), ("T2", None)], "num_transf string, plano_acao string")
    got = transfers.pf_plano_acao(pf, documents, plans)
    assert rows(got, "pf", "pf_acao", "plano_acao") == [("2024PF000001", "DEVOLUÇÃO", "20"), ("2024PF000002", None, None)]


def test_transfer_summary(spark, rows):
    plans = transfers.planos_acao(text_frame(
        spark, {"id_plano_acao": "1", "sigla_unidade_descentralizada": "IPEA", "vl_total_plano_acao": "100.5", "dt_inicio_vigencia": "2024-05-01"},
        {"id_plano_acao": "2", "sigla_unidade_descentralizada": None}))
    assert plans.where("id_plano_acao = '1'").first()["dt_inicio_vigencia"] == date(2024, 5, 1)
    money = "decimal(15,2)"
    notes = spark.createDataFrame(
        [("1", "T", "300300", "1", D(10)), ("1", "T", "300301", "1", D(4)), ("1", "T", None, "1", D(99)), ("1", "T", "300300", "-9", D(7)), (None, "N", "300300", "1", D(3))],
        f"plano_acao string, num_transf string, nc_evento string, ptres string, nc_valor {money}")
    commitments = spark.createDataFrame(
        [("1", "T", D(10), D(1), D(1), D(1), D(1)), ("1", "T", D(-3), D(1), D(1), D(1), D(1)), (None, None, D(5), D(1), D(1), D(1), D(1))],
        f"plano_acao string, num_transf string, despesas_empenhadas {money}, despesas_pagas {money}, restos_a_pagar_pagos {money}, restos_a_pagar_inscritos {money}, despesas_liquidadas {money}")
    finance = spark.createDataFrame([("1", "T", "TRANSFERENCIA", D(8)), ("1", "T", "DEVOLUCAO", D(2))], f"plano_acao string, num_transf string, pf_acao string, pf_valor_linha {money}")
    got = transfers.ted_resumo_orcamentario(plans, notes, commitments, finance)
    columns = ["plano_acao", "num_transf", "ted_beneficiario_emitente", "valor_firmado", "orcamento_recebido", "orcamento_devolvido",
               "empenhado", "empenho_anulado", "financeiro_recebido", "financeiro_devolvido", "financeiro_cancelado"]
    assert rows(got, *columns) == sorted([
        ("1", "T", "beneficiario", D("100.50"), D("10.00"), D("4.00"), D("10.00"), D("3.00"), D("8.00"), D("2.00"), D("0.00")),
        ("2", None, "emitente", None, None, None, None, None, None, None, None),
        (None, "N", "nao_indicado", None, D("3.00"), D("0.00"), None, None, None, None, None),
    ], key=str)


# ------------------------------------------------------------------ people


def test_leave_prefers_current_source(spark, rows):
    current = people.dados_afastamento(text_frame(
        spark, {"cpf": "1-1", "dataini": "01022024", "qtdedias": "3", "grmatricula": "m"}, {"cpf": "11", "dataini": "0", "qtdedias": "4"}))
    past = people.afastamento_historico(text_frame(
        spark, {"cpf": "11", "dataini": "01022024", "qtdedias": "NaN"}, {"cpf": "11", "dataini": "02022024", "qtdedias": " [null] "},
        {"cpf": "11", "dataini": "02022024", "qtdedias": "9"}))
    persons = people.dados_pessoais(text_frame(spark, {"cpf": "11", "nome": "Ana"}))
    employment = people.dados_funcionais(text_frame(spark, {"cpf": "11", "codfuncao": "F"}))
    got = people.afastamento_consolidado(current, past, persons, employment)
    assert rows(got, "dt_ini", "origem_dados", "gr_matricula", "nome_pessoa", "cod_funcao", "qtde_dias") == sorted([
        (date(2024, 2, 1), "dados_afastamento", "m", "Ana", "F", 3), (date(2024, 2, 2), "afastamento_historico", None, "Ana", "F", 9),
        (None, "dados_afastamento", None, "Ana", "F", 4)], key=str)


def test_deepest_unit_wins_as_a_number(spark, rows):
    posts = "[{'denominacao': 'D', 'funcao': 'FCE 1 13', 'instancias': [{'codigoInstancia': 'i', 'nomeTitular': None, 'cpfTitular': '1'}]}]"
    raw = text_frame(spark, {"codigounidade": "a", "ordem_grandeza": "9", "cargos": posts}, {"codigounidade": "b", "ordem_grandeza": "10", "cargos": posts}, {"codigounidade": "c", "cargos": "[]"})
    assert rows(people.estrutura_organizacional_cargos(raw), "codigounidade", "codigo_instancia", "cpf_titular") == [("b", "i", "1")]


def org(spark):
    units = people.unidade_organizacional(text_frame(
        spark, {"codigounidade": "u/7", "sigla": "RAIZ", "nome": "Raiz"}, {"codigounidade": "u/8", "codigounidadepai": "u/7", "sigla": "GABIN-IPEA", "nome": "Gabinete"},
        {"codigounidade": "u/9", "codigounidadepai": "u/1", "sigla": "ORFA"}))
    instance = lambda i: "{'codigoInstancia': '%s', 'nomeTitular': None, 'cpfTitular': None}" % i
    posts = people.estrutura_organizacional_cargos(text_frame(spark, {
        "codigounidade": "8", "nomeunidade": "Gabinete", "siglaunidade": "GABIN-IPEA", "ordem_grandeza": "2",
        "cargos": "[{'denominacao': 'Chefe', 'funcao': 'FCE 1 13', 'instancias': [%s, %s]}]" % (instance("i1"), instance("i2"))}))
    persons = people.dados_pessoais(text_frame(spark, *[{"cpf": str(n), "nome": f"P{n}"} for n in range(1, 6)]))
    base = {"codfuncao": "FCE0113", "siglauorgexercicio": "GABIN", "nomecargo": "Analista", "nomesitfuncional": "ATIVO", "cpfchefiaimediata": "5"}
    employment = people.dados_funcionais(text_frame(
        spark, *[{**base, "cpf": str(n)} for n in (1, 2, 3)], {**base, "cpf": "4", "dataocorraposentadoria": "01012020"},
        {**base, "cpf": "5", "codfuncao": None, "nomesitfuncional": "ATIVO EM OUTRO ORGAO"}))
    return units, posts, persons, employment


def test_unit_tree(spark, rows):
    assert rows(org(spark)[0], "codigounidade", "ordem_grandeza", "caminho_unidade") == [("7", 1, "RAIZ"), ("8", 2, "RAIZ-GABIN")]


def test_kth_post_meets_kth_holder(spark, rows):
    units, posts, persons, employment = org(spark)
    got = people.tabela_correlacao_cargos(posts, units, employment, persons)
    assert rows(got, "cpf", "codigo_siorg", "codigo_combinacao_siape", "nome_cargo", "hierarquia_cargo", "nome_chefia", "siglaunidade") == [
        ("1", "FCE113", "F113", "Chefe", 987, "P5", "GABIN"), ("2", "FCE113", "F113", "Chefe", 987, "P5", "GABIN"),
        ("3", None, "F113", "Analista", None, "P5", "GABIN")]


def test_hierarchy_of_active_staff(spark, rows):
    units, posts, persons, employment = org(spark)
    got = people.hierarquia(posts, units, employment, persons)
    assert rows(got, "cpf", "codigo_siorg", "servidores_carreira") == [(c, "FCE113", "Carreira") for c in "123"]


def test_hierarchy_pairs_are_not_shuffled_and_their_repeats_go(spark):
    units, posts, persons, employment = org(spark)
    post = posts.first().asDict()
    odd = [{**post, **change} for change in ({"denominacao": None}, {"nomeunidade": None}, {"denominacao": "Analista"}, {"funcao": "FCE 1 10", "denominacao": "Vice"}, {"funcao": "CCE 1 07", "denominacao": None})]
    posts = posts.union(spark.createDataFrame(odd, posts.schema))
    persons = persons.union(persons.where("cpf = '5'").withColumn("nome_pessoa", F.lit("outro"))).union(persons.where("cpf = '5'"))
    active = employment.where("cpf = '1'")
    more = [active.withColumn("cod_funcao", F.lit(code)).withColumn("nome_cargo", F.lit(job)) for code in ("FCE0110", "CCE0107", "FCE0113", "X9") for job in ("Analista", "Auditor", None)]
    employment = reduce(lambda a, b: a.union(b), [employment, *more])

    pairs = people._holders(
        employment.where("dt_ocorr_aposentadoria is null and dt_ocorr_exclusao is null"), persons, units,
    ).join(people._post_places(posts, units), F.expr("codigo_combinacao_siape = codigo_combinacao_siorg and sigla_uorg_exercicio = siglaunidade"), "left")
    expected = people._correlated(pairs, persons).where("nome_situacao_funcional <> 'ATIVO EM OUTRO ORGAO'")
    got = people.hierarquia(posts, units, employment, persons)
    assert got.columns == expected.columns
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str) and got.count() > 20
    shape = got._jdf.queryExecution().optimizedPlan().toString()
    assert shape.index("Union") < shape.index("Aggregate")  # only rows beside posts with gaps, and those without a post, are folded


def test_posts_offered_and_occupied(spark, rows):
    _, posts, _, employment = org(spark)
    got = people.quantitativo_alocados_ocupados(employment, posts)
    assert rows(got, "codigo_siape", "siglaunidade", "qtd_vagas_cargo", "qtd_vagas_ocupadas", "qtd_cargos_vagos") == [("FCE0113", "GABIN", 2, 3, -1)]


def test_wide_view_fans_out_and_headcount_does_not(spark, rows):
    _, posts, persons, employment = org(spark)
    listed = people.lista_servidores(text_frame(spark, {"cpf": "1", "coduorg": "a"}, {"cpf": "1", "coduorg": "b"}))
    school = people.dados_escolares(text_frame(spark, {"cpf": "1", "codescolaridade": "9"}))
    place = people.dados_uorg(text_frame(spark, {"cpf": "1", "ufuorg": " df ", "complementouorg": "---"}))
    wide = people.servidores_detalhados(persons, employment, school, listed, place)
    assert len(wide.columns) == 109
    assert rows(wide.where("cpf = '1'"), "uf_uorg", "complemento_endereco_uorg", "cod_escolaridade_principal") == [("DF", None, "9")] * 2
    count = people.resumo_quadro_pessoal(wide)
    assert sum(r["quantidade_servidores"] for r in count.collect()) == 5
    assert ("Analista", "N/A", "ATIVO", "DF", 1) in rows(count)
    joined = people.cargos_consolidado(wide, posts.withColumn("cpf_titular", F.lit("2")))
    assert rows(joined.where("siorg_cod_unidade is not null"), "siape_cpf", "siorg_cod_instancia_cargo") == [("2", "i1"), ("2", "i2")]


def test_retired_staff_length_of_service(spark, rows):
    persons = people.dados_pessoais(text_frame(spark, {"cpf": "1", "nome": "A"}, {"cpf": "2", "nome": "B"}))
    employment = people.dados_funcionais(text_frame(
        spark, {"cpf": "1", "dataocorraposentadoria": "01062004", "dataocorringressoservpublico": "30041990", "codclasse": "S", "codpadrao": "III", "percentualts": "12,5", "valorvaletransporte": "1,75"}, {"cpf": "2"}))
    assert employment.where("cpf = '1'").first()["percentual_ts"] == D("0.125000")
    nothing = text_frame(spark, {"cpf": "0"})
    wide = people.servidores_detalhados(persons, employment, people.dados_escolares(nothing), people.lista_servidores(nothing), people.dados_uorg(nothing))
    assert rows(people.aposentadorias_resumo(wide), "cpf", "diff_anos", "diff_meses", "diff_dias", "mes_aposentadoria", "classe_padrao") == [
        ("1", 14, 1, 1, datetime(2004, 6, 1), "S-III")]


def test_unit_crosswalk(spark, rows):
    place = people.dados_uorg(text_frame(spark, {"cpf": "1", "codorgao": "20", "codorgaouorg": "200000005", "siglauorg": "GABIN"}, {"cpf": "2", "codorgao": "20", "codorgaouorg": "200000006", "siglauorg": "X"}))
    listed = people.lista_uorgs(text_frame(spark, {"codigo": "0000005", "nome": "Gab"}, {"codigo": "6", "nome": "Xis"}, {"codigo": "7", "nome": "sem uso"}))
    got = people.unidades_organizacionais_siorg_siape(place, listed, org(spark)[0])
    assert rows(got, "nome_unidade", "codigo_unidade_siape", "codigo_unidade_siorg", "tipo_correlacao") == sorted([
        ("Gab", 5, "8", "ambos"), ("Xis", 6, None, "apenas_siape"), ("Raiz", None, "7", "apenas_siorg")], key=str)


def test_other_personnel_tables(spark):
    dependant = people.dados_dependentes(text_frame(spark, {"cpf": "1.1", "nome": "NaN", "datafim": "00000000", "datainicio": "01022020"})).first()
    assert (dependant["cpf"], dependant["nome_dependente"], dependant["dt_fim"], dependant["dt_inicio"]) == ("11", None, None, date(2020, 2, 1))
    pay = people.dados_financeiros(text_frame(spark, {"valorrubrica": "1.234,5", "dataanomesrubrica": "fev2024", "mesanopagamento": "XXX2024"})).first()
    assert (pay["valor_rubrica"], pay["data_anomes_rubrica"], pay["mes_ano_pagamento"]) == (D("1234.50"), date(2024, 2, 1), None)
    cv = people.dados_curriculo(text_frame(spark, {"dataconclusao": "202402", "datainicio": " "})).first()
    assert (cv["dt_mes_conclusao"], cv["dt_mes_inicio"]) == (date(2024, 2, 1), None)
    alimony = people.dados_pa(text_frame(spark, {"contabeneficiario": " 12-3x", "agenciabeneficiario": "001-9"})).first()
    assert (alimony["conta_beneficiario"], alimony["agencia_beneficiario"]) == ("123X", "0019")
    hired = people.terceirizados(text_frame(spark, {"usuario": "123 - Ana - B", "salario": "1.000,00", "data_inicio": "2024-05-02"}, )).first()
    assert (hired["cpf"], hired["nome"], hired["salario"], hired["data_inicio"]) == ("123 - Ana", "Ana - B", D("1000.00"), date(2024, 5, 2))
    post = people.cargos_funcoes(text_frame(spark, {"codigotipo": "1", "denominacoes__denominacao": "[{'codigo': '5', 'descricao': None}]"})).first()
    assert (post["denominacao_codigo"], post["denominacao_descricao"]) == ("5", None)


# ------------------------------------------------------------------ all together


def test_every_product_is_listed_once():
    assert len(PRODUCTS) == 49
    known = set(PRODUCTS)
    seen = set()
    for name, entry in PRODUCTS.items():
        assert all(i.startswith("raw.") or i in seen for i in entry.inputs), name
        seen.add(name)
    assert seen == known


def test_build_all_and_declared_checks(spark, tmp_path):
    from tributary.workload.derived import raw_reader

    raw = raw_reader(spark, "/root/testdata/sf0.001")
    names = ["contratos", "cronogramas", "empenhos", "empenhos_tesouro", "faturas", "identificadores", "estagios_mensal",
             "contratos_estagios", "contratos_empenhos", "contratos_resumo", "pf_tesouro"]
    built = build_all(raw, str(tmp_path), names)
    assert built["contratos_resumo"].count() == built["contratos"].count()
    assert spark.table("identificadores").count() > 0
    assert checks.failing_types(built.get).isEmpty() and checks.failing_counts(built.get, raw).isEmpty()
    lazy = product("contratos_resumo", raw)
    assert lazy.exceptAll(built["contratos_resumo"]).isEmpty()


def test_treasury_table_is_merged_from_run_to_run(spark, tmp_path, rows):
    def run(*changes):
        frame = text_frame(spark, *[{**TREASURY, **c} for c in changes])
        return build_all(lambda name: frame, str(tmp_path), ["empenhos_tesouro"])["empenhos_tesouro"]

    run({"ptres": "1"}, {"natureza_despesa": "44"})
    assert rows(run({"ptres": "2"}), "natureza_despesa", "ptres") == [("33", "2"), ("44", None)]


def test_derived_tables_turn_numbers_and_dates_into_text_once(spark):
    """Each amount and date once below the projection, whose code stays small enough to be compiled; rows as by the plain text."""
    from tributary.workload.derived import RAW, computed_once, raw_reader

    raw_reader(spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    read = lambda: {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("lineitem", "orders", "customer")}
    for name in ("empenhos_tesouro", "contratos", "dados_curriculo"):
        tables = {t: df for t, df in read().items() if "{" + t + "}" in RAW[name]}
        plain = spark.sql(RAW[name], **tables)
        statement, tables = computed_once(RAW[name], tables)
        once = spark.sql(statement, **tables)
        assert once.schema == plain.schema and once.exceptAll(plain).isEmpty() and plain.exceptAll(once).isEmpty()
        text = once._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("as decimal(15,2)) as string)") <= 2 and text.count("as date) as string)") <= 2


def test_a_derived_table_computes_only_what_is_read(spark, tmp_path):
    """Nothing is landed for a reader, a scan reads the columns in use, and a file large enough to be split is not shuffled."""
    from tributary.workload import derived

    raw = derived.raw_reader(spark, "/root/testdata/sf0.001")
    landed = dict(derived._LANDED)
    invoices = raw("faturas").select("contrato_id")
    assert derived._LANDED == landed and invoices.count() > 0
    plan = invoices._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in plan and "l_extendedprice" not in plan and "l_shipdate" not in plan
    assert "RoundRobinPartitioning" in plan

    before, derived.SMALLEST_SPLIT = derived.SMALLEST_SPLIT, 1
    try:
        split = raw("faturas").select("contrato_id")
        assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
        assert sorted(split.collect()) == sorted(invoices.collect())
    finally:
        derived.SMALLEST_SPLIT = before


def test_links_of_contracts_and_treasury_rows_are_not_shuffled_again(spark):
    """Behind the joins that make links nothing is folded or joined: the result's links are as many as rows times contracts of a reference."""
    from tributary.workload.derived import raw_reader

    shape = product("contratos_empenhos", raw_reader(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    lines = shape.splitlines()
    first = next(i for i, line in enumerate(lines) if "Join" in line or "Aggregate" in line)
    assert "Join Inner" in lines[first] and "_pass" in lines[first] and "_key" in lines[first]
    assert any("Union" in line for line in lines[:first])


def test_months_of_the_spine_are_not_shuffled_behind_their_unfolding(spark, tmp_path, rows):
    """Same rows as two full joins, null contracts and months included, and no exchange or sort above the unfolded spine."""
    values = ", ".join(f"{v} decimal(28,2)" for v in contracts.STAGE_VALUES)
    day = [date(2024, m, 1) for m in range(1, 7)]
    stages = spark.createDataFrame(
        [("a", day[1], *[D(1)] * 5), ("a", day[5], *[D(2)] * 5), ("a", None, *[D(3)] * 5), (None, day[0], *[D(4)] * 5), ("z", day[0], *[D(5)] * 5)],
        f"contrato_id string, mes_lancamento date, {values}")
    money = "valor_cronograma valor_faturas_pagas valor_faturas_pendentes saldo_contratual_disponivel".split()
    monthly = spark.createDataFrame(
        [("a", day[0], *[D(1)] * 4), ("a", day[3], *[D(2)] * 4), ("a", None, *[D(3)] * 4), (None, day[0], *[D(4)] * 4),
         (None, day[1], *[D(4)] * 4), ("b", day[1], *[D(5)] * 4), ("c", None, *[D(6)] * 4)],
        f"contrato_id string, mes_ref date, {', '.join(f'{v} decimal(25,2)' for v in money)}")
    stages.write.parquet(str(tmp_path / "stages"))
    monthly.write.parquet(str(tmp_path / "monthly"))
    stages, monthly = spark.read.parquet(str(tmp_path / "stages")), spark.read.parquet(str(tmp_path / "monthly"))
    spine = contracts.preenchimento_meses(monthly)
    keys = ["contrato_id", "mes_ref"]
    treasury = stages.select("contrato_id", F.col("mes_lancamento").alias("mes_ref"), *contracts.STAGE_VALUES)
    procurement = monthly.select(*keys, "valor_cronograma", (F.col(money[1]) + F.col(money[2])).alias("invoiced"), money[3])
    expected = procurement.join(treasury, keys, "full").join(spine, keys, "full")
    got = contracts.contratos_comparativo_mensal(stages, monthly, spine)
    assert rows(got) == rows(expected) and got.count() == 15
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    above = lines[:next(i for i, line in enumerate(lines) if "Generate" in line)]
    assert not [line for line in above if "Exchange" in line or "Sort" in line]


def test_equal_stage_rows_fold_without_another_shuffle(spark, tmp_path):
    treasury(
        spark, dict(ne_ccor="1" * 11 + "2024NE000001", ne_ccor_favorecido="s", emissao_dia="05/03/2024", emissao_mes="MAR/2024")
    ).write.parquet(str(tmp_path / "treasury"))
    monthly = contracts.estagios_mensal(spark.read.parquet(str(tmp_path / "treasury"))).hint("merge").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = monthly._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = lines[:next(i for i, line in enumerate(lines) if "Join" in line)]
    assert not [line for line in above if "Exchange" in line]


def test_a_kept_table_releases_what_it_shuffled(spark):
    """The shuffle files behind a kept table go once it is written; the setting is as it was, and the frame can be read again."""
    import time

    from tributary.session import RELEASE, kept_table

    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().iterator()
        found = set()
        while blocks.hasNext():
            block = blocks.next()
            found |= {block.name()} if block.isShuffle() else set()
        return found

    before, setting = shuffled(), spark.conf.get(RELEASE)
    grouped = spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))
    table = kept_table(grouped, "released")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(RELEASE) == setting
    assert table.count() == grouped.count() == 700


@pytest.mark.parametrize("name, joins", [("product_contratos_estagios", 1), ("product_ted_resumo_orcamentario", 6), ("history_tracked_tables", 0)])
def test_what_a_long_plan_shuffles_is_released_on_the_way(spark, name, joins):
    """Before its last joins a plan's parts are written, and neither a provided table nor a raw one is read behind them."""
    from tributary.workload.registry import QUERIES

    shape = QUERIES[name].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert shape.count("Join ") == joins and "l_orderkey" not in shape and "o_orderkey" not in shape
