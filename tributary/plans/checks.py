"""The checks declared for the products: kept row counts and column types."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.quality import row_count_match, type_check

# Products that keep one row per raw row, and the expected kinds of their columns.
SAME_ROW_COUNT = {"contratos": "contratos", "empenhos": "empenhos"}
EXPECTED_KINDS = {
    "contratos": {
        "int": "num_parcelas",
        "decimal": "valor_inicial valor_global valor_parcela valor_acumulado",
        "date": "data_assinatura data_publicacao data_proposta_comercial vigencia_inicio vigencia_fim",
    },
    "cronogramas": {"int": "id contrato_id mesref anoref", "decimal": "valor", "date": "vencimento"},
    "faturas": {
        "int": "id contrato_id mesref anoref",
        "decimal": "valor juros multa glosa valorliquido",
        "date": "emissao prazo vencimento protocolo ateste",
    },
    "empenhos": {
        "decimal": "empenhado aliquidar liquidado pago rpinscrito rpaliquidar rpliquidado rppago",
        "date": "data_emissao",
    },
    "empenhos_tesouro": {
        "int": "ne_ccor_ano_emissao",
        "decimal": "despesas_empenhadas despesas_liquidadas despesas_pagas restos_a_pagar_inscritos"
        " restos_a_pagar_pagos",
    },
    "pf_tesouro": {"date": "emissao_dia", "decimal": "pf_valor_linha"},
}


def expected_types(table: str) -> dict[str, str]:
    return {c: kind for kind, names in EXPECTED_KINDS[table].items() for c in names.split()}


def failing_types(table: Callable[[str], DataFrame]) -> DataFrame:
    """Every declared column whose type is not the expected kind."""
    checked = [type_check(table(name), name, expected_types(name)) for name in EXPECTED_KINDS]
    return reduce(DataFrame.unionByName, checked)


def failing_counts(table: Callable[[str], DataFrame], raw: Callable[[str], DataFrame]) -> DataFrame:
    """Every declared product whose row count differs from that of its raw table."""
    checked = [
        row_count_match(raw(source), table(target)).select(F.lit(target).alias("table_name"), "*")
        for target, source in SAME_ROW_COUNT.items()
    ]
    return reduce(DataFrame.unionByName, checked)
