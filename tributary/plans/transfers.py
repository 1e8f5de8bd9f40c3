"""Decentralised transfers: credit notes, financial programmings and commitments per action plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import dates, money, text
from tributary.operators.joins import own_exchange, splittable_full_join
from tributary.plans.shape import accounting, kept, ruled, same, shaped
from tributary.session import kept_table

# Event codes, unit and placeholders of the treasury system.
SIGN_REVERSING_EVENTS = ["300302", "300308", "300311", "300083"]
RETURN_EVENTS = ["300301", "300307"]
NO_TRANSFER = "-8"
NO_PTRES = "-9"
BENEFICIARY_UNIT = "IPEA"
# How a transfer number and a credit note number are written in free text. The
# word "TRANSFERENCIA " stands before "TRANSF.", since alternatives are tried in order.
TRANSFER_NUMBER = (
    r"(?U)(FERENCIA|NUMERO|Nº|TED|CRICAO|TRANSFERENCIA |TRANSF.|CAO)"
    r"(\s|^|-|)([0-9]{6}|1\w{5}|[0-9]{3}\.[0-9]{3})(\s|$|\.|,|-|\/)"
)
CREDIT_NOTE_NUMBER = "([0-9]{4}NC[0-9]+)"

# ---------------------------------------------------------------- bronze


def _day(c):
    return dates.parsed(c, dates.DAY_FIRST)


def nc_tesouro(raw: DataFrame) -> DataFrame:
    """Typed credit notes."""
    return shaped(raw, [
        *ruled(dates.parse_month_label, "emissao_mes"),
        *ruled(_day, "emissao_dia"),
        *kept("nc nc_transferencia nc_fonte_recursos nc_fonte_recursos_descricao ptres nc_evento"),
        *ruled(same, "nc_evento_descr=nc_evento_descricao"),
        *kept("ug_responsavel ug_responsavel_descricao"),
        *ruled(
            same,
            "nc_natureza_despesa=natureza_despesa nc_natureza_despesa_descricao=natureza_despesa_detalhada",
        ),
        *kept(
            "plano_interno plano_detalhado_descricao1 plano_detalhado_descricao2 favorecido_doc"
            " favorecido_doc_descricao"
        ),
        *ruled(money.comma_decimal, "nc_valor_linha"),
        *ruled(accounting, "movimento_liquido"),
    ])


def pf_tesouro(raw: DataFrame) -> DataFrame:
    """Typed financial programmings."""
    return shaped(raw, [
        *ruled(dates.parse_month_label, "emissao_mes"),
        *ruled(_day, "emissao_dia"),
        *kept(
            "ug_emitente ug_emitente_descricao ug_favorecido ug_favorecido_descricao pf_evento"
            " pf_evento_descricao"
        ),
        *ruled(lambda c: F.right(c, F.lit(12)), "pf"),
        *kept(
            "pf_inscricao pf_acao pf_acao_descricao pf_fonte_recursos pf_fonte_recursos_descricao"
            " pf_vinculacao_pagamento pf_vinculacao_pagamento_descricao pf_categoria_gasto pf_recurso"
            " pf_recurso_descricao doc_observacao"
        ),
        *ruled(money.comma_decimal, "pf_valor_linha"),
    ])


def planos_acao(raw: DataFrame) -> DataFrame:
    """Typed action plans, each marked as received or issued."""
    role = lambda c: F.when(c == BENEFICIARY_UNIT, "beneficiario").otherwise("emitente")
    plain_decimal = lambda c: c.try_cast(money.MONEY)
    iso = lambda c: dates.parsed(c, dates.ISO)
    return shaped(raw, [
        *kept("id_plano_acao id_programa sigla_unidade_descentralizada"),
        *ruled(role, "ted_beneficiario_emitente=sigla_unidade_descentralizada"),
        *kept("unidade_descentralizada sigla_unidade_responsavel_execucao unidade_responsavel_execucao"),
        *ruled(plain_decimal, "vl_total_plano_acao"),
        *ruled(iso, "dt_inicio_vigencia dt_fim_vigencia"),
        *kept(
            "tx_objeto_plano_acao tx_justificativa_plano_acao in_forma_execucao_direta"
            " in_forma_execucao_particulares in_forma_execucao_descentralizada tx_situacao_plano_acao"
            " aa_ano_plano_acao"
        ),
        *ruled(plain_decimal, "vl_beneficiario_especifico vl_chamamento_publico"),
        *kept("sq_instrumento aa_instrumento"),
    ])


# ---------------------------------------------------------------- view


def num_transf_n_plano_acao(notas_de_credito: DataFrame, nc_tesouro_raw: DataFrame) -> DataFrame:
    """The plan of each transfer number: one row per transfer, null when no note leads to a plan.

    Of several plans the lowest id is taken. As an aggregate it folds a transfer with very many
    notes before the shuffle.
    """
    plans = notas_de_credito.where("tx_numero_nota is not null").select(
        F.col("cd_ug_emitente_nota").alias("ug"),
        F.col("tx_numero_nota").alias("nc"),
        F.col("id_plano_acao").alias("plano_acao"),
    ).distinct()
    notes = nc_tesouro_raw.where(F.col("nc_transferencia") != NO_TRANSFER).select(
        F.left("nc", F.lit(6)).alias("ug"),
        F.right("nc", F.lit(12)).alias("nc"),
        F.col("nc_transferencia").alias("num_transf"),
    ).distinct()
    return notes.join(plans, ["ug", "nc"], "left").groupBy("num_transf").agg(
        F.min("plano_acao").alias("plano_acao")
    )


# ---------------------------------------------------------------- silver


def _with_plan(facts: DataFrame, transfer: str, num_transf_n_plano_acao: DataFrame) -> DataFrame:
    """Facts with the plan of their transfer, if it has one; a transfer may hold very many facts."""
    plans = num_transf_n_plano_acao.where("plano_acao is not null and num_transf is not null").select(
        F.col("num_transf").alias("_transfer"), "plano_acao"
    )
    return facts.join(plans, own_exchange([transfer], ["_transfer"]), "left").drop("_transfer")


def empenhos_plano_acao(empenhos_tesouro: DataFrame, num_transf_n_plano_acao: DataFrame) -> DataFrame:
    """Commitments whose description names a transfer or a credit note, with the transfer's plan."""
    description = F.col("ne_ccor_descricao")
    named = empenhos_tesouro.select(
        text.drop_chars(text.capture(description, TRANSFER_NUMBER, 3), ".").alias("num_transf"),
        *empenhos_tesouro.columns,
        F.right("ne_ccor", F.lit(12)).alias("ne"),
        text.canonical_document(F.regexp_substr(description, F.lit(CREDIT_NOTE_NUMBER))).alias("nc"),
    ).where((F.col("nc") != "") | F.col("num_transf").isNotNull())
    return _with_plan(named.distinct(), "num_transf", num_transf_n_plano_acao)


def nc_plano_acao(nc_tesouro: DataFrame, num_transf_n_plano_acao: DataFrame) -> DataFrame:
    """Credit notes with their plan and a value signed by event."""
    notes = nc_tesouro.where(F.col("nc_transferencia") != NO_TRANSFER)
    value = F.col("nc_valor_linha")
    return _with_plan(notes, "nc_transferencia", num_transf_n_plano_acao).select(
        "plano_acao",
        "emissao_dia",
        F.col("nc_transferencia").alias("num_transf"),
        F.right("nc", F.lit(12)).alias("nc"),
        "nc_fonte_recursos",
        "ptres",
        F.left("nc", F.lit(6)).alias("ug_emitente"),
        "nc_natureza_despesa",
        "nc_evento",
        "nc_evento_descr",
        F.when(F.col("nc_evento").isin(*SIGN_REVERSING_EVENTS), -value).otherwise(value).alias("nc_valor"),
    )


def pf_plano_acao(
    pf_tesouro: DataFrame, programacao_financeira: DataFrame, num_transf_n_plano_acao: DataFrame
) -> DataFrame:
    """Programmings linked to plans by document and issuer, and by transfer number."""
    programmings = pf_tesouro.select(
        "pf",
        F.col("pf_inscricao").alias("num_transf"),
        "emissao_mes",
        "emissao_dia",
        "ug_emitente",
        "ug_favorecido",
        "pf_evento",
        "pf_evento_descricao",
        text.capture("pf_acao_descricao", r"(?U)(\w+) ").alias("pf_acao"),
        "pf_valor_linha",
    )
    columns = [*programmings.columns, "plano_acao"]
    by_document = programmings.join(
        programacao_financeira.select(
            F.col("tx_numero_programacao").alias("pf"),
            F.col("ug_emitente_programacao").alias("ug_emitente"),
            F.col("id_plano_acao").alias("plano_acao"),
        ).distinct(),
        ["pf", "ug_emitente"],
    ).select(*columns)
    transfers = num_transf_n_plano_acao.where("num_transf is not null").select(
        F.col("num_transf").alias("_transfer"), "plano_acao"
    )
    by_transfer = programmings.join(transfers, own_exchange(["num_transf"], ["_transfer"])).select(*columns)
    return by_document.union(by_transfer).distinct()


# ---------------------------------------------------------------- gold


def ted_resumo_orcamentario(
    planos_acao: DataFrame,
    nc_plano_acao: DataFrame,
    empenhos_plano_acao: DataFrame,
    pf_plano_acao: DataFrame,
) -> DataFrame:
    """Signed, received, returned, committed and paid amounts per plan and transfer."""
    keys = ["plano_acao", "num_transf"]

    def total_if(condition, value):
        return F.sum(F.when(condition, value).otherwise(0))

    note, returned = F.col("nc_valor"), F.col("nc_evento").isin(*RETURN_EVENTS)
    budget = nc_plano_acao.where(F.col("ptres") != NO_PTRES).groupBy(*keys).agg(
        total_if(~returned, note).alias("orcamento_recebido"),
        total_if(returned, note).alias("orcamento_devolvido"),
    )
    committed = F.col("despesas_empenhadas")
    commitments = empenhos_plano_acao.groupBy(*keys).agg(
        total_if(committed > 0, committed).alias("empenhado"),
        total_if(committed < 0, -committed).alias("empenho_anulado"),
        F.sum("despesas_pagas").alias("despesas_pagas_exercicio"),
        F.sum("restos_a_pagar_pagos").alias("despesas_pagas_rap"),
        F.sum("restos_a_pagar_inscritos").alias("restos_a_pagar"),
        F.sum("despesas_liquidadas").alias("despesas_liquidada"),
    )
    action, amount = F.col("pf_acao"), F.col("pf_valor_linha")
    finance = pf_plano_acao.groupBy(*keys).agg(
        total_if(action == "TRANSFERENCIA", amount).alias("financeiro_recebido"),
        total_if(action == "DEVOLUCAO", amount).alias("financeiro_devolvido"),
        total_if(action == "CANCELAMENTO", amount).alias("financeiro_cancelado"),
    )
    # A row per plan and transfer each: written, every list releases what it shuffled before the next is read.
    budget, commitments, finance = (kept_table(df, name) for df, name in ((budget, "budget"), (commitments, "commitments"), (finance, "finance")))
    moved = budget.join(commitments, keys, "full").join(finance, keys, "full")
    signed = planos_acao.select(
        F.col("id_plano_acao").alias("_plan"),
        F.col("vl_total_plano_acao").alias("valor_firmado"),
        "sigla_unidade_descentralizada",
        "ted_beneficiario_emitente",
    )
    amounts = [c for c in moved.columns if c not in keys]
    return (
        splittable_full_join(moved, signed, ["plano_acao"], ["_plan"])
        .select(
            F.coalesce("plano_acao", "_plan").alias("plano_acao"),
            "num_transf",
            "sigla_unidade_descentralizada",
            F.coalesce("ted_beneficiario_emitente", F.lit("nao_indicado")).alias("ted_beneficiario_emitente"),
            "valor_firmado",
            *amounts,
        )
        .where("plano_acao is not null or num_transf is not null")
    )
