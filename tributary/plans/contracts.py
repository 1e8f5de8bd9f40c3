"""Contracts: procurement records reconciled with treasury commitments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import dates, money, text
from tributary.operators.joins import splittable_full_join, unique_groups
from tributary.operators.keyed import merge_rows
from tributary.operators.linkage import Pass, cascade
from tributary.operators.months import month_spine
from tributary.plans.shape import (
    accounting, as_date, as_int, as_text, kept, money_br, ruled, shaped,
)
from tributary.session import kept_table

# ---------------------------------------------------------------- bronze

CONTRACT_RULES = [
    *ruled(as_text, "id"),
    *kept(
        "receita_despesa numero"
        " contratante__orgao_origem__codigo contratante__orgao_origem__nome"
        " contratante__orgao_origem__unidade_gestora_origem__codigo"
        " contratante__orgao_origem__unidade_gestora_origem__nome_resumido"
        " contratante__orgao_origem__unidade_gestora_origem__nome"
        " contratante__orgao_origem__unidade_gestora_origem__sisg"
        " contratante__orgao_origem__unidade_gestora_origem__utiliza_siafi"
        " contratante__orgao_origem__unidade_gestora_origem__utiliza_antecip"
        " contratante__orgao__codigo contratante__orgao__nome"
        " contratante__orgao__unidade_gestora__codigo"
        " contratante__orgao__unidade_gestora__nome_resumido"
        " contratante__orgao__unidade_gestora__nome"
        " contratante__orgao__unidade_gestora__sisg"
        " contratante__orgao__unidade_gestora__utiliza_siafi"
        " contratante__orgao__unidade_gestora__utiliza_antecipagov"
    ),
    *ruled(lambda c: c, "fornecedor_tipo=fornecedor__tipo fornecedor_nome=fornecedor__nome"),
    *kept(
        "codigo_tipo tipo subtipo prorrogavel situacao justificativa_inativo categoria subcategoria"
        " unidades_requisitantes objeto amparo_legal informacao_complementar codigo_modalidade"
        " modalidade unidade_compra licitacao_numero sistema_origem_licitacao"
    ),
    *ruled(as_int, "num_parcelas"),
    *ruled(money_br, "valor_inicial valor_global valor_parcela valor_acumulado"),
    *ruled(
        text.alphanumerics,
        "fornecedor_cnpj_cpf_idgener=fornecedor__cnpj_cpf_idgener processo",
    ),
    *ruled(
        dates.guarded_iso,
        "data_assinatura data_publicacao data_proposta_comercial vigencia_inicio vigencia_fim",
    ),
]


def contratos(raw: DataFrame) -> DataFrame:
    """Typed contracts, one row per contract."""
    return shaped(raw, CONTRACT_RULES)


def cronogramas(raw: DataFrame) -> DataFrame:
    """Typed payment schedule without repeated rows."""
    return shaped(raw, [
        *ruled(as_int, "id contrato_id"),
        *ruled(as_text, "tipo numero receita_despesa"),
        *kept("observacao"),
        *ruled(as_int, "mesref anoref"),
        *ruled(as_text, "retroativo"),
        *ruled(money_br, "valor"),
        *ruled(as_date, "vencimento"),
    ]).distinct()


def empenhos(raw: DataFrame) -> DataFrame:
    """Typed commitments as the procurement system knows them, one row per contract and commitment."""
    return shaped(raw, [
        *ruled(as_text, "id contrato_id"),
        *kept("unidade_gestora gestao"),
        *ruled(lambda c: c, "nota_empenho=numero"),
        *kept(
            "credor fonte_recurso programa_trabalho planointerno naturezadespesa"
            " informacao_complementar sistema_origem"
        ),
        *ruled(
            lambda c: c,
            "links_documento_pagamento=links__documento_pagamento credor_obj_tipo=credor_obj__tipo"
            " credor_obj_cnpj_cpf_idgener=credor_obj__cnpj_cpf_idgener credor_obj_nome=credor_obj__nome",
        ),
        *ruled(
            money_br,
            "empenhado aliquidar liquidado pago rpinscrito rpaliquidar rpliquidado rppago",
        ),
        *ruled(dates.guarded_iso, "data_emissao"),
    ])


INVOICE_COMMITMENT = "id_empenho: string, numero_empenho: string, valor_empenho: string, subelemento: string"


def _invoices(raw: DataFrame) -> DataFrame:
    """Typed invoices before their commitments are unfolded."""
    return shaped(raw, [
        *ruled(as_int, "id contrato_id"),
        *ruled(as_text, "tipolistafatura_id justificativafatura_id sfadrao_id numero"),
        *ruled(as_date, "emissao prazo vencimento"),
        *ruled(money_br, "valor juros multa glosa valorliquido"),
        *ruled(as_text, "processo"),
        *ruled(as_date, "protocolo ateste"),
        *ruled(as_text, "repactuacao infcomplementar"),
        *ruled(as_int, "mesref anoref"),
        *ruled(as_text, "situacao chave_nfe dados_referencia dados_item_faturado"),
        *kept("dados_empenho"),
    ])


def faturas(raw: DataFrame) -> DataFrame:
    """One row per invoice and commitment; invoices without a commitment are left out.

    ``dados_empenho`` may be a native array or the list's text form.
    """
    typed = _invoices(raw)
    listed = F.col("dados_empenho")
    if dict(typed.dtypes)["dados_empenho"] == "string":
        listed = text.python_list(listed, INVOICE_COMMITMENT)
    unfolded = typed.withColumn("dados_empenho", F.explode(listed))
    item = F.col("dados_empenho")
    return unfolded.withColumns({
        "id_empenho": item["id_empenho"],
        "numero_empenho": F.upper(item["numero_empenho"]),
        "valor_empenho": item["valor_empenho"],
        "subelemento": item["subelemento"],
    })


# What identifies a treasury row from one load to the next.
TREASURY_KEY = [
    "ne_ccor", "natureza_despesa", "doc_observacao", "ne_ccor_ano_emissao", "emissao_dia",
    "emissao_mes", "despesas_empenhadas", "despesas_liquidadas", "despesas_pagas",
]


def empenhos_tesouro(
    raw: DataFrame, current: DataFrame | None = None, first_separator_only: bool = True
) -> DataFrame:
    """Typed treasury commitments of the years 20xx, merged into ``current`` when it is given.

    The source system's rule removes only the first separator of the process number, although
    contracts have all of them removed; ``first_separator_only=False`` removes all, so that the
    process pass of the linkage can match.
    """
    process = (
        (lambda c: text.strip_first(c, "./-")) if first_separator_only
        else (lambda c: text.drop_chars(c, "./-"))
    )
    typed = shaped(raw.where(F.col("ne_ccor_ano_emissao").startswith("20")), [
        *kept("emissao_mes emissao_dia ne_ccor"),
        *ruled(process, "ne_num_processo"),
        *kept(
            "ne_info_complementar ne_ccor_descricao doc_observacao natureza_despesa"
            " natureza_despesa_descricao"
        ),
        *ruled(F.upper, "ne_ccor_favorecido"),
        *kept("ne_ccor_favorecido_descricao"),
        *ruled(as_int, "ne_ccor_ano_emissao"),
        *kept("ptres fonte_recursos_detalhada fonte_recursos_detalhada_descricao"),
        *ruled(
            accounting,
            "despesas_empenhadas despesas_liquidadas despesas_pagas restos_a_pagar_inscritos"
            " restos_a_pagar_pagos",
        ),
    ])
    return typed if current is None else merge_rows(current, typed, TREASURY_KEY)


# ---------------------------------------------------------------- views


def identificadores(contratos: DataFrame, empenhos: DataFrame, faturas: DataFrame) -> DataFrame:
    """All keys by which a contract can be recognised.

    The commitment numbers of a contract are those of its commitments and of its invoices. A full
    join of the two distinct lists is their distinct union, except that rows with a null part stay
    apart by source; a tag on those rows does the same in one pass over each list.
    """
    def numbers(df: DataFrame, number: str, source: int) -> DataFrame:
        contract, ne = F.col("contrato_id").cast("string"), F.upper(number)
        apart = F.when(contract.isNull() | ne.isNull(), F.lit(source)).otherwise(F.lit(0))
        return df.select(contract.alias("_contract"), ne.alias("_ne"), apart.alias("_apart"))

    numbered = numbers(empenhos, "nota_empenho", 1).union(numbers(faturas, "numero_empenho", 2)).distinct()

    unit = F.col("contratante__orgao__unidade_gestora__codigo")
    mode = F.col("codigo_modalidade")

    def reference(number: str) -> Column:
        return text.join_text(unit, mode, text.drop_chars(number, "/"))

    known = contratos.select(
        F.col("id").cast("string").alias("contrato_id"),
        "categoria",
        text.digits("processo").alias("processo"),
        text.drop_chars("fornecedor_cnpj_cpf_idgener", "/.-").alias("cnpj_cpf"),
        F.when(mode.isin("05", "06"), reference("numero"))
        .when(mode == "07", reference("licitacao_numero"))
        .alias("info_complementar"),
        F.when(F.length("numero") == 12, F.col("numero")).alias("_own_ne"),
    )
    joined = splittable_full_join(numbered, known, ["_contract"], ["contrato_id"])
    return joined.select(
        "contrato_id", "categoria", "processo", "cnpj_cpf", "info_complementar",
        F.coalesce("_ne", "_own_ne").alias("ne"),
    )


def preenchimento_meses(cronogramas_faturas_mensal: DataFrame) -> DataFrame:
    """Month spine: for each contract every known month between its first and last."""
    return month_spine(cronogramas_faturas_mensal, "contrato_id", "mes_ref")


# ---------------------------------------------------------------- silver

LINK_COLUMNS = [
    "ne_transformed", "ne_ccor", "ne_info_complementar", "ne_num_processo", "ne_ccor_descricao",
    "doc_observacao", "natureza_despesa", "natureza_despesa_descricao", "ne_ccor_favorecido",
    "ne_ccor_ano_emissao", "despesas_empenhadas", "despesas_liquidadas", "despesas_pagas",
]


def contratos_empenhos(identificadores: DataFrame, empenhos_tesouro: DataFrame) -> DataFrame:
    """Treasury commitments linked to contracts.

    First by commitment number and supplier; contracts with a number the treasury does not know
    stay as rows without amounts. Then, for commitments that have some unmatched row, by a process
    with one contract, a supplier with one contract, and the composed reference in the free text.
    """
    # Equal treasury rows count once per contract, so they are folded first. A reference that many rows and contracts share
    # makes as many links as their product: links come out of the joins once and whole, and are not shuffled again.
    treasury = kept_table(
        empenhos_tesouro.select(
            F.upper(F.right("ne_ccor", F.lit(12))).alias("ne_transformed"), *[c for c in LINK_COLUMNS if c != "ne_transformed"],
        ).distinct(),
        "treasury",
    ).withColumn("_reference", text.capture("ne_info_complementar", "^([0-9]+) -"))
    by_number = (
        identificadores.where("ne is not null and cnpj_cpf is not null")
        .select(F.col("contrato_id"), F.col("ne").alias("_ne"), F.col("cnpj_cpf").alias("_cnpj"))
        .distinct()
    )
    number_keys = by_number.select("_ne", "_cnpj", F.lit(True).alias("_known")).distinct()

    fact_on = (F.col("ne_transformed") == F.col("_ne")) & (F.col("ne_ccor_favorecido") == F.col("_cnpj"))
    matched = treasury.join(by_number, fact_on).select("contrato_id", *treasury.columns)
    fact_keys = treasury.select(
        F.col("ne_transformed").alias("_ne"), F.col("ne_ccor_favorecido").alias("_cnpj")
    ).distinct()
    types = dict(treasury.dtypes)
    contract_only = by_number.join(fact_keys, ["_ne", "_cnpj"], "left_anti").select(
        "contrato_id",
        F.col("_ne").alias("ne_transformed"),
        *[F.lit(None).cast(types[c]).alias(c) for c in LINK_COLUMNS if c != "ne_transformed"],
    ).distinct()

    unmatched = (
        treasury.select("ne_ccor", "ne_ccor_favorecido", "ne_transformed")
        .where("ne_ccor_favorecido is not null and ne_ccor is not null")
        .distinct()
        .join(number_keys, fact_on, "left_anti")
        .select("ne_ccor")
        .distinct()
    )
    # One row per contract and key set, read by every pass: the size of the contract table.
    known = kept_table(
        identificadores.select("contrato_id", "processo", "cnpj_cpf", "info_complementar").distinct(),
        "contract-keys",
    )
    linked = cascade(
        treasury,
        [
            Pass(unique_groups(known, "processo"), "processo", "ne_num_processo"),
            Pass(unique_groups(known, "cnpj_cpf"), "cnpj_cpf", "ne_ccor_favorecido"),
            Pass(known, "info_complementar", "_reference"),
        ],
        entity="contrato_id",
        residue_key="ne_ccor",
        residue=unmatched,
        found=matched,
    )
    return linked.select("contrato_id", *LINK_COLUMNS).union(contract_only)


STAGE_VALUES = ["valor_empenhado", "valor_liquidado", "valor_pago", "restos_a_pagar", "restos_a_pagar_pago"]


def estagios_mensal(empenhos_tesouro: DataFrame) -> DataFrame:
    """Monthly commitment stages per commitment and supplier.

    Carry-over rows (day ``000``) appear twice: in January of their year, and in December of the
    year before with the balance negated and the other amounts repeated.
    """
    rows = empenhos_tesouro.where(F.col("ne_ccor") != "Total")
    carried = F.coalesce(F.col("emissao_dia").startswith("000/"), F.lit(False))
    grouped = (
        rows.groupBy(
            F.right("ne_ccor", F.lit(12)).alias("ne"),
            carried.alias("_carried"),
            F.right("emissao_mes", F.lit(4)).try_cast("int").alias("_year"),
            F.when(carried, F.lit("01"))
            .otherwise(text.capture("emissao_dia", r"/(\d{2})/"))
            .alias("_month"),
            F.col("ne_ccor_favorecido").alias("cnpj_cpf"),
        )
        .agg(
            F.max(text.capture("ne_info_complementar", "^([0-9]+)")).alias("info_complementar"),
            F.max("ne_num_processo").alias("_process"),
            F.sum("despesas_empenhadas").alias("valor_empenhado"),
            F.sum("despesas_liquidadas").alias("valor_liquidado"),
            F.sum("despesas_pagas").alias("valor_pago"),
            F.sum("restos_a_pagar_inscritos").alias("restos_a_pagar"),
            F.sum("restos_a_pagar_pagos").alias("restos_a_pagar_pago"),
        )
    )
    grouped = kept_table(grouped, "stage-groups")  # read twice, as rows and as the lookup of their numbers
    # Joined by the number itself, which is never null here: rows that lie by their number are folded further on without another
    # shuffle. The lookup is grouped by the number in a tuple, so both sides of the join are shuffled afresh and a hot number is split.
    lookup = grouped.groupBy(F.struct("ne").alias("_g")).agg(F.min("_process").alias("num_processo"))
    named = grouped.join(lookup, F.col("ne") == F.col("_g.ne"), "left")
    in_place = F.struct(F.col("_year").alias("y"), F.col("_month").alias("m"), F.lit(1).alias("sign"))
    before = F.struct((F.col("_year") - 1).alias("y"), F.lit("12").alias("m"), F.lit(-1).alias("sign"))
    placed = named.withColumn(
        "_at", F.explode(F.when(F.col("_carried"), F.array(before, in_place)).otherwise(F.array(in_place)))
    )
    return placed.select(
        "ne",
        "cnpj_cpf",
        "info_complementar",
        "num_processo",
        dates.parsed(
            F.concat(F.col("_at.y").cast("string"), F.lit("-"), F.col("_at.m"), F.lit("-01")), "y-MM-dd"
        ).alias("mes_lancamento"),
        "valor_empenhado",
        "valor_liquidado",
        "valor_pago",
        F.when(F.col("_at.sign") < 0, -F.col("restos_a_pagar"))
        .otherwise(F.col("restos_a_pagar"))
        .alias("restos_a_pagar"),
        "restos_a_pagar_pago",
    )


def contratos_estagios(
    identificadores: DataFrame, estagios_mensal: DataFrame, unlinked_only: bool = False
) -> DataFrame:
    """Monthly stages summed per contract, linked by number, else process, else reference.

    The second key offers only contracts the first one did not link. The third offers contracts
    missing from either earlier candidate list, which in practice are mostly linked ones;
    ``unlinked_only=True`` offers only those that neither earlier key linked. Assignments
    ("Cessão") and contracts without a category take no part.

    Each stage row tries the keys in turn inside one chain of left joins, which carries numbers and keys; the
    amounts join the links at the end.
    """
    # Equal stage rows count once per contract, so they are folded first; only their numbers and keys go through the joins.
    stages = kept_table(estagios_mensal.distinct().withColumn("_row", F.monotonically_increasing_id()), "stages")
    keys = stages.select("_row", "ne", "cnpj_cpf", "num_processo", "info_complementar")
    ids = identificadores.where(F.col("categoria") != "Cessão")
    first = ids.select(F.col("contrato_id").alias("_c1"), F.col("ne").alias("_n1"), F.col("cnpj_cpf").alias("_s1")).distinct()
    stage_keys = keys.select(F.col("ne").alias("_n1"), F.col("cnpj_cpf").alias("_s1")).distinct()
    linked_first = kept_table(first.join(stage_keys, ["_n1", "_s1"], "left_semi").select("_c1").distinct(), "linked-by-number")
    second = (
        ids.join(linked_first, F.col("contrato_id") == F.col("_c1"), "left_anti")
        .select(F.col("contrato_id").alias("_c2"), F.col("cnpj_cpf").alias("_s2"), F.col("processo").alias("_p2"))
        .distinct()
    )
    after_first = keys.join(
        first, (F.col("ne") == F.col("_n1")) & (F.col("cnpj_cpf") == F.col("_s1")), "left"
    )
    after_second = after_first.join(
        second,
        F.col("_c1").isNull() & (F.col("cnpj_cpf") == F.col("_s2")) & (F.col("num_processo") == F.col("_p2")),
        "left",
    )
    # The first list names all contracts that take part, so those missing from a list are those that the number linked.
    third_ids = ids.join(linked_first, F.col("contrato_id") == F.col("_c1"), "left_semi")
    if unlinked_only:
        linked = after_second.select(F.coalesce("_c1", "_c2").alias("_linked")).where("_linked is not null").distinct()
        third_ids = ids.join(linked, F.col("contrato_id") == F.col("_linked"), "left_anti")
    third = third_ids.select(
        F.col("contrato_id").alias("_c3"), F.col("cnpj_cpf").alias("_s3"), F.col("info_complementar").alias("_r3")
    ).distinct()
    after_third = after_second.join(
        third,
        F.col("_c1").isNull() & F.col("_c2").isNull()
        & (F.col("cnpj_cpf") == F.col("_s3")) & (F.col("info_complementar") == F.col("_r3")),
        "left",
    )
    links = after_third.select(F.coalesce("_c1", "_c2", "_c3").alias("contrato_id"), "_row").where("contrato_id is not null").distinct()
    amounts = stages.select(F.col("_row").alias("_of"), "mes_lancamento", *STAGE_VALUES)
    # Links are two columns: written, they release what the joins shuffled before the amounts are.
    linked = kept_table(links, "stage-links").join(amounts, F.col("_row") == F.col("_of"))
    return linked.groupBy("contrato_id", "mes_lancamento").agg(*[F.sum(v).alias(v) for v in STAGE_VALUES])


INVOICE_CONTRACT_COLUMNS = (
    "id contrato_id numero_contrato contrato_processo fornecedor_cnpj_cpf_idgener objeto_contrato"
    " tipolistafatura_id justificativafatura_id sfadrao_id numero emissao prazo vencimento valor juros"
    " multa glosa valorliquido processo protocolo ateste repactuacao infcomplementar mesref anoref"
    " situacao chave_nfe dados_referencia dados_item_faturado dados_empenho id_empenho numero_empenho"
    " valor_empenho subelemento"
).split()


def contratos_faturas(contratos: DataFrame, faturas: DataFrame) -> DataFrame:
    """Invoices with number, process, supplier and object of their contract."""
    contract = contratos.select(
        F.col("id").try_cast("int").alias("_contract"),
        "fornecedor_cnpj_cpf_idgener",
        F.col("processo").alias("contrato_processo"),
        F.col("numero").alias("numero_contrato"),
        F.col("objeto").alias("objeto_contrato"),
    )
    joined = faturas.join(contract, F.col("contrato_id") == F.col("_contract"), "left")
    return joined.select(*INVOICE_CONTRACT_COLUMNS)


def cronogramas_faturas_mensal(
    cronogramas: DataFrame, faturas_raw: DataFrame, truncate_month: bool = False
) -> DataFrame:
    """Scheduled, paid and pending amounts per contract and due date, and what is left to invoice.

    Invoices count once, from the raw table. They are dated to the first of their month while the
    schedule keeps its due date, so they meet only where that is the first, unless
    ``truncate_month`` moves the schedule to the first as well.
    """
    due = F.col("vencimento")
    scheduled = cronogramas.groupBy(
        "contrato_id", (F.trunc(due, "month") if truncate_month else due).alias("mes_ref")
    ).agg(F.sum("valor").alias("valor_cronograma"))

    total = F.col("juros") + F.col("multa") + F.col("glosa") + F.col("valorliquido")
    status = F.col("situacao")
    invoiced = (
        _invoices(faturas_raw)
        .where(status.isin("Pago", "Pendente"))
        .groupBy("contrato_id", F.trunc("emissao", "month").alias("mes_ref"))
        .agg(
            F.sum(F.when(status == "Pago", total)).alias("_paid"),
            F.sum(F.when(status == "Pendente", total)).alias("_pending"),
        )
    )
    zero = F.lit(0).cast("decimal(15,2)")
    joined = scheduled.join(invoiced, ["contrato_id", "mes_ref"], "left").select(
        F.col("contrato_id").cast("string").alias("contrato_id"),
        "mes_ref",
        F.coalesce("valor_cronograma", zero).alias("valor_cronograma"),
        F.coalesce("_paid", zero).alias("valor_faturas_pagas"),
        F.coalesce("_pending", zero).alias("valor_faturas_pendentes"),
    )
    return joined.withColumn(
        "saldo_contratual_disponivel",
        F.col("valor_cronograma") - F.col("valor_faturas_pagas") - F.col("valor_faturas_pendentes"),
    )


# ---------------------------------------------------------------- gold


def contratos_comparativo_mensal(
    contratos_estagios: DataFrame, cronogramas_faturas_mensal: DataFrame, preenchimento_meses: DataFrame
) -> DataFrame:
    """Procurement against treasury per contract and month, with the gaps filled.

    All three sides have one row per key, so the full join cannot be skewed. The spine is many times the other two, so its
    rows are neither shuffled nor sorted again: where they were unfolded, those of months that the contract has go,
    by one list of months per contract.
    """
    treasury = contratos_estagios.select(
        "contrato_id",
        F.col("mes_lancamento").alias("mes_ref"),
        *[F.col(v).alias(f"siafi_{v}") for v in STAGE_VALUES],
    )
    procurement = cronogramas_faturas_mensal.select(
        "contrato_id",
        "mes_ref",
        F.col("valor_cronograma").alias("comprasgov_valor_cronograma"),
        (F.col("valor_faturas_pagas") + F.col("valor_faturas_pendentes")).alias("comprasgov_valor_faturas"),
        F.col("saldo_contratual_disponivel").alias("comprasgov_saldo_contratual_disponivel"),
    )
    keys = ["contrato_id", "mes_ref"]
    both = kept_table(procurement.join(treasury, keys, "full"), "procurement-treasury")
    known = (
        both.where("contrato_id is not null").groupBy(F.col("contrato_id").alias("_contract"))
        .agg(F.collect_set("mes_ref").alias("_months"))
    )
    spine = preenchimento_meses.select(*keys).join(known.hint("shuffle_hash"), F.col("contrato_id") == F.col("_contract"), "left")
    gaps = spine.where(~F.coalesce(F.array_contains("_months", F.col("mes_ref")), F.lit(False))).select(*keys)
    return both.unionByName(gaps, allowMissingColumns=True)


def contratos_resumo(contratos: DataFrame, contratos_empenhos: DataFrame) -> DataFrame:
    """Contract card with what was paid and two flags: write-off pending, continued service."""
    paid = (
        contratos_empenhos.where("contrato_id is not null")
        .groupBy(F.col("contrato_id").alias("id"))
        .agg(F.sum("despesas_pagas").alias("despesas_pagas"))
    )
    supplier = F.col("fornecedor_tipo")
    long_running = F.date_diff("vigencia_fim", "vigencia_inicio") >= 730
    unit = "contratante__orgao_origem__unidade_gestora_origem__"
    return contratos.join(paid, "id", "left").select(
        F.col("id").alias("contrato_id"),
        F.col("fornecedor_cnpj_cpf_idgener").alias("fornecedor_cnpj_cpf"),
        "numero", "categoria", "modalidade", "tipo", "situacao",
        F.when(F.col("despesas_pagas") == F.col("valor_global"), "Sim").otherwise("Não").alias("pendente_baixa"),
        "fornecedor_nome", "objeto", "valor_global", "despesas_pagas", "vigencia_inicio", "vigencia_fim",
        "num_parcelas",
        F.when(supplier == "IDGENERICO", "Empresa do Exterior").otherwise(supplier).alias("fornecedor_tipo"),
        text.join_text(F.col(f"{unit}codigo"), F.lit(" - "), F.col(f"{unit}nome_resumido")).alias("Unidade"),
        F.when(long_running & (F.col("num_parcelas") > 1), "Sim").otherwise("Não").alias("continuado"),
    )


def contratos_somatorio(contratos_comparativo_mensal: DataFrame) -> DataFrame:
    """Totals per contract, and the scheduled amount of months without invoices."""
    scheduled, invoiced = F.col("comprasgov_valor_cronograma"), F.col("comprasgov_valor_faturas")
    return contratos_comparativo_mensal.groupBy("contrato_id").agg(
        F.sum(scheduled).alias("total_cronograma"),
        F.sum(invoiced).alias("total_faturas"),
        F.sum("comprasgov_saldo_contratual_disponivel").alias("total_saldo_disponivel"),
        F.sum(F.when(invoiced == 0, scheduled).otherwise(0)).alias("orcamento_a_executar"),
        F.sum("siafi_valor_empenhado").alias("total_empenhado"),
        F.sum("siafi_valor_liquidado").alias("total_liquidado"),
        F.sum("siafi_valor_pago").alias("total_pago"),
    )
