"""Personnel: staff records, organisation units and posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import dates, money, text
from tributary.operators.joins import origin_flag, splittable_full_join
from tributary.operators.keyed import keep_one
from tributary.operators.ordinals import match_nth
from tributary.operators.tree import tree_paths
from tributary.plans.shape import (
    after_blank, as_int, clean, clean_date, clean_date8, clean_digits, clean_int, clean_lower,
    clean_month, clean_upper, clean_year_first8, kept, money_br, ruled, same, shaped,
)
from tributary.session import kept_table

# The root of the unit tree, a unit sigla that the two systems write differently, and
# status values.
ROOT_UNIT = "7"
OFFICE_SIGLA = ("GABIN-IPEA", "GABIN")
FREE_APPOINTMENT = "04"
ACTIVE_ELSEWHERE = "ATIVO EM OUTRO ORGAO"

# ---------------------------------------------------------------- bronze: staff

LEAVE_TEXT = (
    "adiantamento_salario_ferias=adiantamentosalarioferias ano_exercicio=anoexercicio"
    " gratificacao_natalina=gratificacaonatalina"
    " parcela_continuacao_interrupcao=parcelacontinuacaointerrupcao"
    " parcela_interrompida=parcelainterrompida cod_diploma_afastamento=coddiplomaafastamento"
    " cod_ocorrencia=codocorrencia desc_diploma_afastamento=descdiplomaafastamento"
    " desc_ocorrencia=descocorrencia"
)
LEAVE_DATES = (
    "dt_fim=datafim dt_fim_aquisicao=datafimaquisicao dt_ini=dataini"
    " dt_inicio_aquisicao=datainicioaquisicao"
    " dt_inicio_ferias_interrompidas=datainicioferiasinterrompidas"
)
LEAVE_NUMBERS = (
    "dias_restantes=diasrestantes numero_parcela=numerodaparcela qtde_dias=qtdedias"
    " numero_diploma_afastamento=numerodiplomaafastamento"
)


def dados_afastamento(raw: DataFrame) -> DataFrame:
    """Current leave."""
    return shaped(raw, [
        *ruled(clean, LEAVE_TEXT + " gr_matricula=grmatricula"),
        *ruled(clean_date8, LEAVE_DATES),
        *ruled(clean_year_first8, "dt_publicacao_afastamento=datapublicacaoafastamento"),
        *ruled(clean_int, LEAVE_NUMBERS),
        *ruled(clean_digits, "cpf"),
    ])


def afastamento_historico(raw: DataFrame) -> DataFrame:
    """Leave history: as the current leave, with two more words for null and no registration."""
    marked = lambda c: text.sentinel_to_null(c, "NaN", "[null]")
    return shaped(raw, [
        ("gr_matricula", "", same),
        *ruled(marked, LEAVE_TEXT),
        *ruled(lambda c: dates.guarded_compact(marked(c)), LEAVE_DATES),
        *ruled(
            lambda c: dates.guarded_compact(marked(c), dates.YEAR_FIRST_COMPACT),
            "dt_publicacao_afastamento=datapublicacaoafastamento",
        ),
        *ruled(lambda c: as_int(marked(c)), LEAVE_NUMBERS),
        *ruled(lambda c: text.digits(marked(c)), "cpf"),
    ])


def dados_curriculo(raw: DataFrame) -> DataFrame:
    """Courses and experience; months become their first day."""
    return shaped(raw, [
        *ruled(clean_digits, "cpf"),
        *ruled(
            clean,
            "ident_unica=identificunica codigo_experiencia=codigo cod_curso=codcurso nome_curso=nomecurso",
        ),
        *ruled(clean_month, "dt_mes_conclusao=dataconclusao"),
        *ruled(
            clean,
            "nome_instituicao=instituicao nome_area_experiencia=nome carga_horaria=cargahoraria"
            " nome_cargo=cargo",
        ),
        *ruled(clean_month, "dt_mes_inicio=datainicio"),
        *ruled(clean, "nome_orgao_empresa=nomeorgaoempresa"),
        *ruled(clean_month, "dt_mes_fim=datafim"),
        *ruled(
            clean, "descricao_projeto=projeto informacoes_adicionais=infoadicionais tipo_descricao=tipodesc"
        ),
    ])


def dados_dependentes(raw: DataFrame) -> DataFrame:
    """Dependants and their benefits."""
    marked = lambda c: text.sentinel_to_null(c, "NaN")
    day = lambda c: dates.parsed(text.sentinel_to_null(c, "NaN", "00000000"), dates.DAY_FIRST_COMPACT)
    return shaped(raw, [
        *ruled(
            marked,
            "cod_condicao=codcondicao cod_grau_parentesco=codgrauparentesco cod_orgao=codorgao",
        ),
        *ruled(lambda c: text.digits(marked(c)), "cpf"),
        *ruled(
            marked,
            "matricula nome_dependente=nome nome_condicao=nomecondicao"
            " nome_grau_parentesco=nomegrauparentesco cod_beneficio=codbeneficio",
        ),
        *ruled(day, "dt_fim=datafim dt_inicio=datainicio"),
        *ruled(marked, "nome_beneficio=nomebeneficio"),
    ])


def dados_escolares(raw: DataFrame) -> DataFrame:
    """Education."""
    return shaped(raw, [
        *ruled(
            clean,
            "cod_curso=codcurso nome_curso=nomecurso cod_matricula=codmatricula cod_orgao=codorgao"
            " cod_titulacao=codtitulacao nome_titulacao=nometitulacao cod_escolaridade=codescolaridade"
            " nome_escolaridade=nomeescolaridade",
        ),
        *ruled(clean_digits, "cpf"),
    ])


def dados_financeiros(raw: DataFrame) -> DataFrame:
    """Payroll items."""
    amount = after_blank(lambda c: F.translate(c, ",.", ".").try_cast("decimal(18,2)"))
    month = after_blank(dates.parse_compact_month_label)
    return shaped(raw, [
        *ruled(
            clean,
            "cod_rubrica=codrubrica indicador_rd=indicadorrd nome_rubrica=nomerubrica"
            " numero_sequencia=numeroseq",
        ),
        *ruled(amount, "valor_rubrica=valorrubrica"),
        *ruled(month, "data_anomes_rubrica=dataanomesrubrica"),
        *ruled(clean, "prazo_rubrica=pzrubrica"),
        *ruled(month, "mes_ano_pagamento=mesanopagamento"),
        *ruled(clean_digits, "cpf"),
        *ruled(clean, "indicador_mov_supl=indicadormovsupl periodo_rubrica=perubrica"),
    ])


# output=raw column names of the employment record.
EMPLOYMENT_TEXT = (
    "cod_atividade_funcao=codativfun cod_funcao=codfuncao cod_jornada=codjornada"
    " cod_ocorr_ingresso_orgao=codocorringressoorgao"
    " cod_ocorr_ingresso_serv_publico=codocorringressoservpublico cod_orgao=codorgao"
    " cod_padrao=codpadrao cod_situacao_funcional=codsitfuncional cod_uorg_exercicio=coduorgexercicio"
    " cod_upag=codupag cod_orgao_origem=codigoorgaoorigem ident_unica=identunica"
    " matricula_siape=matriculasiape modalidade_pgd=modalidadepgd nome_atividade_funcao=nomeativfun"
    " nome_chefe_uorg=nomechefeuorg nome_funcao=nomefuncao nome_jornada=nomejornada"
    " nome_ocorr_ingresso_orgao=nomeocorringressoorgao"
    " nome_ocorr_ingresso_serv_publico=nomeocorringressoservpublico nome_orgao=nomeorgao"
    " nome_regime_juridico=nomeregimejuridico nome_situacao_funcional=nomesitfuncional"
    " nome_uorg_exercicio=nomeuorgexercicio nome_upag=nomeupag participa_pgd=participapgd"
    " sigla_orgao=siglaorgao sigla_orgao_origem=siglaorgaoorigem"
    " sigla_regime_juridico=siglaregimejuridico sigla_uorg_exercicio=siglauorgexercicio"
    " sigla_upag=siglaupag cod_cargo=codcargo cod_classe=codclasse"
    " cod_ocorr_aposentadoria=codocorraposentadoria nome_cargo=nomecargo nome_classe=nomeclasse"
    " nome_ocorr_aposentadoria=nomeocorraposentadoria sigla_nivel_cargo=siglanivelcargo"
    " tipo_vale_ar=tipovalear cod_ocorr_isencao_ir=codocorrisencaoir"
    " nome_ocorr_isencao_ir=nomeocorrisencaoir cod_uorg_lotacao=coduorglotacao"
    " nome_uorg_lotacao=nomeuorglotacao sigla_uorg_lotacao=siglauorglotacao"
    " cod_ocorr_exclusao=codocorrexclusao nome_ocorr_exclusao=nomeocorrexclusao"
    " cod_vale_transporte=codvaletransporte pontuacao_desempenho=pontuacaodesempenho"
)
EMPLOYMENT_DATES = (
    "dt_exercicio_no_orgao=dataexercicionoorgao dt_fim_vale_ar=datafimvalear"
    " dt_ingresso_funcao=dataingressofuncao dt_ocorr_ingresso_orgao=dataocorringressoorgao"
    " dt_ocorr_ingresso_serv_publico=dataocorringressoservpublico dt_ini_vale_ar=datainivalear"
    " dt_ocorr_aposentadoria=dataocorraposentadoria dt_ini_ocorr_isencao_ir=datainiocorrisencaoir"
    " dt_fim_ocorr_isencao_ir=datafimocorrisencaoir dt_ocorr_exclusao=dataocorrexclusao"
    " dt_uorg_lotacao=datauorglotacao dt_uorg_exercicio=datauorgexercicio"
)


def dados_funcionais(raw: DataFrame) -> DataFrame:
    """Employment record. Unbounded numerics get a fixed scale: two digits for money, six for shares."""
    percent = after_blank(
        lambda c: (money.comma_decimal(c, "decimal(18,6)") / F.lit(100)).cast("decimal(18,6)")
    )
    amount = after_blank(lambda c: money.comma_decimal(c, "decimal(18,2)"))
    return shaped(raw, [
        *ruled(clean, EMPLOYMENT_TEXT),
        *ruled(clean_date, EMPLOYMENT_DATES),
        *ruled(clean_digits, "cpf_chefia_imediata=cpfchefiaimediata cpf"),
        *ruled(
            clean_lower,
            "email_chefia_imediata=emailchefiaimediata email_institucional=emailinstitucional"
            " email_servidor=emailservidor",
        ),
        *ruled(percent, "percentual_ts=percentualts"),
        *ruled(amount, "valor_vale_transporte=valorvaletransporte"),
    ])


def dados_pa(raw: DataFrame) -> DataFrame:
    """Alimony beneficiaries."""
    return shaped(raw, [
        *ruled(clean_digits, "agencia_beneficiario=agenciabeneficiario"),
        *ruled(clean, "banco_beneficiario=bancobeneficiario cod_orgao=codorgao"),
        *ruled(
            after_blank(lambda c: F.upper(text.alphanumerics(c))), "conta_beneficiario=contabeneficiario"
        ),
        *ruled(clean_digits, "cpf_beneficiario=cpfbeneficiario"),
        *ruled(
            clean,
            "matricula_servidor=matricula nome_beneficiario=nomebeneficiario"
            " valor_ultima_pensao=valorultimapensao",
        ),
        *ruled(clean_digits, "cpf_servidor"),
        *ruled(
            clean,
            "cod_vinculo_servidor=codvinculoservidor nome_alimentado=nomealimentado"
            " nome_vinculo_servidor=nomevinculoservidor",
        ),
    ])


def dados_pessoais(raw: DataFrame) -> DataFrame:
    """Personal data, one row per person."""
    return shaped(raw, [
        *ruled(
            clean,
            "cod_cor=codcor cod_estado_civil=codestadocivil cod_nacionalidade=codnacionalidade"
            " cod_sexo=codsexo",
        ),
        *ruled(clean_date, "dt_nascimento=datanascimento"),
        *ruled(
            clean,
            "grupo_sanguineo=gruposanguineo nome_pessoa=nome nome_cor=nomecor"
            " nome_estado_civil=nomeestadocivil nome_mae=nomemae"
            " nome_municipio_nascimento=nomemunicipnasc nome_nacionalidade=nomenacionalidade",
        ),
        *ruled(lambda c: text.sentinel_to_null(c, "NAO DECLARADO"), "nome_pai=nomepai"),
        *ruled(clean, "nome_sexo=nomesexo"),
        *ruled(clean_digits, "num_pispasep=numpispasep"),
        *ruled(clean_upper, "uf_nascimento=ufnascimento"),
        *ruled(clean_digits, "cpf"),
        *ruled(clean, "cod_deficiencia_fisica=coddeffisica nome_deficiencia_fisica=nomedeffisica"),
        *ruled(clean_date, "dt_chegada_brasil=datachegbrasil"),
        *ruled(clean, "nome_pais_origem=nomepais"),
    ])


def dados_uorg(raw: DataFrame) -> DataFrame:
    """Unit address per person."""
    return shaped(raw, [
        *ruled(clean, "bairro_uorg=bairrouorg"),
        *ruled(clean_digits, "cep_uorg=cepuorg"),
        *ruled(
            clean,
            "codigo_matricula=codmatricula codigo_municipio_uorg=codmunicipiouorg codigo_orgao=codorgao"
            " codigo_orgao_uorg=codorgaouorg",
        ),
        *ruled(clean_lower, "email_uorg=emailuorg"),
        *ruled(
            clean,
            "tipo_endereco_uorg=enduorg logradouro_uorg=logradourouorg"
            " nome_municipio_uorg=nomemunicipiouorg nome_uorg=nomeuorg",
        ),
        *ruled(clean_digits, "telefone_uorg=numtelefoneuorg"),
        *ruled(clean, "numero_endereco_uorg=numerouorg sigla_uorg=siglauorg"),
        *ruled(clean_upper, "uf_uorg=ufuorg"),
        *ruled(clean_digits, "cpf"),
        *ruled(lambda c: text.sentinel_to_null(c, "---"), "complemento_endereco_uorg=complementouorg"),
        *ruled(clean_digits, "fax_uorg=numfaxuorg"),
    ])


def lista_servidores(raw: DataFrame) -> DataFrame:
    """Staff list: a person may be in several units."""
    return shaped(raw, ruled(same, "cpf dt_ultima_transacao=dataultimatransacao cod_uorg=coduorg"))


def lista_uorgs(raw: DataFrame) -> DataFrame:
    """Unit list of the personnel system."""
    return shaped(raw, [*ruled(as_int, "codigo"), *kept("dt_ultima_transacao nome")])


def terceirizados(raw: DataFrame) -> DataFrame:
    """Outsourced staff; the user text splits into person number and name."""
    iso = lambda c: dates.parsed(c, dates.ISO)
    return shaped(raw, [
        *kept("id contrato_id"),
        ("cpf", "usuario", lambda c: text.capture(c, "(.+) - ")),
        ("nome", "usuario", lambda c: text.capture(c, "- (.+)")),
        *kept("funcao_id descricao_complementar"),
        *ruled(lambda c: c.try_cast("decimal(18,2)"), "jornada"),
        *kept("unidade"),
        *ruled(money_br, "salario custo"),
        *kept("escolaridade_id"),
        *ruled(iso, "data_inicio data_fim"),
        *kept("situacao"),
        *ruled(money_br, "aux_transporte vale_alimentacao"),
    ])


# ---------------------------------------------------------------- bronze: units and posts

ACT_COLUMNS = " ".join(
    f"atonormativo__{part}" for part in
    "tipoato codigounidade numero dataassinatura datapublicacao datavigencia ementa url codigotipo siglatipo".split()
)


def _array(df: DataFrame, column: str, element_ddl: str) -> Column:
    """The array column itself, or parsed when it was landed as text."""
    if dict(df.dtypes)[column] == "string":
        return text.python_list(column, element_ddl)
    return F.col(column)


def cargos_funcoes(raw: DataFrame) -> DataFrame:
    """One row per post type and denomination."""
    names = kept("codigotipo nome sigla codigocargofuncao categoria nivel regraautoridade " + ACT_COLUMNS)
    column = "denominacoes__denominacao"
    wide = shaped(raw, [*names, *kept(column)])
    rows = wide.withColumn("_d", F.explode(_array(wide, column, DENOMINATION)))
    return rows.select(
        *[n for n, _, _ in names],
        F.col("_d.codigo").alias("denominacao_codigo"),
        F.col("_d.descricao").alias("denominacao_descricao"),
    )


DENOMINATION = "codigo: string, descricao: string"
POST_ELEMENT = (
    "denominacao: string, funcao: string,"
    " instancias: array<struct<codigoInstancia: string, nomeTitular: string, cpfTitular: string>>"
)


def estrutura_organizacional_cargos(raw: DataFrame) -> DataFrame:
    """One row per post instance. An instance listed under several units belongs to the deepest.

    Depth is compared as a number; as landed text, 9 would come after 10.
    """
    unit = "codigounidade nomeunidade siglaunidade municipio uf"
    wide = shaped(raw, [*kept(unit + " cargos"), *kept("ordem_grandeza")])
    posts = wide.withColumn("_p", F.explode(_array(wide, "cargos", POST_ELEMENT)))
    instances = posts.withColumn("_i", F.explode("_p.instancias")).select(
        *unit.split(),
        F.col("_p.denominacao").alias("denominacao"),
        F.col("_p.funcao").alias("funcao"),
        F.col("_i.codigoInstancia").alias("codigo_instancia"),
        F.col("_i.nomeTitular").alias("nome_titular"),
        F.col("_i.cpfTitular").alias("cpf_titular"),
        "ordem_grandeza",
    )
    others = [F.col(c).asc_nulls_last() for c in instances.columns if c not in ("codigo_instancia", "ordem_grandeza")]
    depth = F.col("ordem_grandeza").try_cast("int")
    return keep_one(instances, ["codigo_instancia"], depth.desc_nulls_first(), *others)


def unidade_organizacional(raw: DataFrame) -> DataFrame:
    """The units below the root, with depth and path of siglas."""
    nodes = shaped(raw, [
        *ruled(text.uri_tail, "codigounidade codigounidadepai codigoorgaoentidade codigotipounidade"),
        *kept("nome sigla"),
        *ruled(text.uri_tail, "codigoesfera codigopoder codigonaturezajuridica"),
        *kept(
            "codigosubnaturezajuridica nivelnormatizacao versaoconsulta datafinalversaoconsulta operacao"
            " codigounidadepaianterior codigoorgaoentidadeanterior"
        ),
    ])
    return tree_paths(
        nodes, "codigounidade", "codigounidadepai", "sigla",
        is_root=F.col("codigounidade") == ROOT_UNIT, depth="ordem_grandeza", path="caminho_unidade",
    )


# ---------------------------------------------------------------- silver


def afastamento_consolidado(
    dados_afastamento: DataFrame,
    afastamento_historico: DataFrame,
    dados_pessoais: DataFrame,
    dados_funcionais: DataFrame,
) -> DataFrame:
    """Leave of both sources, one row per person and start date, the current source preferred.

    Ranking a person's leave by start date gives equal ranks to equal dates only, so the kept row
    is simply the first per person and date.
    """
    current = dados_afastamento.withColumn("origem_dados", F.lit("dados_afastamento"))
    past = afastamento_historico.withColumn("origem_dados", F.lit("afastamento_historico"))
    both = current.unionByName(past)
    others = [F.col(c).asc_nulls_last() for c in both.columns if c not in ("cpf", "dt_ini", "origem_dados")]
    source_first = F.when(F.col("origem_dados") == "dados_afastamento", 1).otherwise(2)
    leave = keep_one(both, ["cpf", "dt_ini"], source_first, *others)
    names = dados_pessoais.select("nome_pessoa", "cpf").distinct()
    posts = dados_funcionais.select("cpf", "cod_funcao", "sigla_uorg_exercicio").distinct()
    return leave.join(names, "cpf", "left").join(posts, "cpf", "left")


def _short_code(code: Column) -> Column:
    """Initial and last three characters: what the two systems' post codes have in common."""
    return F.concat(F.substring(code, 1, 1), text.piece(code, F.length(code) - 2, 3))


def _office(sigla: Column) -> Column:
    return F.when(sigla == OFFICE_SIGLA[0], F.lit(OFFICE_SIGLA[1])).otherwise(sigla)


def quantitativo_alocados_ocupados(
    dados_funcionais: DataFrame, estrutura_organizacional_cargos: DataFrame
) -> DataFrame:
    """Posts offered, occupied and vacant per post code and unit."""
    offered = (
        estrutura_organizacional_cargos.distinct()
        .groupBy("funcao", "nomeunidade", "siglaunidade", "denominacao")
        .agg(F.count(F.lit(1)).alias("qtd_vagas_cargo"))
        .withColumns({
            "funcao": F.replace("funcao", F.lit(" "), F.lit("")),
            "siglaunidade": _office(F.col("siglaunidade")),
        })
        .withColumn("_code", _short_code(F.col("funcao")))
    )
    occupied = (
        dados_funcionais.where("cod_funcao is not null and dt_ocorr_aposentadoria is null")
        .distinct()
        .groupBy("cod_funcao", "nome_uorg_exercicio", "sigla_uorg_exercicio", "nome_cargo")
        .agg(F.count(F.lit(1)).alias("_occupied"))
        .withColumn("_held_code", _short_code(F.col("cod_funcao")))
    )
    joined = splittable_full_join(
        offered, occupied, ["_code", "siglaunidade"], ["_held_code", "sigla_uorg_exercicio"]
    )
    return joined.select(
        F.col("cod_funcao").alias("codigo_siape"),
        F.col("funcao").alias("codigo_siorg"),
        F.coalesce("nomeunidade", "nome_uorg_exercicio").alias("nomeunidade"),
        F.coalesce("siglaunidade", "sigla_uorg_exercicio").alias("siglaunidade"),
        F.coalesce("denominacao", "nome_cargo").alias("nome_cargo"),
        "qtd_vagas_cargo",
        F.coalesce("_occupied", F.lit(0)).alias("qtd_vagas_ocupadas"),
        (F.col("qtd_vagas_cargo") - F.coalesce("_occupied", F.lit(0))).alias("qtd_cargos_vagos"),
    )


# The columns of the wide view, in order.
WIDE_PERSON = (
    "cpf nome_pessoa dt_nascimento grupo_sanguineo nome_cor cod_cor nome_estado_civil cod_estado_civil"
    " nome_mae nome_pai nome_municipio_nascimento nome_nacionalidade cod_nacionalidade nome_sexo cod_sexo"
    " num_pispasep uf_nascimento cod_deficiencia_fisica nome_deficiencia_fisica dt_chegada_brasil"
    " nome_pais_origem"
).split()
WIDE_EMPLOYMENT = (
    "cod_atividade_funcao cod_funcao cod_jornada cod_ocorr_ingresso_orgao cod_ocorr_ingresso_serv_publico"
    " cod_orgao_funcional=cod_orgao cod_padrao cod_situacao_funcional cod_uorg_exercicio cod_upag"
    " cod_orgao_origem cpf_chefia_imediata dt_exercicio_no_orgao dt_fim_vale_ar dt_ingresso_funcao"
    " dt_ocorr_ingresso_orgao dt_ocorr_ingresso_serv_publico email_chefia_imediata email_institucional"
    " email_servidor ident_unica_funcional=ident_unica matricula_siape modalidade_pgd"
    " nome_atividade_funcao nome_chefe_uorg nome_funcao nome_jornada nome_ocorr_ingresso_orgao"
    " nome_ocorr_ingresso_serv_publico nome_orgao_funcional=nome_orgao nome_regime_juridico"
    " nome_situacao_funcional nome_uorg_exercicio nome_upag participa_pgd percentual_ts"
    " sigla_orgao_funcional=sigla_orgao sigla_orgao_origem sigla_regime_juridico sigla_uorg_exercicio"
    " sigla_upag cod_cargo cod_classe cod_ocorr_aposentadoria dt_ini_vale_ar dt_ocorr_aposentadoria"
    " nome_cargo nome_classe nome_ocorr_aposentadoria sigla_nivel_cargo tipo_vale_ar"
    " cod_ocorr_isencao_ir dt_ini_ocorr_isencao_ir nome_ocorr_isencao_ir cod_uorg_lotacao"
    " nome_uorg_lotacao sigla_uorg_lotacao dt_fim_ocorr_isencao_ir cod_ocorr_exclusao dt_ocorr_exclusao"
    " nome_ocorr_exclusao dt_uorg_lotacao cod_vale_transporte valor_vale_transporte dt_uorg_exercicio"
    " pontuacao_desempenho"
)
WIDE_EDUCATION = (
    "nome_escolaridade_principal=nome_escolaridade cod_escolaridade_principal=cod_escolaridade"
    " nome_titulacao_principal=nome_titulacao cod_titulacao_principal=cod_titulacao"
)
WIDE_UNIT = (
    "bairro_uorg cep_uorg codigo_matricula codigo_municipio_uorg codigo_orgao codigo_orgao_uorg email_uorg"
    " tipo_endereco_uorg logradouro_uorg nome_municipio_uorg nome_uorg telefone_uorg numero_endereco_uorg"
    " sigla_uorg uf_uorg complemento_endereco_uorg fax_uorg"
)


def servidores_detalhados(
    dados_pessoais: DataFrame,
    dados_funcionais: DataFrame,
    dados_escolares: DataFrame,
    lista_servidores: DataFrame,
    dados_uorg: DataFrame,
) -> DataFrame:
    """Everything known of a person, side by side. A person in several units has several rows.

    All joins are on the person number, so one shuffle per table serves the whole chain.
    """
    def side(df: DataFrame, pairs: str) -> DataFrame:
        return shaped(df, [("cpf", "cpf", same), *ruled(same, pairs)])

    return (
        dados_pessoais.select(*WIDE_PERSON)
        .join(side(dados_funcionais, WIDE_EMPLOYMENT), "cpf", "left")
        .join(side(dados_escolares, WIDE_EDUCATION), "cpf", "left")
        .join(side(lista_servidores, "dt_ultima_transacao_servidor=dt_ultima_transacao"), "cpf", "left")
        .join(side(dados_uorg, WIDE_UNIT), "cpf", "left")
    )


def _post_places(posts: DataFrame, units: DataFrame, *extra: str) -> DataFrame:
    """Posts with the place of their unit in the tree. A lower rank number is a higher post.

    The rank takes its level from the code as landed, blanks included, and its category from the
    code without blanks.
    """
    code = F.replace("funcao", F.lit(" "), F.lit(""))
    category = text.piece(code, F.length(code) - 2, 1)
    tree = units.select(
        F.col("codigounidade").alias("_unit"), "codigounidadepai", "caminho_unidade",
        F.col("ordem_grandeza").alias("_depth"),
    )
    return posts.join(tree, F.col("codigounidade") == F.col("_unit")).select(
        code.alias("codigo_siorg"),
        F.col("nomeunidade"),
        F.col("codigounidade"),
        F.col("ordem_grandeza").cast("string").alias("ordem_grandeza"),
        F.col("denominacao"),
        *extra,
        F.col("codigounidadepai"),
        F.col("caminho_unidade"),
        _office(F.col("siglaunidade")).alias("siglaunidade"),
        (category.try_cast("int") * 1000 - F.right("funcao", F.lit(2)).try_cast("int")).alias("hierarquia_cargo"),
        _short_code(code).alias("codigo_combinacao_siorg"),
    ).distinct()


HOLDER_PERSON = (
    "dt_nascimento nome_sexo nome_estado_civil nome_nacionalidade nome_cor uf_nascimento"
    " nome_municipio_nascimento"
).split()


def _holders(employment: DataFrame, persons: DataFrame, units: DataFrame) -> DataFrame:
    """Staff with their personal data and, by sigla, the place of their unit in the tree."""
    person = persons.select(F.col("cpf").alias("_p"), F.col("nome_pessoa").alias("servidor"), *HOLDER_PERSON)
    tree = units.select(
        F.col("sigla").alias("_sigla"),
        F.col("codigounidade").alias("_alt_unit"),
        F.col("caminho_unidade").alias("_alt_path"),
        F.col("codigounidadepai").alias("_alt_parent"),
        F.col("ordem_grandeza").cast("string").alias("_alt_depth"),
    )
    return (
        employment.join(person, F.col("cpf") == F.col("_p"), "left")
        .join(tree, F.col("sigla_uorg_exercicio") == F.col("_sigla"), "left")
        .select(
            F.col("cod_funcao").alias("codigo_siape"), "nome_uorg_exercicio", "sigla_uorg_exercicio",
            F.col("nome_cargo").alias("_own_post"), "matricula_siape", "cpf", "cpf_chefia_imediata",
            "cod_situacao_funcional", "nome_situacao_funcional", "servidor", *HOLDER_PERSON,
            "_alt_unit", "_alt_path", "_alt_parent", "_alt_depth",
            _short_code(F.col("cod_funcao")).alias("codigo_combinacao_siape"),
        )
        .distinct()
    )


# Columns of a post, each beside the one of its holder that stands in where the post's is null.
FILLED = {
    "codigounidade": "_alt_unit", "codigounidadepai": "_alt_parent", "caminho_unidade": "_alt_path", "ordem_grandeza": "_alt_depth",
    "nomeunidade": "nome_uorg_exercicio", "siglaunidade": "sigla_uorg_exercicio", "denominacao": "_own_post",
}


def _with_chief(joined: DataFrame, persons: DataFrame) -> DataFrame:
    chief = persons.select(F.col("cpf").alias("_chief"), F.col("nome_pessoa").alias("nome_chefia")).distinct()
    return joined.join(chief, F.col("cpf_chefia_imediata") == F.col("_chief"), "left")


def _beside(joined: DataFrame) -> DataFrame:
    """Post and holder side by side, unit facts from whichever side has them."""
    return joined.select(
        "codigo_siape", "codigo_siorg", "codigo_combinacao_siape", "codigo_combinacao_siorg",
        "matricula_siape", "cpf", "cpf_chefia_imediata", "cod_situacao_funcional",
        "nome_situacao_funcional", "hierarquia_cargo", "servidor", *HOLDER_PERSON, "nome_chefia",
        *[
            F.coalesce(post, *([own] if own in joined.columns else [])).alias("nome_cargo" if post == "denominacao" else post)
            for post, own in FILLED.items()
        ],
        F.when(F.col("cod_situacao_funcional") == FREE_APPOINTMENT, "Nomeação livre")
        .otherwise("Carreira").alias("servidores_carreira"),
    )


def _correlated(joined: DataFrame, persons: DataFrame) -> DataFrame:
    """Common last step: the superior's name, and unit facts from whichever side has them."""
    return _beside(_with_chief(joined, persons)).distinct()


def tabela_correlacao_cargos(
    estrutura_organizacional_cargos: DataFrame,
    unidade_organizacional: DataFrame,
    dados_funcionais: DataFrame,
    dados_pessoais: DataFrame,
) -> DataFrame:
    """The k-th post of a code in a unit beside the k-th holder of that code there."""
    posts = _post_places(estrutura_organizacional_cargos, unidade_organizacional, "codigo_instancia")
    holders = _holders(
        dados_funcionais.where("dt_ocorr_aposentadoria is null and cod_funcao is not null"),
        dados_pessoais, unidade_organizacional,
    )
    post_order = ["codigo_instancia", *[c for c in posts.columns if c != "codigo_instancia"]]
    holder_order = ["cpf", *[c for c in holders.columns if c != "cpf"]]
    joined = match_nth(
        posts, holders,
        on=[("codigo_combinacao_siorg", "codigo_combinacao_siape"), ("siglaunidade", "sigla_uorg_exercicio")],
        order_left=post_order, order_right=holder_order,
    )
    return _correlated(joined, dados_pessoais)


def unidades_organizacionais_siorg_siape(
    dados_uorg: DataFrame, lista_uorgs: DataFrame, unidade_organizacional: DataFrame
) -> DataFrame:
    """Crosswalk of the two systems' units by sigla, marked with where each was found."""
    used = dados_uorg.select(
        F.col("codigo_orgao").try_cast("int").alias("codigo_orgao"),
        "codigo_orgao_uorg",
        F.right("codigo_orgao_uorg", F.lit(7)).try_cast("int").alias("_unit"),
        F.col("sigla_uorg").alias("_sigla_siape"),
    ).distinct()
    listed = lista_uorgs.select("codigo", F.col("nome").alias("_name_siape"))
    siape = used.join(listed, F.col("_unit") == F.col("codigo"))
    siorg = unidade_organizacional.distinct().select(
        F.col("nome").alias("_name_siorg"), _office(F.col("sigla")).alias("_sigla_siorg"), "codigounidade"
    )
    joined = splittable_full_join(siape, siorg, ["_sigla_siape"], ["_sigla_siorg"])
    return joined.select(
        F.coalesce("_name_siape", "_name_siorg").alias("nome_unidade"),
        F.coalesce("_sigla_siape", "_sigla_siorg").alias("sigla_uorg"),
        F.col("_unit").alias("codigo_unidade_siape"),
        F.col("codigounidade").alias("codigo_unidade_siorg"),
        origin_flag(F.col("_name_siape"), F.col("_name_siorg"), "ambos", "apenas_siape", "apenas_siorg")
        .alias("tipo_correlacao"),
    )


# ---------------------------------------------------------------- gold


def aposentadorias_resumo(servidores_detalhados: DataFrame) -> DataFrame:
    """Retired staff and their length of service."""
    until, since = F.col("dt_ocorr_aposentadoria"), F.col("dt_ocorr_ingresso_serv_publico")
    retired = servidores_detalhados.where(until.isNotNull()).select(
        "cpf", "nome_pessoa", "dt_ocorr_ingresso_serv_publico", "dt_ocorr_aposentadoria",
        F.date_trunc("month", until).alias("mes_aposentadoria"),
        "nome_situacao_funcional", "nome_ocorr_aposentadoria", "nome_cargo", "sigla_nivel_cargo",
        F.concat("cod_classe", F.lit("-"), "cod_padrao").alias("classe_padrao"),
    ).distinct()
    aged = retired.withColumn("age", dates.calendar_age(until, since))
    return aged.withColumns({
        "diff_anos": F.col("age.years"),
        "diff_meses": F.col("age.months"),
        "diff_dias": F.col("age.days"),
    })


def cargos_consolidado(
    servidores_detalhados: DataFrame, estrutura_organizacional_cargos: DataFrame
) -> DataFrame:
    """Each person beside the post they hold, if any."""
    post = shaped(estrutura_organizacional_cargos, ruled(
        same,
        "siorg_cod_unidade=codigounidade siorg_nome_unidade=nomeunidade siorg_sigla_unidade=siglaunidade"
        " siorg_municipio_unidade=municipio siorg_uf_unidade=uf siorg_denominacao_cargo=denominacao"
        " siorg_funcao=funcao siorg_cod_instancia_cargo=codigo_instancia siorg_cpf_titular=cpf_titular"
        " siorg_nome_titular=nome_titular",
    ))
    person = shaped(servidores_detalhados, ruled(
        same,
        "siape_cpf=cpf siape_nome_pessoa=nome_pessoa siape_nome_cargo_efetivo=nome_cargo"
        " siape_nome_funcao_comissionada=nome_funcao siape_cod_uorg=cod_uorg_exercicio"
        " siape_nome_uorg=nome_uorg_exercicio siape_sigla_uorg=sigla_uorg_exercicio siape_uf_uorg=uf_uorg"
        " siape_situacao_funcional=nome_situacao_funcional",
    ))
    joined = person.join(post, F.col("siape_cpf") == F.col("siorg_cpf_titular"), "left")
    return joined.select(*post.columns, *person.columns)


def hierarquia(
    estrutura_organizacional_cargos: DataFrame,
    unidade_organizacional: DataFrame,
    dados_funcionais: DataFrame,
    dados_pessoais: DataFrame,
) -> DataFrame:
    """Post hierarchy of active staff: every post of a code in a unit beside its holders there.

    Staff active in another agency, and posts nobody holds (their status is null), are left out.

    The rows are as many as the pairs, so pairs are neither joined again nor shuffled: superiors are found for holders,
    and a pair can only repeat another of its code and unit where a null of a post is filled from holders. Elsewhere
    distinct holders beside distinct posts are distinct rows; holders differ then only in what a row shows of them.
    """
    posts = kept_table(_post_places(estrutura_organizacional_cargos, unidade_organizacional), "posts")
    holders = _with_chief(
        _holders(
            dados_funcionais.where("dt_ocorr_aposentadoria is null and dt_ocorr_exclusao is null"),
            dados_pessoais, unidade_organizacional,
        ).where(F.col("nome_situacao_funcional") != ACTIVE_ELSEWHERE),
        dados_pessoais,
    )
    held, offered = ["codigo_combinacao_siape", "sigla_uorg_exercicio"], ["codigo_combinacao_siorg", "siglaunidade"]
    same_place = (F.col(held[0]) == F.col(offered[0])) & (F.col(held[1]) == F.col(offered[1]))
    gap = F.greatest(*[F.col(c).isNull() for c in FILLED])
    places = posts.groupBy(*[F.col(c).alias(f"_{c}") for c in offered]).agg(F.max(gap).alias("_gaps")).where(
        " and ".join(f"_{c} is not null" for c in offered))
    at = (F.col(offered[0]) == F.col(f"_{offered[0]}")) & (F.col(offered[1]) == F.col(f"_{offered[1]}"))
    held_at = (F.col(held[0]) == F.col(f"_{offered[0]}")) & (F.col(held[1]) == F.col(f"_{offered[1]}"))
    whole = places.where("not _gaps")

    shown = [c for c in holders.columns if c not in FILLED.values() or c in held]
    pairs = holders.select(*shown).distinct().join(posts.join(whole, at, "left_semi"), same_place)
    rest = splittable_full_join(
        holders.join(whole, held_at, "left_anti"), posts.join(whole, at, "left_anti"), held, offered,
    )
    return _beside(pairs).union(_beside(rest).distinct()).where(
        F.col("nome_situacao_funcional") != ACTIVE_ELSEWHERE
    )


def resumo_quadro_pessoal(servidores_detalhados: DataFrame) -> DataFrame:
    """Head-count by post, sex, status and state; a person in several units counts once."""
    def label(column: str, name: str) -> Column:
        return F.coalesce(column, F.lit("N/A")).alias(name)

    return servidores_detalhados.groupBy(
        label("nome_cargo", "cargo_efetivo"),
        label("nome_sexo", "genero"),
        label("nome_situacao_funcional", "situacao_funcional"),
        label("uf_uorg", "localidade_uf"),
    ).agg(F.count_distinct("cpf").alias("quantidade_servidores"))
