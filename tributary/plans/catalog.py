"""All data products by name: what each reads and how it is built."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import unparsed_list
from tributary.operators.refusals import Sifted, sift
from tributary.plans import budget, contracts, people, transfers
from tributary.session import kept_table
from tributary.sources.catalog import merge_table, publish_view, read_landing, read_table, write_table


@dataclass(frozen=True)
class Product:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    schema: str
    view: bool = False
    reread: bool = False  # read by several branches of its consumers: kept as a table in one plan too
    merged: tuple[str, ...] = ()  # a new run is merged into the table of the last one by this key


def _p(build: Callable[..., DataFrame], schema: str, inputs: str, **flags: bool | tuple[str, ...]) -> Product:
    return Product(build, tuple(inputs.split()), schema, **flags)


# Inputs are raw tables ("raw.x") or other products. The order is a valid build order.
PRODUCTS: dict[str, Product] = {
    "contratos": _p(contracts.contratos, "contratos", "raw.contratos"),
    "cronogramas": _p(contracts.cronogramas, "contratos", "raw.cronograma"),
    "empenhos": _p(contracts.empenhos, "contratos", "raw.empenhos"),
    "empenhos_tesouro": _p(
        contracts.empenhos_tesouro, "contratos", "raw.empenhos_tesouro", merged=tuple(contracts.TREASURY_KEY)),
    "faturas": _p(contracts.faturas, "contratos", "raw.faturas"),
    "identificadores": _p(contracts.identificadores, "contratos", "contratos empenhos faturas", view=True, reread=True),
    "contratos_empenhos": _p(contracts.contratos_empenhos, "contratos", "identificadores empenhos_tesouro"),
    "estagios_mensal": _p(contracts.estagios_mensal, "contratos", "empenhos_tesouro"),
    "contratos_estagios": _p(contracts.contratos_estagios, "contratos", "identificadores estagios_mensal"),
    "contratos_faturas": _p(contracts.contratos_faturas, "contratos", "contratos faturas"),
    "cronogramas_faturas_mensal": _p(
        contracts.cronogramas_faturas_mensal, "contratos", "cronogramas raw.faturas", reread=True),
    "preenchimento_meses": _p(
        contracts.preenchimento_meses, "contratos", "cronogramas_faturas_mensal", view=True),
    "contratos_comparativo_mensal": _p(
        contracts.contratos_comparativo_mensal, "contratos",
        "contratos_estagios cronogramas_faturas_mensal preenchimento_meses"),
    "contratos_resumo": _p(contracts.contratos_resumo, "contratos", "contratos contratos_empenhos"),
    "contratos_somatorio": _p(contracts.contratos_somatorio, "contratos", "contratos_comparativo_mensal"),
    "visao_orcamentaria_total": _p(
        budget.visao_orcamentaria_total, "orcamento", "raw.visao_orcamentaria_total"),
    "afastamento_historico": _p(people.afastamento_historico, "pessoas", "raw.afastamento_historico"),
    "cargos_funcoes": _p(people.cargos_funcoes, "pessoas", "raw.cargos_funcao"),
    "dados_afastamento": _p(people.dados_afastamento, "pessoas", "raw.dados_afastamento"),
    "dados_curriculo": _p(people.dados_curriculo, "pessoas", "raw.dados_curriculo"),
    "dados_dependentes": _p(people.dados_dependentes, "pessoas", "raw.dados_dependentes"),
    "dados_escolares": _p(people.dados_escolares, "pessoas", "raw.dados_escolares"),
    "dados_financeiros": _p(people.dados_financeiros, "pessoas", "raw.dados_financeiros"),
    "dados_funcionais": _p(people.dados_funcionais, "pessoas", "raw.dados_funcionais"),
    "dados_pa": _p(people.dados_pa, "pessoas", "raw.dados_pa"),
    "dados_pessoais": _p(people.dados_pessoais, "pessoas", "raw.dados_pessoais"),
    "dados_uorg": _p(people.dados_uorg, "pessoas", "raw.dados_uorg"),
    "estrutura_organizacional_cargos": _p(
        people.estrutura_organizacional_cargos, "pessoas", "raw.estrutura_organizacional_cargos"),
    "lista_servidores": _p(people.lista_servidores, "pessoas", "raw.lista_servidores"),
    "lista_uorgs": _p(people.lista_uorgs, "pessoas", "raw.lista_uorgs"),
    "terceirizados": _p(people.terceirizados, "pessoas", "raw.terceirizados"),
    "unidade_organizacional": _p(people.unidade_organizacional, "pessoas", "raw.unidade_organizacional"),
    "afastamento_consolidado": _p(
        people.afastamento_consolidado, "pessoas",
        "dados_afastamento afastamento_historico dados_pessoais dados_funcionais"),
    "quantitativo_alocados_ocupados": _p(
        people.quantitativo_alocados_ocupados, "pessoas",
        "dados_funcionais estrutura_organizacional_cargos"),
    "servidores_detalhados": _p(
        people.servidores_detalhados, "pessoas",
        "dados_pessoais dados_funcionais dados_escolares lista_servidores dados_uorg"),
    "tabela_correlacao_cargos": _p(
        people.tabela_correlacao_cargos, "pessoas",
        "estrutura_organizacional_cargos unidade_organizacional dados_funcionais dados_pessoais"),
    "unidades_organizacionais_siorg_siape": _p(
        people.unidades_organizacionais_siorg_siape, "pessoas",
        "dados_uorg lista_uorgs unidade_organizacional"),
    "aposentadorias_resumo": _p(people.aposentadorias_resumo, "pessoas", "servidores_detalhados"),
    "cargos_consolidado": _p(
        people.cargos_consolidado, "pessoas", "servidores_detalhados estrutura_organizacional_cargos"),
    "hierarquia": _p(
        people.hierarquia, "pessoas",
        "estrutura_organizacional_cargos unidade_organizacional dados_funcionais dados_pessoais"),
    "resumo_quadro_pessoal": _p(people.resumo_quadro_pessoal, "pessoas", "servidores_detalhados"),
    "nc_tesouro": _p(transfers.nc_tesouro, "ted", "raw.nc_tesouro"),
    "pf_tesouro": _p(transfers.pf_tesouro, "ted", "raw.pf_tesouro"),
    "planos_acao": _p(transfers.planos_acao, "ted", "raw.planos_acao"),
    "num_transf_n_plano_acao": _p(
        transfers.num_transf_n_plano_acao, "ted", "raw.notas_de_credito raw.nc_tesouro", view=True),
    "empenhos_plano_acao": _p(
        transfers.empenhos_plano_acao, "ted", "empenhos_tesouro num_transf_n_plano_acao"),
    "nc_plano_acao": _p(transfers.nc_plano_acao, "ted", "nc_tesouro num_transf_n_plano_acao"),
    "pf_plano_acao": _p(
        transfers.pf_plano_acao, "ted", "pf_tesouro raw.programacao_financeira num_transf_n_plano_acao"),
    "ted_resumo_orcamentario": _p(
        transfers.ted_resumo_orcamentario, "ted",
        "planos_acao nc_plano_acao empenhos_plano_acao pf_plano_acao"),
}


# Lists that products unfold: the raw column and the fields of an element.
LISTS: dict[str, tuple[str, str]] = {
    "faturas": ("dados_empenho", contracts.INVOICE_COMMITMENT),
    "cargos_funcoes": ("denominacoes__denominacao", people.DENOMINATION),
    "estrutura_organizacional_cargos": ("cargos", people.POST_ELEMENT),
}


def sift_lists(name: str, raw: DataFrame) -> Sifted:
    """Raw rows of a product that unfolds a list: those whose list can be read, and those it would lose.

    An empty, blank or null list is no fault: such a row has nothing to unfold. Native arrays are always read.
    """
    column, element = LISTS[name]
    broken = unparsed_list(column, element) if dict(raw.dtypes)[column] == "string" else F.lit(False)
    return sift(raw, {"list does not parse": broken})


def product(name: str, raw: Callable[[str], DataFrame], built: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A product from raw tables; ``built`` supplies products already materialised.

    Everything is one lazy plan, except that inputs which several branches read are written once.
    """
    frames: dict[str, DataFrame] = dict(built or {})

    def get(key: str) -> DataFrame:
        if key not in frames:
            if key.startswith("raw."):
                frames[key] = raw(key.removeprefix("raw."))
            else:
                entry = PRODUCTS[key]
                frame = entry.build(*[get(i) for i in entry.inputs])
                frames[key] = kept_table(frame, key) if entry.reread and key != name else frame
        return frames[key]

    return get(name)


def build_all(raw: Callable[[str], DataFrame], warehouse: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Materialise the products as Parquet below ``warehouse``, each from the tables written before it.

    Raw rows whose list does not parse go to ``refused/<product>`` there, with the reason, instead of being lost in
    the unfolding. Views stay lazy and are registered under their name. A merged product takes its last state
    along; the merge is written aside first, since it reads the table it replaces.
    """
    built: dict[str, DataFrame] = {}
    for name in names or PRODUCTS:
        entry = PRODUCTS[name]
        path = f"{warehouse.rstrip('/')}/{entry.schema}/{name}"
        frame = product(name, raw, built)
        if name in LISTS:
            sifted = sift_lists(name, raw(entry.inputs[0].removeprefix("raw.")))
            write_table(sifted.refused, f"{warehouse.rstrip('/')}/refused/{name}")
            frame = entry.build(sifted.accepted)
        if entry.merged:
            merge_table(frame.sparkSession, path, frame, entry.merged)
            built[name] = read_landing(frame.sparkSession, path)
            continue
        if entry.view:
            publish_view(frame, name)
        else:
            write_table(frame, path)
            frame = read_table(frame.sparkSession, path)
        built[name] = frame
    return built
