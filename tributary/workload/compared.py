"""Columns on which each product is compared: (text and numbers, decimals, dates).

These are the columns that the derived raw tables fill.
"""

OUTPUT: dict[str, tuple[str, str, str]] = {
    "contratos": (
        (
            "id numero licitacao_numero categoria codigo_modalidade modalidade tipo situacao objeto processo "
            "fornecedor_tipo fornecedor_nome fornecedor_cnpj_cpf_idgener "
            "contratante__orgao__unidade_gestora__codigo "
            "contratante__orgao_origem__unidade_gestora_origem__codigo "
            "contratante__orgao_origem__unidade_gestora_origem__nome_resumido num_parcelas"
        ),
        "valor_inicial valor_global valor_parcela valor_acumulado",
        "data_assinatura vigencia_inicio vigencia_fim",
    ),
    "cronogramas": (
        "id contrato_id tipo numero receita_despesa observacao mesref anoref retroativo",
        "valor",
        "vencimento",
    ),
    "empenhos": (
        "id contrato_id unidade_gestora nota_empenho credor",
        "empenhado aliquidar liquidado pago",
        "data_emissao",
    ),
    "empenhos_tesouro": (
        (
            "emissao_mes emissao_dia ne_ccor ne_num_processo ne_info_complementar ne_ccor_descricao "
            "doc_observacao natureza_despesa natureza_despesa_descricao ne_ccor_favorecido "
            "ne_ccor_favorecido_descricao ne_ccor_ano_emissao ptres"
        ),
        "despesas_empenhadas despesas_liquidadas despesas_pagas restos_a_pagar_inscritos restos_a_pagar_pagos",
        "",
    ),
    "faturas": (
        "id contrato_id numero mesref anoref situacao id_empenho numero_empenho valor_empenho subelemento",
        "valor juros multa glosa valorliquido",
        "emissao vencimento",
    ),
    "identificadores": ("contrato_id categoria processo cnpj_cpf info_complementar ne", "", ""),
    "contratos_empenhos": (
        (
            "contrato_id ne_transformed ne_ccor ne_info_complementar ne_num_processo ne_ccor_descricao "
            "doc_observacao natureza_despesa natureza_despesa_descricao ne_ccor_favorecido ne_ccor_ano_emissao"
        ),
        "despesas_empenhadas despesas_liquidadas despesas_pagas",
        "",
    ),
    "estagios_mensal": (
        "ne cnpj_cpf info_complementar num_processo",
        "valor_empenhado valor_liquidado valor_pago restos_a_pagar restos_a_pagar_pago",
        "mes_lancamento",
    ),
    "contratos_estagios": (
        "contrato_id",
        "valor_empenhado valor_liquidado valor_pago restos_a_pagar restos_a_pagar_pago",
        "mes_lancamento",
    ),
    "contratos_faturas": (
        (
            "id contrato_id numero mesref anoref situacao id_empenho numero_empenho valor_empenho subelemento "
            "numero_contrato contrato_processo fornecedor_cnpj_cpf_idgener objeto_contrato"
        ),
        "valor juros multa glosa valorliquido",
        "emissao vencimento",
    ),
    "cronogramas_faturas_mensal": (
        "contrato_id",
        "valor_cronograma valor_faturas_pagas valor_faturas_pendentes saldo_contratual_disponivel",
        "mes_ref",
    ),
    "preenchimento_meses": ("contrato_id", "", "mes_ref"),
    "contratos_comparativo_mensal": (
        "contrato_id",
        (
            "comprasgov_valor_cronograma comprasgov_valor_faturas comprasgov_saldo_contratual_disponivel "
            "siafi_valor_empenhado siafi_valor_liquidado siafi_valor_pago siafi_restos_a_pagar "
            "siafi_restos_a_pagar_pago"
        ),
        "mes_ref",
    ),
    "contratos_resumo": (
        (
            "contrato_id fornecedor_cnpj_cpf numero categoria modalidade tipo situacao pendente_baixa "
            "fornecedor_nome objeto num_parcelas fornecedor_tipo Unidade continuado"
        ),
        "valor_global despesas_pagas",
        "vigencia_inicio vigencia_fim",
    ),
    "contratos_somatorio": (
        "contrato_id",
        (
            "total_cronograma total_faturas total_saldo_disponivel orcamento_a_executar total_empenhado "
            "total_liquidado total_pago"
        ),
        "",
    ),
    "visao_orcamentaria_total": (
        "ano_exercicio unidade_orcamentaria unidade_orcamentaria_desc acao_governo elemento_despesa",
        (
            "projeto_inicial_loa dotacao_inicial dotacao_atualizada credito_disponivel despesas_empenhadas "
            "despesas_a_liquidar despesar_a_pagar despesas_pagas restos_a_pagar_inscritos restos_a_pagar_pagos"
        ),
        "dt_ingest",
    ),
    "afastamento_historico": (
        (
            "adiantamento_salario_ferias ano_exercicio gratificacao_natalina parcela_continuacao_interrupcao "
            "parcela_interrompida cod_diploma_afastamento cod_ocorrencia desc_diploma_afastamento desc_ocorrencia "
            "dias_restantes numero_parcela qtde_dias numero_diploma_afastamento cpf gr_matricula"
        ),
        "",
        (
            "dt_fim dt_fim_aquisicao dt_ini dt_inicio_aquisicao dt_inicio_ferias_interrompidas "
            "dt_publicacao_afastamento"
        ),
    ),
    "cargos_funcoes": (
        (
            "codigotipo nome sigla codigocargofuncao categoria nivel atonormativo__tipoato denominacao_codigo "
            "denominacao_descricao"
        ),
        "",
        "",
    ),
    "dados_afastamento": (
        (
            "adiantamento_salario_ferias ano_exercicio gratificacao_natalina parcela_continuacao_interrupcao "
            "parcela_interrompida cod_diploma_afastamento cod_ocorrencia desc_diploma_afastamento desc_ocorrencia "
            "dias_restantes numero_parcela qtde_dias numero_diploma_afastamento cpf gr_matricula"
        ),
        "",
        (
            "dt_fim dt_fim_aquisicao dt_ini dt_inicio_aquisicao dt_inicio_ferias_interrompidas "
            "dt_publicacao_afastamento"
        ),
    ),
    "dados_curriculo": (
        "cpf codigo_experiencia nome_curso descricao_projeto",
        "",
        "dt_mes_conclusao dt_mes_inicio dt_mes_fim",
    ),
    "dados_dependentes": (
        "cpf nome_dependente cod_beneficio nome_beneficio cod_grau_parentesco",
        "",
        "dt_inicio dt_fim",
    ),
    "dados_escolares": ("cpf cod_escolaridade nome_escolaridade cod_titulacao nome_titulacao", "", ""),
    "dados_financeiros": (
        "cpf cod_rubrica indicador_rd nome_rubrica",
        "valor_rubrica",
        "data_anomes_rubrica mes_ano_pagamento",
    ),
    "dados_funcionais": (
        (
            "cod_atividade_funcao cod_funcao cod_jornada cod_ocorr_ingresso_orgao cod_ocorr_ingresso_serv_publico "
            "cod_orgao cod_padrao cod_situacao_funcional cod_uorg_exercicio cod_upag cod_orgao_origem ident_unica "
            "matricula_siape modalidade_pgd nome_atividade_funcao nome_chefe_uorg nome_funcao nome_jornada "
            "nome_ocorr_ingresso_orgao nome_ocorr_ingresso_serv_publico nome_orgao nome_regime_juridico "
            "nome_situacao_funcional nome_uorg_exercicio nome_upag participa_pgd sigla_orgao sigla_orgao_origem "
            "sigla_regime_juridico sigla_uorg_exercicio sigla_upag cod_cargo cod_classe cod_ocorr_aposentadoria "
            "nome_cargo nome_classe nome_ocorr_aposentadoria sigla_nivel_cargo tipo_vale_ar cod_ocorr_isencao_ir "
            "nome_ocorr_isencao_ir cod_uorg_lotacao nome_uorg_lotacao sigla_uorg_lotacao cod_ocorr_exclusao "
            "nome_ocorr_exclusao cod_vale_transporte pontuacao_desempenho cpf_chefia_imediata cpf "
            "email_institucional"
        ),
        "percentual_ts valor_vale_transporte",
        (
            "dt_exercicio_no_orgao dt_fim_vale_ar dt_ingresso_funcao dt_ocorr_ingresso_orgao "
            "dt_ocorr_ingresso_serv_publico dt_ini_vale_ar dt_ocorr_aposentadoria dt_ini_ocorr_isencao_ir "
            "dt_fim_ocorr_isencao_ir dt_ocorr_exclusao dt_uorg_lotacao dt_uorg_exercicio"
        ),
    ),
    "dados_pa": (
        (
            "agencia_beneficiario conta_beneficiario cpf_beneficiario nome_beneficiario valor_ultima_pensao "
            "cpf_servidor"
        ),
        "",
        "",
    ),
    "dados_pessoais": (
        (
            "cod_sexo nome_pessoa nome_cor nome_municipio_nascimento nome_pai nome_sexo num_pispasep "
            "uf_nascimento cpf"
        ),
        "",
        "dt_nascimento dt_chegada_brasil",
    ),
    "dados_uorg": (
        (
            "cep_uorg codigo_orgao codigo_orgao_uorg sigla_uorg uf_uorg cpf complemento_endereco_uorg bairro_uorg "
            "email_uorg"
        ),
        "",
        "",
    ),
    "estrutura_organizacional_cargos": (
        (
            "codigounidade nomeunidade siglaunidade municipio uf denominacao funcao codigo_instancia nome_titular "
            "cpf_titular ordem_grandeza"
        ),
        "",
        "",
    ),
    "lista_servidores": ("cpf dt_ultima_transacao cod_uorg", "", ""),
    "lista_uorgs": ("codigo dt_ultima_transacao nome", "", ""),
    "terceirizados": (
        "id contrato_id cpf nome funcao_id unidade situacao",
        "jornada salario custo aux_transporte vale_alimentacao",
        "data_inicio data_fim",
    ),
    "unidade_organizacional": (
        "codigounidade codigounidadepai nome sigla ordem_grandeza caminho_unidade",
        "",
        "",
    ),
    "afastamento_consolidado": (
        (
            "adiantamento_salario_ferias ano_exercicio gratificacao_natalina parcela_continuacao_interrupcao "
            "parcela_interrompida cod_diploma_afastamento cod_ocorrencia desc_diploma_afastamento desc_ocorrencia "
            "dias_restantes numero_parcela qtde_dias numero_diploma_afastamento cpf gr_matricula origem_dados "
            "nome_pessoa cod_funcao sigla_uorg_exercicio"
        ),
        "",
        (
            "dt_fim dt_fim_aquisicao dt_ini dt_inicio_aquisicao dt_inicio_ferias_interrompidas "
            "dt_publicacao_afastamento"
        ),
    ),
    "quantitativo_alocados_ocupados": (
        (
            "codigo_siape codigo_siorg nomeunidade siglaunidade nome_cargo qtd_vagas_cargo qtd_vagas_ocupadas "
            "qtd_cargos_vagos"
        ),
        "",
        "",
    ),
    "servidores_detalhados": (
        (
            "cpf nome_pessoa nome_sexo cod_funcao nome_cargo nome_funcao cod_classe cod_padrao "
            "nome_situacao_funcional nome_ocorr_aposentadoria sigla_nivel_cargo cod_uorg_exercicio "
            "nome_uorg_exercicio sigla_uorg_exercicio cod_escolaridade_principal dt_ultima_transacao_servidor "
            "uf_uorg cep_uorg"
        ),
        "percentual_ts",
        "dt_ocorr_aposentadoria dt_ocorr_ingresso_serv_publico",
    ),
    "tabela_correlacao_cargos": (
        (
            "codigo_siape codigo_siorg codigo_combinacao_siape codigo_combinacao_siorg matricula_siape cpf "
            "cpf_chefia_imediata cod_situacao_funcional nome_situacao_funcional hierarquia_cargo servidor "
            "nome_sexo nome_cor uf_nascimento nome_municipio_nascimento nome_chefia codigounidade "
            "codigounidadepai caminho_unidade ordem_grandeza nomeunidade siglaunidade nome_cargo "
            "servidores_carreira"
        ),
        "",
        "dt_nascimento",
    ),
    "unidades_organizacionais_siorg_siape": (
        "nome_unidade sigla_uorg codigo_unidade_siape codigo_unidade_siorg tipo_correlacao",
        "",
        "",
    ),
    "aposentadorias_resumo": (
        (
            "cpf nome_pessoa nome_situacao_funcional nome_ocorr_aposentadoria nome_cargo sigla_nivel_cargo "
            "classe_padrao diff_anos diff_meses diff_dias"
        ),
        "",
        "dt_ocorr_ingresso_serv_publico dt_ocorr_aposentadoria mes_aposentadoria",
    ),
    "cargos_consolidado": (
        (
            "siorg_cod_unidade siorg_nome_unidade siorg_sigla_unidade siorg_municipio_unidade siorg_uf_unidade "
            "siorg_denominacao_cargo siorg_funcao siorg_cod_instancia_cargo siorg_cpf_titular siorg_nome_titular "
            "siape_cpf siape_nome_pessoa siape_nome_cargo_efetivo siape_nome_funcao_comissionada siape_cod_uorg "
            "siape_nome_uorg siape_sigla_uorg siape_uf_uorg siape_situacao_funcional"
        ),
        "",
        "",
    ),
    "hierarquia": (
        (
            "codigo_siape codigo_siorg codigo_combinacao_siape codigo_combinacao_siorg matricula_siape cpf "
            "cpf_chefia_imediata cod_situacao_funcional nome_situacao_funcional hierarquia_cargo servidor "
            "nome_sexo nome_cor uf_nascimento nome_municipio_nascimento nome_chefia codigounidade "
            "codigounidadepai caminho_unidade ordem_grandeza nomeunidade siglaunidade nome_cargo "
            "servidores_carreira"
        ),
        "",
        "dt_nascimento",
    ),
    "resumo_quadro_pessoal": (
        "cargo_efetivo genero situacao_funcional localidade_uf quantidade_servidores",
        "",
        "",
    ),
    "nc_tesouro": (
        "nc nc_transferencia nc_fonte_recursos ptres nc_evento nc_evento_descr nc_natureza_despesa",
        "nc_valor_linha movimento_liquido",
        "emissao_mes emissao_dia",
    ),
    "pf_tesouro": (
        "ug_emitente ug_favorecido pf_evento pf_evento_descricao pf pf_inscricao pf_acao_descricao",
        "pf_valor_linha",
        "emissao_mes emissao_dia",
    ),
    "planos_acao": (
        (
            "id_plano_acao id_programa sigla_unidade_descentralizada ted_beneficiario_emitente "
            "unidade_descentralizada tx_situacao_plano_acao"
        ),
        "vl_total_plano_acao",
        "dt_inicio_vigencia dt_fim_vigencia",
    ),
    "num_transf_n_plano_acao": ("num_transf plano_acao", "", ""),
    "empenhos_plano_acao": (
        (
            "emissao_mes emissao_dia ne_ccor ne_num_processo ne_info_complementar ne_ccor_descricao "
            "doc_observacao natureza_despesa natureza_despesa_descricao ne_ccor_favorecido "
            "ne_ccor_favorecido_descricao ne_ccor_ano_emissao ptres ne num_transf nc plano_acao"
        ),
        "despesas_empenhadas despesas_liquidadas despesas_pagas restos_a_pagar_inscritos restos_a_pagar_pagos",
        "",
    ),
    "nc_plano_acao": (
        (
            "plano_acao num_transf nc nc_fonte_recursos ptres ug_emitente nc_natureza_despesa nc_evento "
            "nc_evento_descr"
        ),
        "nc_valor",
        "emissao_dia",
    ),
    "pf_plano_acao": (
        "pf num_transf ug_emitente ug_favorecido pf_evento pf_evento_descricao pf_acao plano_acao",
        "pf_valor_linha",
        "emissao_mes emissao_dia",
    ),
    "ted_resumo_orcamentario": (
        "plano_acao num_transf sigla_unidade_descentralizada ted_beneficiario_emitente",
        (
            "valor_firmado orcamento_recebido orcamento_devolvido empenhado empenho_anulado "
            "despesas_pagas_exercicio despesas_pagas_rap restos_a_pagar despesas_liquidada financeiro_recebido "
            "financeiro_devolvido financeiro_cancelado"
        ),
        "",
    ),
}
