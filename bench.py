"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1) and BENCH_CPUS the local cores. Each query is built and
run to completion into Spark's ``noop`` sink; preparatory writes a query makes count as its time.
The products start from raw tables, which are derived from the data and landed once beforehand;
that time is given apart.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tributary.session import build_session
from tributary.workload.derived import RAW, land_raw
from tributary.workload.registry import QUERIES

HEADLINE = [
    "headcount_summary", "money_parse", "month_label_parse", "service_length", "json_explode",
    "array_unnest_sign", "left_star", "right_residue", "full_outer_months", "month_spine_per_customer",
    "semi_join", "anti_null_aware", "anti_not_exists", "tree_descent", "occurrence_match",
    "occurrence_number", "rank_in_group", "cascade_link", "sums_conditional", "top1_priority",
    "window_min", "union_distinct", "upsert_latest", "dedupe_business_key", "snapshot_scd2",
    "year_block_report", "headerless_extract", "xml_repeated", "incremental_landing",
    "product_empenhos_tesouro", "product_faturas", "product_identificadores",
    "product_contratos_empenhos", "product_estagios_mensal", "product_contratos_estagios",
    "product_cronogramas_faturas_mensal", "product_contratos_comparativo_mensal",
    "product_contratos_resumo", "product_contratos_somatorio", "product_servidores_detalhados",
    "product_tabela_correlacao_cargos", "product_hierarquia", "product_resumo_quadro_pessoal",
    "product_afastamento_consolidado", "product_empenhos_plano_acao", "product_pf_plano_acao",
    "product_ted_resumo_orcamentario",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["headcount_summary"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    start = time.perf_counter()
    for name in RAW if any(n.startswith("product_") for n in names) else []:
        land_raw(spark, sf_dir, name)
    landing = round(time.perf_counter() - start, 3)
    print(f"landing: {landing}", file=sys.stderr, flush=True)
    for name in names:
        start = time.perf_counter()
        QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "landing_raw_tables": landing,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
