"""Raw tables: their keys, how they are written, and table input/output."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.history import snapshot, start_history
from tributary.operators.keyed import all_not_null, drop_copies, merge_rows, replace_groups, upsert
from tributary.session import create_text, folder_names, kept_table


@dataclass(frozen=True)
class Landing:
    """How a raw table takes a batch: ``upsert`` by key, ``replace`` all rows of a key, ``append``,
    ``append_dedupe`` or ``refresh``.
    """

    schema: str
    mode: str
    keys: tuple[str, ...] = ()


# The raw tables of each source system with their keys. Pay items and dependants'
# benefits come as several rows per person, which are replaced together so that none is lost.
LANDINGS = {
    "contratos": Landing("compras_gov", "upsert", ("id",)),
    "faturas": Landing("compras_gov", "upsert", ("id",)),
    "empenhos": Landing("compras_gov", "upsert", ("id", "contrato_id")),
    "cronograma": Landing("compras_gov", "refresh", ("id",)),
    "terceirizados": Landing("compras_gov", "upsert", ("id",)),
    "notas_empenho": Landing("siafi", "upsert", ("numempenho", "anoempenho")),
    "nota_credito": Landing("siafi", "upsert", ("numero", "ano")),
    "programacao_financeira_siafi": Landing("siafi", "upsert", ("trf__numerodocumento",)),
    "empenhos_tesouro": Landing("siafi", "upsert", (
        "ne_ccor", "natureza_despesa", "doc_observacao", "ne_ccor_ano_emissao", "emissao_dia",
        "emissao_mes", "despesas_empenhadas", "despesas_liquidadas", "despesas_pagas",
    )),
    "nc_tesouro": Landing("siafi", "append_dedupe"),
    "pf_tesouro": Landing("siafi", "append_dedupe"),
    "visao_orcamentaria_total": Landing("siafi", "refresh"),
    "programas": Landing("transfere_gov", "upsert", ("id_programa",)),
    "planos_acao": Landing("transfere_gov", "upsert", ("id_plano_acao",)),
    "notas_de_credito": Landing("transfere_gov", "upsert", ("id_nota",)),
    "programacao_financeira": Landing("transfere_gov", "upsert", ("id_programacao",)),
    "unidade_organizacional": Landing("siorg", "upsert", ("codigounidade",)),
    "estrutura_organizacional_cargos": Landing("siorg", "upsert", ("codigounidade",)),
    "cargos_funcao": Landing("siorg", "upsert", ("codigocargofuncao",)),
    "lista_uorgs": Landing("siape", "upsert", ("codigo",)),
    "lista_servidores": Landing("siape", "upsert", ("cpf", "coduorg")),
    "dados_pa": Landing("siape", "upsert", ("cpf_servidor",)),
    "dados_dependentes": Landing("siape", "replace", ("cpf",)),
    "pensoes_instituidas": Landing("siape", "upsert", ("id_registro",)),
    "afastamento_historico": Landing("siape", "append"),
    "dados_pessoais": Landing("siape", "upsert", ("cpf",)),
    "dados_funcionais": Landing("siape", "upsert", ("cpf",)),
    "dados_financeiros": Landing("siape", "replace", ("cpf",)),
    "dados_escolares": Landing("siape", "upsert", ("cpf",)),
    "dados_curriculo": Landing("siape", "upsert", ("cpf",)),
    "dados_afastamento": Landing("siape", "upsert", ("cpf",)),
    "dados_uorg": Landing("siape", "upsert", ("cpf",)),
    "info_aposentadoria": Landing("siape", "upsert", ("cpf",)),
}

# Column order of the headerless treasury extracts.
EXTRACT_COLUMNS = {
    "empenhos_tesouro": [
        "emissao_mes", "emissao_dia", "ne_ccor", "ne_num_processo", "ne_info_complementar",
        "ne_ccor_descricao", "doc_observacao", "natureza_despesa", "natureza_despesa_descricao",
        "ne_ccor_favorecido", "ne_ccor_favorecido_descricao", "ne_ccor_ano_emissao", "ptres",
        "fonte_recursos_detalhada", "fonte_recursos_detalhada_descricao", "despesas_empenhadas",
        "despesas_liquidadas", "despesas_pagas", "restos_a_pagar_inscritos", "restos_a_pagar_pagos",
    ],
    "nc_tesouro": [
        "emissao_mes", "emissao_dia", "nc", "nc_transferencia", "nc_fonte_recursos",
        "nc_fonte_recursos_descricao", "ptres", "nc_evento", "nc_evento_descricao", "ug_responsavel",
        "ug_responsavel_descricao", "natureza_despesa", "natureza_despesa_detalhada", "plano_interno",
        "plano_detalhado_descricao1", "plano_detalhado_descricao2", "favorecido_doc",
        "favorecido_doc_descricao", "nc_valor_linha", "movimento_liquido",
    ],
    "pf_tesouro": [
        "emissao_mes", "emissao_dia", "ug_emitente", "ug_emitente_descricao", "ug_favorecido",
        "ug_favorecido_descricao", "pf_evento", "pf_evento_descricao", "pf", "pf_inscricao", "pf_acao",
        "pf_acao_descricao", "pf_fonte_recursos", "pf_fonte_recursos_descricao",
        "pf_vinculacao_pagamento", "pf_vinculacao_pagamento_descricao", "pf_categoria_gasto",
        "pf_recurso", "pf_recurso_descricao", "doc_observacao", "pf_valor_linha",
    ],
    "visao_orcamentaria_total": [
        "unidade_orcamentaria", "unidade_orcamentaria_desc", "acao_governo", "acao_governo_desc",
        "programa_governo", "programa_governo_desc", "unidade_plano_orcamentario",
        "plano_orcamentario_1", "plano_orcamentario_2", "programa_plano_orcamentario",
        "acao_plano_orcamentario", "plano_orcamentario_6", "plano_orcamentario_desc",
        "elemento_despesa", "elemento_despesa_desc", "orgao_uge", "orgao_uge_desc",
        "uge_matriz_filial", "ug_executora", "ug_executora_desc", "projeto_inicial_loa",
        "dotacao_inicial", "dotacao_atualizada", "credito_disponivel", "despesas_empenhadas",
        "despesas_a_liquidar", "despesar_a_pagar", "despesas_pagas", "restos_a_pagar_inscritos",
        "restos_a_pagar_pagos",
    ],
}

# Preamble lines of each headerless extract (first those sent, then those received).
PREAMBLE_LINES = {"empenhos_tesouro": (9,), "nc_tesouro": (10, 6), "pf_tesouro": (6, 6)}


def apply_batch(name: str, current: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The raw table after a batch, by the rule of its landing.

    Empty cells in the key of an extract land as the word NaN, which the products know as empty:
    a keyed table takes no null keys, and the row must not be lost.
    """
    landing = LANDINGS[name]
    if name in EXTRACT_COLUMNS and landing.keys:
        batch = batch.fillna("NaN", subset=list(landing.keys))
    if current is None:
        current = batch.limit(0)
    if landing.mode == "refresh":
        return batch
    if landing.mode == "upsert":
        return upsert(current, batch, landing.keys, "dt_ingest" if "dt_ingest" in batch.columns else None)
    if landing.mode == "replace":
        return replace_groups(current, batch, landing.keys)
    joined = current.unionByName(batch, allowMissingColumns=True)
    if landing.mode == "append_dedupe":
        return drop_copies(joined, EXTRACT_COLUMNS[name], "dt_ingest")
    return joined


SCHEMAS = "_schemas"  # readers of the data skip names that begin so


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Materialise as Parquet. With partitions, only those present in ``df`` are replaced.

    The table's columns are kept beside it and advanced before the data: a write that breaks off leaves a column
    without values at most. A full overwrite starts them anew. A column cannot change its type otherwise.
    """
    spark = df.sparkSession
    writer = df.write.mode(mode)
    keeps = bool(partition_by) or mode == "append"
    if keeps:
        _advance_schema(spark, path, df.schema)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    if not keeps:
        _advance_schema(spark, path, df.schema)


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns that writers have brought so far; nothing for a table that ``write_table`` did not write."""
    folder = f"{path.rstrip('/')}/{SCHEMAS}"
    for name in reversed(folder_names(spark, folder)):
        text = spark.read.option("wholetext", "true").text(f"{folder}/{name}").first()
        try:
            return T.StructType.fromJson(json.loads(text[0] if text else ""))
        except ValueError:  # its writer broke off
            continue
    return None


def _advance_schema(spark: SparkSession, path: str, brought: T.StructType) -> None:
    """Add the columns that the table does not know yet, as a new numbered file; of two writers at once the later adds to the earlier's."""
    folder = f"{path.rstrip('/')}/{SCHEMAS}"
    while True:
        taken = folder_names(spark, folder)
        known = table_schema(spark, path)
        if known is None and not taken and folder_names(spark, path):
            known = spark.read.option("mergeSchema", "true").parquet(path).schema  # a table from elsewhere
        types = {f.name: f.dataType for f in known.fields} if known else {}
        changed = [f.name for f in brought.fields if f.name in types and _loose(types[f.name]) != _loose(f.dataType)]
        if changed:
            raise ValueError(f"{', '.join(changed)}: the table holds another type")
        fields = [*(known.fields if known else []), *[f for f in brought.fields if f.name not in types]]
        if known is not None and taken and len(fields) == len(known.fields):
            return
        number = int(taken[-1].removesuffix(".json")) + 1 if taken else 1
        union = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        if create_text(spark, f"{folder}/{number:06d}.json", union.json()):
            return


def _loose(kind: T.DataType) -> str:
    """A type without what says whether nulls are allowed."""
    return kind.simpleString()


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str,
    order_by: str | None = None,
) -> None:
    """Upsert into a table partitioned by a column that depends on the key alone.

    Only the partitions the batch falls into are read and rewritten. Their new content is first
    written beside the table, so the table is never read while it is being replaced, and a failed
    replacement can be repeated from there. The driver sees the touched partition values, of which
    there are no more than partitions.
    """
    _rewrite_touched(spark, path, batch, partition, lambda current: upsert(current, batch, keys, order_by))


def _rewrite_touched(
    spark: SparkSession, path: str, batch: DataFrame, partition: str, change: Callable[[DataFrame], DataFrame]
) -> None:
    """Read, change and replace the partitions that hold a row of ``batch``."""
    after = kept_table(change(read_table(spark, path).where(_in_partitions(batch, partition))), "rewrite")
    write_table(after, path, partition_by=[partition])


def _in_partitions(batch: DataFrame, partition: str) -> Column:
    """Condition on the partitions of ``batch`` as a list of values, so that readers leave the other folders alone."""
    touched = [row[0] for row in batch.select(partition).distinct().collect()]
    listed = F.col(partition).isin([v for v in touched if v is not None])
    return listed | F.col(partition).isNull() if None in touched else listed


BUCKET, DIGEST = "key_bucket", "key_digest"


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with ``key_bucket``, which depends on the key's text alone."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int"))


def with_digest(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with the digest of the columns (null unlike any text) and the bucket it falls into."""
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in (F.col(c).cast("string") for c in columns)]
    digest = F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)
    return bucketed(df.withColumn(DIGEST, digest), [DIGEST], buckets)


def append_unseen(spark: SparkSession, path: str, batch: DataFrame, columns: Sequence[str], first_by: str, buckets: int = 1024) -> None:
    """Append the rows of ``batch`` whose business ``columns`` the table does not hold yet (nulls are equal).

    The table is laid out by bucket of the business key's digest. A batch first drops its own copies (the earliest by
    ``first_by`` stays), then reads the digests, nothing else, of the buckets it falls into, and adds what is missing. So a
    batch costs what it brings and the digests of its buckets, not a regrouping of the history, and no file is rewritten.
    A repeated batch adds nothing; one that broke off adds the rest. The number of buckets belongs to the table.
    """
    own = kept_table(with_digest(drop_copies(batch, columns, first_by), columns, buckets), "batch")
    if folder_names(spark, path):
        known = read_table(spark, path).where(_in_partitions(own, BUCKET)).select(F.col(BUCKET).alias("_b"), F.col(DIGEST).alias("_d"))
        fresh = own.join(known, (F.col(BUCKET) == F.col("_b")) & (F.col(DIGEST) == F.col("_d")), "left_anti")
        write_table(kept_table(fresh, "unseen"), path, mode="append", partition_by=[BUCKET])
    else:
        write_table(own, path, partition_by=[BUCKET])


def land_batch(spark: SparkSession, path: str, name: str, batch: DataFrame, buckets: int = 64) -> None:
    """Bring the raw table at ``path`` up to a batch by the rule of its landing, touching only what the batch does.

    The same rows as ``apply_batch`` over the whole table. Keyed tables are laid out by bucket of their key, and only
    buckets that the batch falls into are read and rewritten; extracts append what the table does not hold.
    ``read_landing`` reads the table.
    """
    landing = LANDINGS[name]
    if name in EXTRACT_COLUMNS and landing.keys:
        batch = batch.fillna("NaN", subset=list(landing.keys))
    if landing.mode in ("refresh", "append"):
        write_table(batch, path, mode="overwrite" if landing.mode == "refresh" else "append")
        return
    if landing.mode == "append_dedupe":
        append_unseen(spark, path, batch, EXTRACT_COLUMNS[name], "dt_ingest", buckets)
        return
    incoming = kept_table(bucketed(batch.where(all_not_null(landing.keys)), landing.keys, buckets), "batch")
    order_by = "dt_ingest" if "dt_ingest" in batch.columns else None

    def change(current: DataFrame) -> DataFrame:
        if landing.mode == "replace":
            return replace_groups(current, incoming, landing.keys)
        return upsert(current, incoming, landing.keys, order_by)

    if any(n.startswith(f"{BUCKET}=") for n in folder_names(spark, path)):
        _rewrite_touched(spark, path, incoming, BUCKET, change)
    else:
        write_table(kept_table(change(incoming.limit(0)), "rewrite"), path, partition_by=[BUCKET])


def merge_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], buckets: int = 64) -> list[int]:
    """Merge a batch into a table by SQL equality of the keys, and return the buckets of keys that were rewritten.

    The same rows as ``merge_rows``. The whole source may come again with every run: rows the table holds as they are change
    nothing. The table is laid out by bucket of the key; one anti join against it finds the buckets of new and changed rows, and only these
    are read whole and rewritten. The first batch is taken as it is; what it holds twice under one key becomes one row with the
    next batch, as in any merge. A key with a null part never matches, so its rows are added in files of their own.
    ``read_landing`` reads the table.
    """
    rows = kept_table(bucketed(batch, keys, buckets), "batch")
    complete, partial = rows.where(all_not_null(keys)), rows.where(~all_not_null(keys))
    if not any(n.startswith(f"{BUCKET}=") for n in folder_names(spark, path)):
        if set(folder_names(spark, path)) - {SCHEMAS, "_SUCCESS", "._SUCCESS.crc"}:
            raise ValueError(f"{path}: the table is not laid out by {BUCKET}")
        write_table(rows, path, partition_by=[BUCKET])
        return [r[0] for r in rows.select(BUCKET).distinct().sort(BUCKET).collect()]
    incoming = kept_table(merge_rows(complete.limit(0), complete, keys), "batch")  # one row per key
    table = read_table(spark, path)
    whole = lambda df: F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate([BUCKET, *[c for c in df.columns if c != BUCKET]])])
    known = columns_like(table, incoming).where(_in_partitions(incoming, BUCKET))
    changed = incoming.join(known.select(whole(known).alias("_row")), whole(incoming) == F.col("_row"), "left_anti")
    doubled = known.where(all_not_null(keys)).groupBy(BUCKET, *keys).count().where("count > 1")
    touched = [r[0] for r in changed.select(BUCKET).union(doubled.select(BUCKET)).distinct().sort(BUCKET).collect()]
    if touched:
        inside = F.col(BUCKET).isin(touched)
        after = kept_table(merge_rows(table.where(inside), incoming.where(inside), keys), "merge")
        write_table(after, path, partition_by=[BUCKET])
    if not partial.isEmpty():
        write_table(partial, path, mode="append", partition_by=[BUCKET])
    return touched


def columns_like(table: DataFrame, like: DataFrame) -> DataFrame:
    """``table`` with the columns of ``like`` in its order, absent ones as null of its type."""
    return table.select(*[F.col(f.name) if f.name in table.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """A raw table that ``land_batch`` keeps, without the columns of its layout."""
    return read_table(spark, path).drop(BUCKET, DIGEST)


HISTORY_BUCKETS = 64


def update_history(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], check_cols: Sequence[str], ts: Column
) -> list[int]:
    """Bring a history table up to ``source`` and return the buckets of keys that this changed.

    The table is partitioned by ``version`` (``open``, or the time at which a version was closed, to the
    microsecond, so that runs in the same second do not replace each other's) and by bucket of the key. A run compares an
    order-independent checksum of keys and watched columns per bucket between the open versions and the source; in buckets that
    differ it looks for source rows that are not open as they are. Only buckets with such rows are read whole and
    rewritten, and only their new closed versions are added; a bucket in which rows merely vanished from the source stays, as its versions do.
    """
    source = kept_table(bucketed(source, keys, HISTORY_BUCKETS), "source")
    watched = list(dict.fromkeys([*keys, *check_cols]))
    opened = read_table(spark, path).where("version = 'open'").drop("version")
    differing = _differing_buckets(opened.select(BUCKET, *watched), source.select(BUCKET, *watched))
    row = lambda cs: F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cs)])
    stale = F.col(BUCKET).isin(differing)
    known = opened.where(stale).select(row([BUCKET, *watched]).alias("_row"))
    changed = source.where(stale).join(known, row([BUCKET, *watched]) == F.col("_row"), "left_anti")
    touched = [r[0] for r in changed.select(BUCKET).distinct().sort(BUCKET).collect()]
    if touched:
        inside = F.col(BUCKET).isin(touched)
        after = kept_table(snapshot(opened.where(inside), source.where(inside), keys, check_cols, ts), "history")
        write_table(_versioned(after), path, partition_by=["version", BUCKET])
    return touched


def _differing_buckets(one: DataFrame, other: DataFrame) -> list[int]:
    """Buckets in which two sets of rows differ, by counts and sums of row hashes; at most as many as there are buckets."""
    def checksums(df: DataFrame, sign: int) -> DataFrame:
        hashed = F.xxhash64(*[c for c in df.columns if c != BUCKET], *[F.col(c).isNull() for c in df.columns if c != BUCKET])
        sums = df.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.sum(hashed.cast("decimal(20,0)")).alias("s"))
        return sums.select(BUCKET, (F.col("n") * sign).alias("n"), (F.col("s") * sign).alias("s"))

    both = checksums(one, 1).unionByName(checksums(other, -1)).groupBy(BUCKET).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return [r[0] for r in both.where("n <> 0 OR s <> 0").select(BUCKET).collect()]


def create_history(path: str, source: DataFrame, keys: Sequence[str], ts: Column) -> None:
    """First state of a history table."""
    first = bucketed(source, keys, HISTORY_BUCKETS)
    write_table(_versioned(start_history(first, ts)), path, partition_by=["version", BUCKET])


def _versioned(history: DataFrame) -> DataFrame:
    closed_at = F.date_format("valid_to", "yyyyMMdd'T'HHmmss.SSSSSS")
    return history.withColumn("version", F.coalesce(closed_at, F.lit("open")))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table whose files may have gained columns over time.

    With the columns kept beside the table no footer is opened to plan the read; another's table is read by the union of its footers.
    """
    known = table_schema(spark, path)
    return spark.read.schema(known).parquet(path) if known else spark.read.option("mergeSchema", "true").parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    """A product kept as a view rather than a table."""
    df.createOrReplaceTempView(name)


def text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, absent ones as null text: raw tables gain columns as data brings them."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns])
