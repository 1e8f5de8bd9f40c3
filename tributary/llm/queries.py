"""Checked queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tributary.llm import bayes_minhash, exact, lattice, linealign, mixing, packing, pitman_yor, token_files, toxicity, trie, urltree, variants, warc
from tributary.llm.common import crc_remainder, table
from tributary.session import kept_table
from tributary.workload.query import Query

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# Target weights of the mix, in hundredths; all sources not named share the rest.
MIX_WEIGHTS = {"src0": 20, "src1": 15, "src2": 10, "src3": 10, "src4": 5, "src5": 5}
MIX_OTHER, MIX_BLOCK = 35, 16


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"), MIX_WEIGHTS, MIX_OTHER, MIX_BLOCK)
    return mixed.select("doc_id", "mix_source", "mix_block", "mix_slot", "mix_place")


OP1_SQL = f"""
WITH RECURSIVE weights(s, w) AS (VALUES {", ".join(f"('{s}', {w})" for s, w in sorted({**MIX_WEIGHTS, mixing.OTHER: MIX_OTHER}.items()))}),
named AS (
  SELECT doc_id, md5(coalesce(doc_id::VARCHAR, '')) AS m,
         CASE WHEN source IN ({", ".join(f"'{s}'" for s in MIX_WEIGHTS)}) THEN source ELSE '{mixing.OTHER}' END AS s
  FROM documents),
numbered AS (SELECT doc_id, s, row_number() OVER (PARTITION BY s ORDER BY m, doc_id NULLS FIRST) - 1 AS k FROM named),
lanes AS (
  SELECT list(s ORDER BY s) AS ss, list(w ORDER BY s) AS ws, list(n ORDER BY s) AS ns FROM (
    SELECT weights.s, any_value(w) AS w, ceil(count(k) / {MIX_BLOCK})::BIGINT AS n FROM weights LEFT JOIN numbered USING (s) GROUP BY weights.s)),
turns(t, t0, given, rest, pick, block) AS (
  SELECT -1::BIGINT, 0::BIGINT, list_transform(ns, lambda x: 0::BIGINT), ns, NULL::BIGINT, NULL::BIGINT FROM lanes
  UNION ALL
  SELECT t + 1, CASE WHEN rest[p] = 1 THEN t + 2 ELSE t0 END,
         CASE WHEN rest[p] = 1 THEN list_transform(given, lambda x: 0::BIGINT)
              ELSE list_transform(given, lambda x, i: x + (i = p)::BIGINT) END,
         list_transform(rest, lambda x, i: x - (i = p)::BIGINT), p, lanes.ns[p] - rest[p]
  FROM (
    SELECT *, list_position(due, list_min(due)) AS p FROM (
      SELECT *, list_transform(ws, lambda w, i: CASE
          WHEN rest[i] > 0 AND given[i] * total // w <= t + 1 - t0 THEN ceil((given[i] + 1) * total / w)::BIGINT END) AS due
      FROM (SELECT turns.*, ws, list_sum(list_transform(ws, lambda w, i: CASE WHEN rest[i] > 0 THEN w ELSE 0 END))::BIGINT AS total FROM turns, lanes)
    ) WHERE list_sum(rest) > 0
  ), lanes)
SELECT doc_id, s AS mix_source, k // {MIX_BLOCK} AS mix_block, t AS mix_slot, k % {MIX_BLOCK} AS mix_place
FROM numbered JOIN (SELECT t, ss[pick] AS s, block FROM turns, lanes WHERE t >= 0) USING (s) WHERE block = k // {MIX_BLOCK}
"""


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP3_SQL = f"""
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
hashed AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS d FROM bodies),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY n, d) AS first_page FROM hashed)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('{_BASE32}',
         1 + (('0x' || substr(d, 1 + (i // 4) * 5, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) % 32, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linealign.drop_aligned_blocks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_texts(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


_CLOSURE = """
reach(node, low) AS (
  SELECT {id}, {id} FROM {rows}
  UNION
  SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.node WHERE reach.low < links.b)
"""

OP7_SQL = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (SELECT * FROM vectors WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x, usable y
          WHERE x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.9),
{_CLOSURE.format(id="vec_id", rows="vectors")}
SELECT vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(low) AS component_id, vec_id = min(low) AS kept
FROM vectors JOIN reach ON vec_id = node LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON vec_id = a GROUP BY vec_id
"""


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_copies(table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP8_SQL = f"""
WITH hashed AS (SELECT doc_id, sha256({_LOWER}) AS h FROM documents),
grouped AS (SELECT *, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM hashed)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM grouped
"""


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_minhash.near_documents(table(spark, sf_dir, "documents"))


OP10_SQL = f"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(list_transform(range(greatest(least(len(w), 1), len(w) - 4)), lambda i: list_slice(w, i + 1, i + 5))) AS s FROM worded),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, p.n AS n, q.n AS k, count(*) AS c
           FROM shingles p JOIN shingles q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * c >= 75 * (n + k - c)),
{_CLOSURE.format(id="doc_id", rows="documents")}
SELECT doc_id, len(s)::BIGINT AS n_shingles, low AS component_id, doc_id = low AS kept
FROM sets JOIN (SELECT node, min(low) AS low FROM reach GROUP BY node) ON doc_id = node
"""


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.vocabulary(table(spark, sf_dir, "documents"), slip_every=199))


URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
URL_DEPTH = 6


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, URL_DEPTH)


def _url_sql() -> str:
    """The template tree level by level, all levels written out."""
    def sums(of: str) -> str:
        return ", ".join(f"sum({of}{c})::BIGINT AS {c}" for c in urltree.COUNTS)

    rest = ", ".join(f"sum({c}) OVER w - {c} AS r_{c}" for c in urltree.COUNTS)
    labels = """CASE WHEN (blocked + allowed) * (r_blocked + r_allowed) * (blocked + r_blocked) * (allowed + r_allowed) > 0
      THEN (blocked + allowed + r_blocked + r_allowed)::DOUBLE * (blocked * r_allowed - allowed * r_blocked) ** 2
           / ((blocked + allowed)::DOUBLE * (r_blocked + r_allowed) * (blocked + r_blocked) * (allowed + r_allowed)) ELSE 0 END"""
    terms = " + ".join(f"CASE WHEN s{i} + r_s{i} > 0 THEN (s{i} * r_n - r_s{i} * n)::DOUBLE ** 2 / (s{i} + r_s{i}) ELSE 0 END" for i in range(4))
    following = f"CASE WHEN r_n > 0 THEN ({terms}) / (n::DOUBLE * r_n) ELSE 0 END"
    lean = "greatest(" + ", ".join(f"s{i} * r_n - r_s{i} * n" for i in range(4)) + ")"
    most = "CASE " + " ".join(f"WHEN s{i} * r_n - r_s{i} * n = {lean} THEN '{i}'" for i in (3, 2, 1, 0)) + " END"

    def token(level: int) -> str:
        if level > URL_DEPTH:
            return "NULL::VARCHAR"
        return f"parts[{level + 1}]" if level < URL_DEPTH else f"CASE WHEN len(parts) > {level} THEN array_to_string(parts[{level + 1}:], '/') END"

    ends = r"'[.][A-Za-z]{1,5}$'"
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h}{p}', 'blocked': {v == 'block'}}}"
        for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    steps = [f"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
urls AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE {fits} END AS f FROM urls),
rows0 AS (SELECT page_id, host, path, f.rule AS rule, f.blocked AS b, '' AS prefix, string_split(path, '/') AS parts FROM ruled)"""]
    for i in range(1, URL_DEPTH + 1):
        steps.append(f"""
marked{i} AS (SELECT *, {token(i)} AS token, {token(i + 1)} AS following FROM rows{i - 1}),
tokens{i} AS (
  SELECT host, prefix, token, count(*) AS n, count(*) FILTER (b) AS blocked, count(*) FILTER (NOT b) AS allowed,
    count(*) FILTER (following IS NULL) AS s0, count(*) FILTER (regexp_matches(following, '^[0-9]')) AS s1,
    count(*) FILTER (regexp_matches(following, '^[A-Za-z]')) AS s2, count(*) FILTER (NOT regexp_matches(following, '^[0-9A-Za-z]')) AS s3,
    regexp_replace(token, {ends}, '') AS stem, regexp_extract(token, {ends}) AS tail
  FROM marked{i} WHERE token IS NOT NULL GROUP BY host, prefix, token),
shaped{i} AS (
  SELECT *, CASE WHEN stem = '' THEN '' WHEN regexp_full_match(stem, '[0-9]+') THEN '{{0}}'
    WHEN regexp_full_match(stem, '[0-9A-Fa-f-]{{8,}}') AND regexp_matches(stem, '[0-9]') THEN '{{x}}'
    WHEN regexp_full_match(stem, '[A-Za-z]+') THEN '{{a}}' ELSE '{{s}}' END || tail AS shape FROM tokens{i}),
general{i} AS MATERIALIZED (
  SELECT *, CASE WHEN d = 1 OR (d <= 32 AND m >= 4 * d) OR (n >= 8 AND n * d >= 4 * m) THEN token ELSE shape END AS branch
  FROM (SELECT *, count(*) OVER (PARTITION BY host, prefix, shape) AS d, sum(n) OVER (PARTITION BY host, prefix, shape) AS m FROM shaped{i})),
branches{i} AS (SELECT host, prefix, branch, {sums('')} FROM general{i} GROUP BY ALL),
judged{i} AS (SELECT *, {rest} FROM branches{i} WINDOW w AS (PARTITION BY host, prefix)),
sided{i} AS (SELECT host, prefix, branch, {", ".join(urltree.COUNTS)},
  CASE WHEN blocked + allowed = 0 THEN '?' WHEN {labels} <= {urltree.CHI_LABELS} THEN '' WHEN blocked * r_allowed > allowed * r_blocked THEN '+' ELSE '-' END
  || CASE WHEN {following} <= {urltree.CHI_NEXT} THEN '' ELSE {most} END AS side FROM judged{i}),
again{i} AS (SELECT *, {rest} FROM sided{i} WINDOW w AS (PARTITION BY host, prefix, side)),
names{i} AS (SELECT host, prefix, token, CASE WHEN r_n > 0 AND {labels} <= {urltree.CHI_LABELS} AND {following} <= {urltree.CHI_NEXT} THEN '*' || side ELSE branch END AS name
  FROM (SELECT host, prefix, token, branch FROM general{i}) JOIN again{i} USING (host, prefix, branch)),
rows{i} AS MATERIALIZED (SELECT page_id, host, path, rule, b, prefix || coalesce('/' || name, '') AS prefix, parts FROM marked{i} LEFT JOIN names{i} USING (host, prefix, token))""")
    return ",".join(steps) + f"""
SELECT page_id, host, path, rule, CASE WHEN coalesce(b, purity >= 0.7) THEN 'block' ELSE 'allow' END AS verdict, prefix AS template, purity
FROM (SELECT *, (count(*) FILTER (b) OVER t + 4.0::DOUBLE * base) / (count(b) OVER t + 4.0::DOUBLE) AS purity
      FROM rows{URL_DEPTH}, (SELECT coalesce(count(*) FILTER (b) / nullif(count(b), 0)::DOUBLE, 0) AS base FROM rows0)
      WINDOW t AS (PARTITION BY host, prefix))
"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = kept_table(trie.ordered_turns(table(spark, sf_dir, "conversations")), "turns")
    base = F.col("conv_id") - F.col("conv_id") % 5
    rebuilt, conversations = trie.shared_heads(turns, base, crc_remainder(F.col("conv_id"), 9), 8)
    return trie.prefix_trie(rebuilt, conversations)


# crc32 of a decimal: one step per byte, of eight shifts each.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
OP13_SQL = f"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, {_CRC32.format(text="conv_id::VARCHAR")} % 9 AS h FROM ordered),
parts AS (
  SELECT convs.conv_id, 0 AS part, pos, role, text FROM convs JOIN ordered o ON o.conv_id = convs.conv_id - convs.conv_id % 5 WHERE pos <= h
  UNION ALL
  SELECT convs.conv_id, 1, pos, role, text FROM convs JOIN ordered USING (conv_id) WHERE pos > h),
rebuilt AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM parts),
keyed AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS n, sha256(list(role || chr(1) || text) OVER w :: VARCHAR) AS k,
         count(*) OVER (PARTITION BY conv_id) AS len FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
  UNION ALL
  SELECT convs.conv_id, 0, 0, '', (SELECT count(*) FROM parts WHERE parts.conv_id = convs.conv_id) FROM convs),
nodes AS MATERIALIZED (
  SELECT min(conv_id) AS conv_id, depth, k, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = len), '')) AS ends_sha256
  FROM keyed GROUP BY depth, k),
above AS MATERIALIZED (
  SELECT nodes.k AS below, nodes.depth AS d, nodes.saved, upper.k, upper.depth, upper.conv_id
  FROM nodes JOIN keyed USING (conv_id) JOIN nodes upper ON upper.depth = keyed.depth AND upper.k = keyed.k WHERE upper.depth <= nodes.depth),
parents AS (SELECT below, d, conv_id AS parent_conv_id, k, depth FROM above WHERE depth = d - 1),
kids AS (SELECT k, depth, count(*) AS n_children FROM parents GROUP BY ALL)
SELECT nodes.conv_id, nodes.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, ends_sha256
FROM nodes LEFT JOIN parents ON below = nodes.k AND d = nodes.depth LEFT JOIN kids ON kids.k = nodes.k AND kids.depth = nodes.depth
JOIN (SELECT above.k, above.depth, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (kids.k IS NULL) AS n_leaves
      FROM above LEFT JOIN kids ON kids.k = below AND kids.depth = d GROUP BY ALL) t ON t.k = nodes.k AND t.depth = nodes.depth
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_pfair_mixing": Query(op1, OP1_SQL),
    "op2_toxicity_lexicon": Query(op2),
    "op3_warc_members": Query(op3, OP3_SQL),
    "op4_line_alignment": Query(op4),
    "op5_sum_of_squares": Query(op5),
    "op6_pitman_yor": Query(op6),
    "op7_e8_lattice": Query(op7, OP7_SQL),
    "op8_bloom_exact": Query(op8, OP8_SQL),
    "op9_token_frames": Query(op9),
    "op10_bayes_minhash": Query(op10, OP10_SQL),
    "op11_fm_variants": Query(op11),
    "op12_path_templates": Query(op12, _url_sql()),
    "op13_prefix_trie": Query(op13, OP13_SQL),
    "pipeline": Query(pipeline),
}
