"""URL verdicts from a tree of path templates per host; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ascii_lower, discard
from tributary.operators.joins import own_exchange
from tributary.session import kept_table

# Critical values of chi square at one in a hundred: one degree of freedom for labels, three for what comes next.
CHI_LABELS, CHI_NEXT = 6.635, 11.345
COUNTS = ["n", "blocked", "allowed", "s0", "s1", "s2", "s3"]
NODE = ["host", "prefix"]


def parse_urls(pages: DataFrame) -> DataFrame:
    """Rows (page_id, host, path) of every page.

    The host lies between the first ``://`` and the next ``/``, ``?`` or ``#`` (A-Z lower-cased), the path from there to
    ``?`` or ``#``. Both are empty for a null url or one without ``://``. Repeated rows stay, other columns are ignored.
    """
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    return pages.select(
        "page_id", ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)).alias("host"), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path")
    )


def with_rule(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds ``rule`` (host and path of the longest rule that fits, else null) and ``blocked``: whether it blocks, null without one.

    A rule (verdict, host, path) fits its host and all hosts below it, where the path starts with the rule's.
    """
    fitting = []
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        fitting.append((fits, host + path, verdict == "block"))
    pick = lambda i: F.coalesce(*[F.when(f[0], F.lit(f[i])) for f in fitting])
    if not fitting:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "blocked": F.lit(None).cast("boolean")})
    return urls.withColumns({"rule": pick(1), "blocked": pick(2)})


def segment(path: Column, level: int, depth: int) -> Column:
    """The path's segment of that level (from 1), null beyond the last; at level ``depth`` all that is left."""
    if level < depth:
        return F.get(F.split(path, "/"), F.lit(level))
    parts = F.split(path, "/", depth + 1)
    return F.get(parts, F.lit(depth))


def shape(token: Column) -> Column:
    """What a segment looks like: digits, hex id, letters or anything else, with its file extension."""
    end = F.regexp_extract(token, "[.][A-Za-z]{1,5}$", 0)
    stem = F.expr("substring(token, 1, char_length(token) - char_length(regexp_extract(token, '[.][A-Za-z]{1,5}$', 0)))")
    kind = (
        F.when(stem == "", "").when(stem.rlike("^[0-9]+$"), "{0}").when(stem.rlike("^[0-9A-Fa-f-]{8,}$") & stem.rlike("[0-9]"), "{x}")
        .when(stem.rlike("^[A-Za-z]+$"), "{a}").otherwise("{s}")
    )
    return F.concat(kind, end)


def _next_kind(token: Column) -> Column:
    """0 to 3: no segment, one that starts with a digit, with a letter, with something else."""
    return F.when(token.isNull(), 0).when(token.rlike("^[0-9]"), 1).when(token.rlike("^[A-Za-z]"), 2).otherwise(3)


def _differs(own: str, rest: str) -> tuple[Column, Column]:
    """Chi square of labels and of what comes next between a branch's counts and the rest's, as doubles."""
    x = lambda side, c: F.col(f"{side}{c}").cast("double")
    b, a, rb, ra = x(own, "blocked"), x(own, "allowed"), x(rest, "blocked"), x(rest, "allowed")
    below = (b + a) * (rb + ra) * (b + rb) * (a + ra)
    labels = F.when(below > 0, (b + a + rb + ra) * (b * ra - a * rb) * (b * ra - a * rb) / below).otherwise(0.0)
    n, rn = x(own, "n"), x(rest, "n")
    terms = F.lit(0.0)
    for i in range(4):
        s, rs = x(own, f"s{i}"), x(rest, f"s{i}")
        terms = terms + F.when(s + rs > 0, (s * rn - rs * n) * (s * rn - rs * n) / (s + rs)).otherwise(0.0)
    return labels, F.when((n > 0) & (rn > 0), terms / (n * rn)).otherwise(0.0)


def _against_rest(branches: DataFrame, keys: list[str]) -> DataFrame:
    """Adds to every branch the counts of the other branches with the same ``keys`` (``r_`` columns)."""
    groups = [f"_{k}" for k in keys]
    pool = branches.groupBy(*[F.col(k).alias(g) for k, g in zip(keys, groups)]).agg(*[F.sum(c).alias(f"p_{c}") for c in COUNTS])
    joined = branches.join(pool, own_exchange(keys, groups))
    return joined.withColumns({f"r_{c}": F.col(f"p_{c}") - F.col(c) for c in COUNTS}).drop(*groups, *[f"p_{c}" for c in COUNTS])


def _level(rows: DataFrame, level: int, depth: int, most_values: int, mean_rows: int) -> DataFrame:
    """``rows`` one level further down: ``prefix`` grows by each row's branch of the template tree."""
    marked = rows.withColumn("token", segment(F.col("path"), level, depth))
    going = marked.where(F.col("token").isNotNull())
    kind = _next_kind(segment(F.col("path"), level + 1, depth) if level < depth else F.lit(None).cast("string"))
    count_if = lambda c: F.count(F.when(c, 1))
    tokens = going.groupBy(*NODE, "token").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("blocked")).alias("blocked"), count_if(~F.col("blocked")).alias("allowed"),
        *[count_if(kind == i).alias(f"s{i}") for i in range(4)],
    )
    tokens = kept_table(tokens.withColumn("shape", shape(F.col("token"))), "url-tokens")
    shapes = tokens.groupBy(*[F.col(c).alias(f"_{c}") for c in (*NODE, "shape")]).agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("m"))
    constant = (F.col("d") == 1) | ((F.col("d") <= most_values) & (F.col("m") >= mean_rows * F.col("d")))
    constant |= (F.col("n") >= 2 * mean_rows) & (F.col("n") * F.col("d") >= mean_rows * F.col("m"))
    general = tokens.join(shapes, own_exchange([*NODE, "shape"], ["_host", "_prefix", "_shape"]))
    general = kept_table(general.select(*NODE, "token", *COUNTS, F.when(constant, F.col("token")).otherwise(F.col("shape")).alias("branch")), "url-tokens")
    discard(tokens)

    branches = general.groupBy(*NODE, "branch").agg(*[F.sum(c).alias(c) for c in COUNTS])
    judged = _against_rest(branches, NODE)
    labels, following = _differs("", "r_")
    share = F.col("blocked") * F.col("r_allowed") - F.col("allowed") * F.col("r_blocked")
    labelled = F.col("blocked") + F.col("allowed") > 0
    side = F.concat(
        F.when(~labelled, "?").when(labels <= CHI_LABELS, "").when(share > 0, "+").otherwise("-"),
        F.when(following <= CHI_NEXT, "").otherwise(F.greatest(*[F.struct((F.col(f"s{i}") * F.col("r_n") - F.col(f"r_s{i}") * F.col("n")).alias("by"), F.lit(str(i)).alias("i")) for i in range(4)])["i"]),
    )
    sided = kept_table(judged.select(*NODE, "branch", *COUNTS, side.alias("side")), "url-branches")
    again = _against_rest(sided, [*NODE, "side"])
    labels, following = _differs("", "r_")
    # Alike within its side: it merges, if there is another one to merge with.
    alike = (F.col("r_n") > 0) & (labels <= CHI_LABELS) & (following <= CHI_NEXT)
    names = again.select(*[F.col(c).alias(f"_{c}") for c in (*NODE, "branch")], F.when(alike, F.concat(F.lit("*"), "side")).otherwise(F.col("branch")).alias("name"))
    named = general.join(names, own_exchange([*NODE, "branch"], ["_host", "_prefix", "_branch"]))
    named = named.select(F.col("host").alias("_host"), F.col("prefix").alias("_prefix"), F.col("token").alias("_token"), "name")
    moved = marked.join(named, own_exchange([*NODE, "token"], ["_host", "_prefix", "_token"]), "left")
    longer = F.when(F.col("name").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), "name"))
    after = kept_table(moved.select("page_id", "host", "path", "rule", "blocked", longer.alias("prefix")), "url-rows")
    for used in (rows, general, sided):
        discard(used)
    return after


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], depth: int = 6, most_values: int = 32, mean_rows: int = 4,
    strength: float = 4.0, reject_at: float = 0.7,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict (``allow`` or ``block``), template, purity.

    What a rule fits has the rule's verdict and is labelled by it. Per host the paths form a tree that is built level by level. In a
    node, segments of one shape stay literal if they are few and frequent (at most ``most_values`` different ones of ``mean_rows`` rows on
    average), or if one stands out by its own count; all others become a wildcard of their shape. Then branches are
    tested by chi square, in labels and in what comes next, against all other branches of the node: those alike merge, and of those that differ
    the ones that differ in the same direction and are alike among themselves. Branches without labels only merge with each other.
    No pairs of branches are formed: each meets the sum of the others. A template's purity is its share of blocked among labelled pages,
    drawn towards the share over all pages as by ``strength`` more pages; pages without a rule are blocked from ``reject_at`` on.

    Segments beyond level ``depth`` are one segment together, so the rounds are bounded and no path is cut. All steps are
    aggregates and joins on (host, node, token), which adaptive execution splits where a host is hot. Pages without host form a host of their own.
    An empty table gives an empty result.
    """
    urls = with_rule(parse_urls(pages), rules)
    rows = kept_table(urls.withColumn("prefix", F.lit("")), "url-rows")
    deepest = rows.agg(F.max(F.least(F.size(F.split("path", "/")) - 1, F.lit(depth)))).first()[0] or 0
    for level in range(1, deepest + 1):
        rows = _level(rows, level, depth, most_values, mean_rows)
    blocked, known = F.count(F.when(F.col("blocked"), 1)), F.count("blocked")
    base = rows.agg(F.when(known > 0, blocked / known).otherwise(0.0).alias("base")).scalar()
    templates = rows.groupBy(F.col("host").alias("_host"), F.col("prefix").alias("_prefix")).agg(blocked.alias("b"), known.alias("k"))
    purity = (F.col("b") + strength * base) / (F.col("k") + strength)
    scored = rows.join(templates, own_exchange(NODE, ["_host", "_prefix"])).withColumn("purity", purity)
    judged = F.coalesce("blocked", F.col("purity") >= reject_at)
    return scored.select(
        "page_id", "host", "path", "rule", F.when(judged, "block").otherwise("allow").alias("verdict"), F.col("prefix").alias("template"), "purity"
    )
