"""Landed SOAP responses to rows. Namespace prefixes are dropped first, as services vary them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import Colish, as_col
from tributary.operators.keyed import keep_one
from tributary.session import kept_table
from tributary.sources.discovery import map_keys_found, names_found


def plain_tags(c: Colish) -> Column:
    """XML text without namespace prefixes on its tags."""
    return F.regexp_replace(as_col(c), r"(</?)[\w.-]++:", "$1")


def _body(c: Colish) -> Column:
    """Inside of the SOAP body, null when there is none."""
    found = F.regexp_extract(plain_tags(c), r"(?s)<Body(?:\s[^>]*)?>(.*)</Body>", 1)
    return F.nullif(F.regexp_replace(found, r"(?s)<!--.*?-->", ""), F.lit(""))


def _ddl(fields: Sequence[str]) -> str:
    return ", ".join(f"`{f}` string" for f in fields)


def _lowered(record: str, fields: Sequence[str]) -> list[Column]:
    return [F.trim(F.col(f"{record}.`{f}`")).alias(f.lower()) for f in fields]


def _elements(xml: Colish, tag: str) -> Column:
    """Each whole element of that name, at any depth of the body, in document order.

    Without elements of the name inside each other one pattern finds them. Else the body is cut at the tags of that name,
    and a fold over the pieces matches each closing tag with the last open one.
    """
    attributes = r"(?:\s(?:[^>/]|/(?!>))*+)?"  # may hold a slash, but not that of a self-closed element
    pattern = rf"(?s)<{tag}{attributes}(?:/>|>.*?</{tag}>)"
    flat = F.regexp_extract_all(_body(xml), F.lit(pattern), 0)
    pieces = F.regexp_extract_all(_body(xml), F.lit(rf"<{tag}{attributes}/?>|</{tag}>|[^<]++|<"), 0)
    span = "array<struct<first: int, last: int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("open"), F.array().cast(span).alias("done"))

    def step(state: Column, piece: Column) -> Column:
        at, opened, done = state["at"] + 1, state["open"], state["done"]
        alone, opens = piece.rlike(rf"(?s)^<{tag}.*/>$"), piece.rlike(rf"^<{tag}[\s>]")
        closes = (piece == f"</{tag}>") & (F.size(opened) > 0)
        found = lambda first: F.array_append(done, F.struct(first.alias("first"), at.alias("last")))
        return F.struct(
            at.alias("at"),
            F.when(closes, F.slice(opened, 1, F.size(opened) - 1)).when(opens & ~alone, F.array_append(opened, at)).otherwise(opened).alias("open"),
            F.when(closes, found(F.element_at(opened, -1))).when(alone, found(at)).otherwise(done).alias("done"),
        )

    spans = F.array_sort(F.aggregate(pieces, start, step)["done"])
    nested = F.transform(spans, lambda s: F.array_join(F.slice(pieces, s["first"], s["last"] - s["first"] + 1), ""))
    # Bound to a name of its own, the result of the pattern is computed once for the question and the answer.
    inner = lambda elements: F.exists(elements, lambda e: F.locate(f"<{tag}", e, 2) > 0)
    return F.transform(F.array(flat), lambda elements: F.when(inner(elements), nested).otherwise(elements))[0]


def records(df: DataFrame, xml: str, tag: str, fields: Sequence[str], keep: Sequence[str] = (), undeclared: bool = False) -> DataFrame:
    """One row per repeated element, with ``pos`` as its place in the response.

    A response without a body gives no rows. Child elements not among ``fields`` are left out, or with ``undeclared`` become
    text columns after them, by name: all children that any element has, found by a pass over the responses.
    Of a repeated undeclared child the last stays, and one that has children itself gives the text before them. With ``undeclared``
    the elements are cut out once and kept for both passes.
    """
    exploded = df.select(*keep, F.posexplode(_elements(xml, tag)).alias("pos", "_xml"))
    if undeclared:
        wrapped = F.concat(F.lit("<r>"), "_xml", F.lit("</r>"))
        # Neither prefix can begin a tag, so attributes and loose text are told apart from children.
        options = {"attributePrefix": "@", "valueTag": "#"}
        children = F.map_filter(F.from_xml(wrapped, f"`{tag}` map<string, string>", options)[tag], lambda k, _: ~k.rlike("^[@#]"))
        # Parsing is dear, so only elements that hold another tag than the declared ones are parsed for it.
        tags = F.regexp_extract_all("_xml", F.lit(r"<([^\s/>!?][^\s/>]*)"), 1)
        beyond = F.exists(F.slice(tags, 2, F.greatest(F.size(tags), F.lit(1))), lambda name: ~name.isin(*fields) if fields else F.lit(True))
        exploded = kept_table(exploded.withColumn("_all", F.when(beyond, children)), "soap-elements")
    parsed = exploded.withColumn("_r", F.from_xml("_xml", _ddl(fields)))
    found = map_keys_found(exploded, F.col("_all"), fields) if undeclared else []
    return parsed.select(*keep, "pos", *_lowered("_r", fields), *[_own_text(F.col("_all")[f]).alias(f.lower()) for f in found])


def _own_text(c: Column) -> Column:
    """Text of an element before its first child; a lone ``<`` is text."""
    child = r"(?s)^([^<]*)<([\w.-]+)(?:\s[^>]*)?(?:/>|>.*</\2>).*$"
    return F.trim(F.regexp_replace(c, child, "$1"))


def flat_record(df: DataFrame, xml: str, fields: Sequence[str], keep: Sequence[str] = (), undeclared: bool = False) -> DataFrame:
    """One row per response from all its leaf tags; of a repeated tag the last non-blank text stays.

    With ``undeclared`` the leaves that are not among ``fields`` become text columns after them, by name. They are the union
    over all responses, found by a pass over them.
    """
    leaf = r"(?s)<([\w.-]+)(?:\s[^>]*)?>[^<]*+(?:<!\[CDATA\[.*?\]\]>[^<]*+)*+</\1>"
    # As a list of one or none, the body is computed once for the question whether there is one and the answer.
    body = df.select(*keep, F.explode(F.array_compact(F.array(_body(xml)))).alias("_b"))

    def parts(element: Column) -> Column:
        tag, begins = F.regexp_extract(element, r"^<([\w.-]+)", 1), F.locate(">", element)
        text = F.substr(element, begins + 1, F.length(element) - begins - F.length(tag) - 3)
        return F.struct(tag.alias("tag"), text.alias("text"))

    leaves = body.select(*keep, F.transform(F.regexp_extract_all("_b", F.lit(leaf), 0), parts).alias("_leaves"))
    filled = F.transform(F.filter("_leaves", lambda x: F.trim(x["text"]) != ""), lambda x: x["tag"])
    if undeclared:
        leaves = kept_table(leaves, "soap-leaves")  # read for the names and for the rows
    found = names_found(leaves, filled, fields) if undeclared else []

    def last(field: str) -> Column:
        hits = F.filter("_leaves", lambda x: (x["tag"] == field) & (F.trim(x["text"]) != ""))
        return _unescaped(F.trim(F.get(hits, F.size(hits) - 1)["text"])).alias(field.lower())

    return leaves.select(*keep, *[last(f) for f in [*fields, *found]])


def _unescaped(c: Column) -> Column:
    """Text of a leaf: numeric entities and CDATA are left to the XML reader, the rest are replacements."""
    parsed = F.from_xml(F.concat(F.lit("<a><v>"), c, F.lit("</v></a>")), "v string")["v"]
    odd = c.contains("&#") | c.contains("<![CDATA[")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.when(odd, F.trim(parsed)).otherwise(c)


def two_kinds(
    df: DataFrame, xml: str, kinds: dict[str, Sequence[str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Records of several element names as one row set with the union of their columns."""
    first, *others = [records(df, xml, tag, fields, keep).drop("pos") for tag, fields in kinds.items()]
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def with_nested(
    df: DataFrame,
    xml: str,
    tag: str,
    fields: Sequence[str],
    wrapper: str,
    item: str,
    item_fields: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parent element times its nested items; a parent without items stays as one row."""
    ddl = f"{_ddl(fields)}, `{wrapper}` struct<`{item}`: array<struct<{_ddl(item_fields).replace(' string', ': string')}>>>"
    exploded = df.select(*keep, F.explode(_elements(xml, tag)).alias("_xml"))
    parsed = exploded.withColumn("_r", F.from_xml("_xml", ddl))
    nested = parsed.select(
        *keep, *_lowered("_r", fields), F.explode_outer(F.col(f"_r.`{wrapper}`.`{item}`")).alias("_i")
    )
    return nested.select(*keep, *[f.lower() for f in fields], *_lowered("_i", item_fields))


def best_record(df: DataFrame, key: str, excluded: Column, entered: Column, pos: str = "pos") -> DataFrame:
    """The record to keep per person: one without exclusion first, then the latest entry, then the
    first in the response."""
    return keep_one(
        df, [key], F.nullif(excluded, F.lit("")).isNotNull(), entered.desc_nulls_last(), F.col(pos)
    )
