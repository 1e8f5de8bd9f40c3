"""Fields that records bring without anyone having declared them: found in the data, added as text."""

from __future__ import annotations

import re
from collections import Counter
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def json_shape(df: DataFrame, value: str) -> T.StructType:
    """The union of the structures of all JSON objects in a text column; rows that hold no object do not count.

    One aggregate that merges the structures in every input task, so a key that a single record brings is
    found, and what reaches the driver is the structure alone. Keys whose values are of unlike kinds have the type VARIANT.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # the last value stays, as in other readers
    document = F.try_parse_json(value)
    merged = df.select(document.alias("d")).where(F.schema_of_variant("d").startswith("OBJECT"))
    shape = merged.agg(F.schema_of_variant_agg("d")).first()[0]
    if not shape.startswith("OBJECT"):
        return T.StructType()
    # The notation differs from a schema's in this one word; names in backquotes are left alone.
    return T.DataType.fromDDL(re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], shape))


def widened(declared: T.DataType | None, found: T.DataType) -> T.DataType:
    """``declared`` with the fields that only ``found`` has: objects as objects, all else (lists too) as text.

    Fields are added inside declared objects and inside the objects of declared lists as well. Where a value is not of the
    declared kind the declaration holds. Of keys that differ in case alone the declared one, else the first as text, is the column.
    """
    if declared is None:
        return widened(T.StructType(), found) if isinstance(found, T.StructType) and found.fields else T.StringType()
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(widened(declared.elementType, found.elementType))
    if not (isinstance(declared, T.StructType) and isinstance(found, T.StructType)):
        return declared
    brought = {f.name: f.dataType for f in found.fields}
    fields = [T.StructField(f.name, widened(f.dataType, brought[f.name]) if f.name in brought else f.dataType) for f in declared.fields]
    taken = {f.name.lower() for f in fields}
    forms = Counter(name.lower() for name in brought)
    for name, kind in brought.items():
        if name.lower() not in taken:
            taken.add(name.lower())
            fields.append(T.StructField(name, widened(None, kind) if forms[name.lower()] == 1 else T.StringType()))
    return T.StructType(fields)


Path = tuple[str, ...]


def key_spellings(df: DataFrame, value: str) -> dict[str, list[str]]:
    """The keys of all records that occur in more than one spelling of upper and lower case, by their lower-case form.

    Merging structures takes those that differ in case alone as the same, so spellings are gathered from the text: a string
    before a colon is a key. Distinct keys fold in every input task.
    """
    keys = F.regexp_extract_all(value, F.lit(r'"((?:[^"\\]|\\.)*+)"\s*:'), 1)
    found = df.select(F.explode(keys).alias("k")).distinct().groupBy(F.lower("k").alias("l")).agg(F.sort_array(F.collect_list("k")).alias("ks"))
    return {r.l: r.ks for r in found.where(F.size("ks") > 1).collect()}


def twins(schema: T.StructType, spellings: dict[str, list[str]], above: tuple[Path, ...] = ()) -> dict[Path, tuple[str, list[Path]]]:
    """By the path of a plain column of ``schema``: its type, and all paths that differ from it in case alone."""
    pairs: dict[Path, tuple[str, list[Path]]] = {}
    for f in schema.fields:
        steps = (*above, tuple(dict.fromkeys([f.name, *spellings.get(f.name.lower(), [])])))
        if isinstance(f.dataType, T.StructType):
            pairs |= twins(f.dataType, spellings, steps)
        elif not isinstance(f.dataType, T.ArrayType | T.MapType) and any(len(s) > 1 for s in steps):
            own, *others = product(*steps)
            pairs[own] = (f.dataType.simpleString(), others)
    return pairs


def variant_path(path: Path) -> str:
    """A path as VARIANT functions take it."""
    return "$" + "".join(f"[{q}{p}{q}]" for p in path for q in ("'" if '"' in p else '"',))


def parsed_json(df: DataFrame, value: str, declared: T.StructType) -> tuple[DataFrame, dict[Path, tuple[str, list[Path]]]]:
    """``df`` with the column ``_r``: the record by the declared fields and all undeclared ones, and with ``_corrupt_record`` in it."""
    found = json_shape(df, value)
    schema = widened(declared, found)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return df.withColumn("_r", F.from_json(value, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})), twins(schema, key_spellings(df, value))


def map_keys_found(df: DataFrame, maps: Column, declared: list[str]) -> list[str]:
    """All keys of a column of maps beyond the declared ones, as ``names_found`` lists them."""
    return names_found(df, F.map_keys(maps), declared)


def names_found(df: DataFrame, names: Column, declared: list[str]) -> list[str]:
    """All names of a column of lists beyond the declared ones, sorted; names that differ in case alone are one.

    Distinct names fold in every input task; what reaches the driver is the list of names.
    """
    keys = [r[0] for r in df.select(F.explode(names).alias("k")).distinct().collect()]
    taken = {d.lower() for d in declared}
    found = []
    for key in sorted(keys):
        if key.lower() not in taken:
            taken.add(key.lower())
            found.append(key)
    return found
