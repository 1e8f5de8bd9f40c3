"""Nested records to flat all-text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.refusals import REASON, Sifted, sift
from tributary.sources.discovery import CORRUPT, parsed_json, variant_path

SEPARATOR = "__"


def quoted(name: str) -> Column:
    """A column by its plain name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def flatten(df: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """Struct fields become ``a__b`` columns in lower case; scalars become text; arrays stay native."""
    columns: list[Column] = []

    def visit(column: Column, name: str, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                visit(column[field.name], f"{name}{sep}{field.name}", field.dataType)
        elif isinstance(kind, T.ArrayType):
            columns.append(column.alias(name.lower()))
        else:
            columns.append(column.cast("string").alias(name.lower()))

    for field in df.schema.fields:
        visit(quoted(field.name), field.name, field.dataType)
    return df.select(*columns)


def stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the landing time ``dt_ingest``."""
    return df.withColumn("dt_ingest", (at if at is not None else F.current_timestamp()).cast("timestamp"))


def land_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed JSON files, with a declared schema, as a flat stamped table.

    One pass; keys that the schema does not declare are left out. ``land_json_records`` finds them.
    """
    return stamp(flatten(spark.read.schema(schema).json(path)))


def land_json_records(spark: SparkSession, path: str, schema: T.StructType | str = "") -> Sifted:
    """Landed JSON files, a record per line, as a flat stamped table with every key that any record brings.

    Declared fields come first, with their types; all others follow as text, by name, nested ones as ``a__b``
    and lists as JSON text. So a key that one record in a thousand brings gets its column. A first pass over the files finds the
    keys, the second parses each record once. Lines that hold no object are refused as they are; blank lines are nothing.
    Keys that differ in case alone share a column; the first one with a value fills it.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) and schema else schema or T.StructType()
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed, same = parsed_json(lines, "value", declared)
    # A value that is not of its declared kind marks a record as corrupt too; such a record lands with a null there.
    unread = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    broken = ~F.ltrim("value").startswith("{") | (unread & F.try_parse_json("value").isNull())
    kept_text = F.col("value") if same else F.when(broken, F.col("value"))
    sifted = sift(parsed.select("_r", broken.alias("_broken"), kept_text.alias("value")), {"not a JSON object": F.col("_broken")})
    fields = [f.name for f in parsed.schema["_r"].dataType.fields if f.name != CORRUPT]
    document = F.try_parse_json("value")
    others = [
        (own, F.coalesce(*[F.try_variant_get(document, variant_path(o), kind) for o in more]).cast("string")) for own, (kind, more) in same.items()
    ]
    flat = flatten(sifted.accepted.select(*[F.col("_r")[f].alias(f) for f in fields], *[c.alias(f"_twin_{i}") for i, (_, c) in enumerate(others)]))
    for i, (own, _) in enumerate(others):
        name = SEPARATOR.join(own).lower()
        flat = flat.withColumn(name, F.coalesce(quoted(name), F.col(f"_twin_{i}"))).drop(f"_twin_{i}")
    return Sifted(stamp(flat), sifted.refused.select("value", REASON), sifted.counts)


def children(df: DataFrame, array: str, parent_fields: list[str]) -> DataFrame:
    """One row per element of a nested array, parent fields first, then the fields of the element.

    Parents without elements are left out. A child field replaces a parent field of the same name.
    """
    exploded = df.select(*parent_fields, F.explode(array).alias("_child"))
    child_fields = exploded.schema["_child"].dataType.fieldNames()
    kept = [p for p in parent_fields if p not in child_fields]
    return exploded.select(*kept, "_child.*")


def posts_by_type(types: DataFrame) -> DataFrame:
    """Post types with their nested posts as one row per post."""
    fields = [c for c in types.columns if c != "cargosFuncoes"]
    return flatten(children(types, "cargosFuncoes.cargoFuncao", fields))


def with_tree_depth(posts: DataFrame, units: DataFrame) -> DataFrame:
    """Landed unit posts with the depth of their unit in the modelled tree; unknown units are left out."""
    depth = units.select(F.col("codigounidade").alias("_code"), "ordem_grandeza")
    return posts.join(depth, F.col("codigounidade") == F.col("_code")).drop("_code")


def recent_commitments(df: DataFrame) -> DataFrame:
    """Treasury rows of the years 20xx, stamped."""
    return stamp(df.where(F.col("ne_ccor_ano_emissao").startswith("20")))


def compact_date_to_iso(df: DataFrame, source: str, target: str) -> DataFrame:
    """Eight digits DDMMYYYY to ISO text, anything else to null, under a new name."""
    text = F.col(source)
    iso = F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "ddMMyyyy")).cast("string")
    return df.withColumn(target, iso).drop(source)


def pension_ids(df: DataFrame) -> DataFrame:
    """Synthetic record id: person, position in the response, pensioner, registration; absent parts empty."""
    parts = [F.col("cpf"), F.col("pos"), F.col("cpfpensionista"), F.col("matriculapensionista")]
    filled = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return df.withColumn("id_registro", F.concat_ws("_", *filled)).drop("pos")
