"""Report extracts: text files with a preamble, or with one block per year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One CSV record: quoted parts may hold line breaks. The possessive form never backtracks.
_RECORD = r'((?:[^"\n]++|"[^"]*+"?)++)(?:\n|$)'
_FIELD = r'(?:^|,)(?:"(?:[^"]|"")*+"|[^,]*+)'


def _texts(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """One row per file. The unit of parallel work is the file; attachments are small and many."""
    files = spark.read.format("binaryFile").load(path)
    text = F.decode("content", encoding)
    return files.select("path", F.regexp_replace(F.ltrim(text, F.lit("\ufeff")), "\r\n?", "\n").alias("text"))


def read_headerless(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    skip: int,
    encoding: str = "UTF-8",
    width: int | None = None,
) -> DataFrame:
    """Comma-separated files without a header: the first ``skip`` lines are dropped, columns go by
    position, and columns beyond ``names`` are called ``col_i``. All values are text.

    A file with fewer lines than ``skip`` fails the job with its path: the extract is incomplete.
    With no ``width`` given, one pass finds the widest record, so that no column is lost.
    """
    preamble = rf"^(?:[^\n]*+\n){{{skip}}}" if skip else "^"
    short = F.concat(F.lit("fewer lines than the preamble has: "), "path")
    body = F.when(~F.col("text").rlike(preamble), F.raise_error(short).cast("string")).otherwise(F.regexp_replace("text", preamble, ""))
    records = _texts(spark, path, encoding).select(
        "path", F.posexplode(F.regexp_extract_all(body, F.lit(_RECORD), 1)).alias("_line", "_record")
    ).where(F.trim("_record") != "")
    if width is None:
        widest = records.agg(F.max(F.size(F.regexp_extract_all("_record", F.lit(_FIELD), 0)))).first()[0]
        width = max(widest or 0, len(names))
    columns = [names[i] if i < len(names) else f"col_{i}" for i in range(width)]
    ddl = ", ".join(f"`{c}` string" for c in columns)
    parsed = records.select(F.from_csv("_record", F.lit(ddl), {"quote": '"', "escape": '"', "multiLine": "true"}).alias("_r"))
    return parsed.select("_r.*")


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _unquoted(c: Column) -> Column:
    return _stripped(F.regexp_replace(c, '^"+|"+$', ""))


# What the yearly report looks like.
YEAR_HEADER = r"Ano Lançamento:\s*(\d{4})"
HEADER_MARKS = ["Páginas:", "Unidade Orçamentária", '"UG Executora"', '"PROJETO INICIAL DA LOA"']
LINES_AFTER_HEADER = 6
LINES_BEFORE_NEXT = 2
MIN_COLUMNS = 20
REQUIRED_COLUMNS = (0, 13)
EMPTY_WORDS = ["nan", "NaN", "None", "null"]


def read_year_blocks(
    spark: SparkSession, path: str, names: Sequence[str], encoding: str = "UTF-16"
) -> DataFrame:
    """Tab-separated report whose blocks are headed by a year line.

    A block's data starts six lines below its header and ends two lines above the next header.
    Headings, short lines and lines that lack the first or fourteenth column are dropped. All
    values are text, '' where the report has none, and ``ano_exercicio`` is the year of the block.

    Blocks are cut inside each file's row, so the files need no shuffle.
    """
    files = _texts(spark, path, encoding).select(F.split(_stripped(F.col("text")), "\n").alias("lines"))
    heads = F.filter(
        F.transform("lines", lambda line, i: F.struct(
            i.alias("at"), F.regexp_extract(line, YEAR_HEADER, 1).alias("year"))),
        lambda h: h["year"] != "",
    )
    located = files.withColumn("heads", heads)
    blocks = located.select(
        "lines", "heads", F.posexplode("heads").alias("n", "head")
    ).select(
        F.col("head.year").alias("ano_exercicio"),
        "lines",
        (F.col("head.at") + LINES_AFTER_HEADER).alias("first"),
        F.coalesce(
            F.get("heads", F.col("n") + 1)["at"] - LINES_BEFORE_NEXT, F.size("lines")
        ).alias("until"),
    )
    block_lines = F.slice("lines", F.col("first") + 1, F.greatest(F.col("until") - F.col("first"), F.lit(0)))
    lines = blocks.select("ano_exercicio", F.explode(block_lines).alias("line")).select(
        "ano_exercicio", _stripped(F.col("line")).alias("line")
    )
    fields = lines.where(~F.col("line").rlike("|".join(HEADER_MARKS))).select(
        "ano_exercicio", F.transform(F.split("line", "\t"), _unquoted).alias("f")
    )
    full = fields.where(F.size("f") >= MIN_COLUMNS)
    for i in REQUIRED_COLUMNS:
        full = full.where(F.col("f")[i] != "")

    def value(i: int) -> Column:
        cell = F.coalesce(F.get("f", F.lit(i)), F.lit(""))
        return F.when(cell.isin(*EMPTY_WORDS), F.lit("")).otherwise(cell)

    return full.select(*[value(i).alias(n) for i, n in enumerate(names)], "ano_exercicio")


def combine(*extracts: DataFrame) -> DataFrame:
    """Sent and received extracts as one, matched by column name."""
    first, *others = extracts
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
