"""Text cleaning, mining and labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

Colish = Column | str


def as_col(c: Colish) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Colish) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def sentinel_to_null(c: Colish, *sentinels: str) -> Column:
    """Trimmed text, null when it is blank or one of ``sentinels``."""
    cleaned = blank_to_null(c)
    return F.when(~cleaned.isin(*sentinels), cleaned)


def digits(c: Colish) -> Column:
    return F.regexp_replace(as_col(c), "[^0-9]", "")


def alphanumerics(c: Colish) -> Column:
    return F.regexp_replace(as_col(c), "[^0-9A-Za-z]", "")


def drop_chars(c: Colish, chars: str) -> Column:
    """Remove every occurrence of each character of ``chars``."""
    return F.translate(as_col(c), chars, "")


def strip_first(c: Colish, chars: str) -> Column:
    """Remove only the first occurrence of any character of ``chars``."""
    members = re.escape(chars)
    return F.regexp_replace(as_col(c), f"^([^{members}]*)[{members}]", "$1")


def uri_tail(c: Colish) -> Column:
    """What follows the last slash; the whole text when there is none."""
    return F.regexp_replace(as_col(c), "^.*/", "")


def capture(c: Colish, pattern: str, group: int = 1) -> Column:
    """A regex group of the first match, null (not '') when nothing matches."""
    column = as_col(c)
    return F.when(column.rlike(pattern), F.regexp_extract(column, pattern, group))


def join_text(*parts: Colish) -> Column:
    """Concatenation that skips nulls; '' when all parts are null."""
    return F.concat_ws("", *[as_col(p) for p in parts])


def piece(c: Colish, start: Column | int, length: int) -> Column:
    """Substring whose window may begin before the text: the part in front of position 1 is cut off.

    Spark reads a start of zero or less from the other end of the text, which short codes would hit.
    """
    column = as_col(c)
    first = start if isinstance(start, Column) else F.lit(start)
    last = first + F.lit(length - 1)
    begin = F.greatest(first, F.lit(1))
    return F.when(
        column.isNotNull(),
        F.substring(column, begin, F.greatest(last - begin + 1, F.lit(0))),
    )


def canonical_document(c: Colish) -> Column:
    """First seven characters, then the last four as a number of five digits.

    Null input gives ''. A tail that is not a number gives null.
    """
    column = as_col(c)
    tail = F.right(column, F.lit(4))
    return F.when(column.isNull(), F.lit("")).when(
        tail.rlike("^[0-9]+$"),
        F.concat(F.left(column, F.lit(7)), F.lpad(tail, 5, "0")),
    )


def python_list(c: Colish, element_ddl: str) -> Column:
    """Array of structs from a list that was landed as its Python text form.

    Spark's JSON reader takes single quotes, so only the bare words None, True and False are
    rewritten, and only where they stand as a value. Text that holds an apostrophe survives.
    """
    text = as_col(c)
    # Python writes odd bytes as \\xHH, which JSON lacks; an escaped backslash before an x stays one.
    escaped = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    text = F.when(text.contains("\\x"), escaped).otherwise(text)
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        # The word leads the pattern, so that only places where it stands are tried.
        text = F.regexp_replace(text, rf"{word}(?<=[:,\[]\s?{word})(?=\s?[,\]}}])", json_word)
    return F.from_json(text, f"array<struct<{element_ddl}>>", {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})


def unparsed_list(c: Colish, element_ddl: str) -> Column:
    """Whether text that should hold a list holds something that does not parse; null and blank text hold no list."""
    column = as_col(c)
    return column.isNotNull() & (F.trim(column) != "") & python_list(column, element_ddl).isNull()
