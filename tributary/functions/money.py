"""Brazilian money text to exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.text import Colish, as_col

MONEY = "decimal(15,2)"


def plain_money(c: Colish) -> Column:
    """``1.234,56`` to 1234.56; null stays null, and text that is no number gives null."""
    return F.translate(as_col(c), ",.", ".").try_cast(MONEY)


def comma_decimal(c: Colish, to: str = MONEY) -> Column:
    """``1234,56`` to 1234.56: only the decimal comma is handled."""
    return F.replace(as_col(c), F.lit(","), F.lit(".")).try_cast(to)


def parse_money(c: Colish) -> Column:
    """Accounting text: null, blank and NaN are zero, and ``(1.234,56)`` is negative."""
    column = as_col(c)
    zero = F.lit(0).cast(MONEY)
    in_brackets = F.regexp_replace(
        F.translate(column, ".", ""), r"\(?(\d+),(\d+)\)?", "-$1.$2"
    ).try_cast(MONEY)
    return (
        F.when(column.isNull() | (F.trim(column) == "") | column.contains("NaN"), zero)
        .when(column.startswith("("), in_brackets)
        .otherwise(plain_money(column))
    )
