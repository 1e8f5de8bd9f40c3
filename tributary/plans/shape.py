"""Typed tables from raw text, given as a list of column rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import dates, money, text

Rule = Callable[[Column], Column]


def same(c: Column) -> Column:
    return c


def as_text(c: Column) -> Column:
    return c.cast("string")


def as_int(c: Column) -> Column:
    return c.try_cast("int")


def as_date(c: Column) -> Column:
    return c.try_cast("date")


def after_blank(rule: Rule) -> Rule:
    """Apply ``rule`` to trimmed text whose blanks are null."""
    return lambda c: rule(text.blank_to_null(c))


clean = text.blank_to_null
clean_digits = after_blank(text.digits)
clean_upper = after_blank(F.upper)
clean_lower = after_blank(F.lower)
clean_int = after_blank(as_int)
clean_date = after_blank(lambda c: dates.parsed(c, dates.DAY_FIRST_COMPACT))
clean_month = after_blank(dates.month_start)
clean_date8 = after_blank(dates.guarded_compact)
clean_year_first8 = after_blank(lambda c: dates.guarded_compact(c, dates.YEAR_FIRST_COMPACT))
money_br = money.plain_money
accounting = money.parse_money


def shaped(raw: DataFrame, rules: Sequence[tuple[str, str, Rule]]) -> DataFrame:
    """One output column per (name, raw column, rule). A raw column the table never received is null."""
    present = set(raw.columns)
    return raw.select(*[
        rule(F.col(source) if source in present else F.lit(None).cast("string")).alias(name)
        for name, source, rule in rules
    ])


def kept(names: str) -> list[tuple[str, str, Rule]]:
    """Rules for columns taken over unchanged."""
    return [(n, n, same) for n in names.split()]


def ruled(rule: Rule, pairs: str) -> list[tuple[str, str, Rule]]:
    """Rules from ``new=raw`` pairs (or plain names) that share one rule."""
    out = []
    for pair in pairs.split():
        name, _, source = pair.partition("=")
        out.append((name, source or name, rule))
    return out
