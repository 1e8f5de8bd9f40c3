"""Column functions against hand-computed values."""

from datetime import date
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from tributary.functions import dates, money, sql, text

D = Decimal


def apply(spark, function, *values, kinds=None):
    kinds = kinds or ["string"] * len(values)
    ddl = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    frame = spark.createDataFrame([tuple(values)], ddl)
    value = frame.select(function(*frame.columns).alias("v")).first()[0]
    return tuple(value) if hasattr(value, "asDict") else value


@pytest.mark.parametrize("given, expected", [
    ("1.234,56", D("1234.56")), ("(1.234,56)", D("-1234.56")), ("", D("0.00")), ("  ", D("0.00")),
    (None, D("0.00")), ("NaN", D("0.00")), ("-7,5", D("-7.50")), ("1234.56", D("123456.00")),
    ("abc", None), ("(12)", None),
])
def test_parse_money(spark, given, expected):
    assert apply(spark, money.parse_money, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("1.234,56", D("1234.56")), (None, None), ("", None), ("0,005", D("0.01")),
])
def test_plain_money(spark, given, expected):
    assert apply(spark, money.plain_money, given) == expected


def test_comma_decimal(spark):
    assert apply(spark, money.comma_decimal, "1234,5") == D("1234.50")
    assert apply(spark, money.comma_decimal, "1.234,5") is None


@pytest.mark.parametrize("given, expected", [
    ("FEV/2024", date(2024, 2, 1)), ("DEZ/2023", date(2023, 12, 1)), ("000/2024", date(2023, 12, 1)),
    ("13/2024", date(2025, 1, 1)), ("fev/2024", None), ("XXX/2024", None), ("FEV", None), (None, None),
])
def test_month_label(spark, given, expected):
    assert apply(spark, dates.parse_month_label, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("mar2024", date(2024, 3, 1)), ("DEZ2020", date(2020, 12, 1)), ("XXX2020", None), ("MAR", None), (None, None),
])
def test_compact_month_label(spark, given, expected):
    assert apply(spark, dates.parse_compact_month_label, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("2024-02-29", date(2024, 2, 29)), ("2023-02-29", None), ("2024-2-9", None), ("29/02/2024", None), (None, None),
])
def test_guarded_iso(spark, given, expected):
    assert apply(spark, dates.guarded_iso, given) == expected


def test_guarded_compact(spark):
    assert apply(spark, dates.guarded_compact, "31122020") == date(2020, 12, 31)
    assert apply(spark, dates.guarded_compact, "0") is None
    assert apply(spark, dates.guarded_compact, "99999999") is None
    assert apply(spark, lambda c: dates.guarded_compact(c, dates.YEAR_FIRST_COMPACT), "20200131") == date(2020, 1, 31)
    assert apply(spark, dates.month_start, "202313") is None


@pytest.mark.parametrize("later, earlier, expected", [
    (date(2004, 6, 1), date(2004, 4, 30), (0, 1, 1)),      # borrows April's 30 days
    (date(2024, 3, 1), date(2024, 1, 31), (0, 1, 1)),      # borrows January's 31 days
    (date(2020, 2, 29), date(2019, 3, 1), (0, 11, 28)),
    (date(2019, 5, 10), date(1985, 5, 10), (34, 0, 0)),
    (date(2004, 4, 30), date(2004, 6, 1), (0, -1, -1)),
    (None, date(2004, 6, 1), None),
])
def test_calendar_age(spark, later, earlier, expected):
    assert apply(spark, dates.calendar_age, later, earlier, kinds=["date", "date"]) == expected


def test_cleaning(spark):
    assert apply(spark, text.blank_to_null, "  ") is None
    assert apply(spark, text.blank_to_null, " a ") == "a"
    for word in ("NaN", " [null] ", "", None):
        assert apply(spark, lambda c: text.sentinel_to_null(c, "NaN", "[null]"), word) is None
    assert apply(spark, lambda c: text.sentinel_to_null(c, "NaN"), " NaNa ") == "NaNa"
    assert apply(spark, text.digits, "70.076-900") == "70076900"
    assert apply(spark, text.alphanumerics, "12-3.x/Y") == "123xY"
    assert apply(spark, text.uri_tail, "http://un/7") == "7"
    assert apply(spark, text.uri_tail, "7") == "7"


def test_strip_first_is_first_only(spark):
    assert apply(spark, lambda c: text.strip_first(c, "./-"), "23000.123/2020-10") == "23000123/2020-10"
    assert apply(spark, lambda c: text.strip_first(c, "./-"), "abc") == "abc"
    assert apply(spark, lambda c: text.drop_chars(c, "./-"), "23000.123/2020-10") == "23000123202010"


def test_capture_gives_null_without_match(spark):
    assert apply(spark, lambda c: text.capture(c, "^([0-9]+) -"), "123 - x") == "123"
    assert apply(spark, lambda c: text.capture(c, "^([0-9]+) -"), "x 123 - x") is None
    assert apply(spark, lambda c: text.capture(c, r"(?U)(\w+) "), "DEVOLUÇÃO de") == "DEVOLUÇÃO"


@pytest.mark.parametrize("given, expected", [
    ("2024NC000123", "2024NC000123"[:7] + "00123"), ("2024NC1234567", "2024NC104567"),
    (None, ""), ("2024NC12", None),
])
def test_canonical_document(spark, given, expected):
    assert apply(spark, text.canonical_document, given) == expected


def test_piece_before_the_text(spark):
    from pyspark.sql import functions as F
    assert apply(spark, lambda c: text.piece(c, F.length(c) - 2, 3), "F1") == "F1"
    assert apply(spark, lambda c: text.piece(c, F.length(c) - 2, 1), "F1") == ""
    assert apply(spark, lambda c: text.piece(c, F.length(c) - 2, 3), "FCE0113") == "113"


def test_python_list(spark):
    ddl = "nome: string, codigo: string"
    parse = lambda c: text.python_list(c, ddl)
    value = apply(spark, parse, """[{'nome': "D'Avila", 'codigo': None}, {'nome': 'None Silva', 'codigo': '1'}]""")
    assert [tuple(v) for v in value] == [("D'Avila", None), ("None Silva", "1")]
    assert apply(spark, parse, "[]") == []
    assert apply(spark, parse, None) is None


def test_join_text(spark):
    assert apply(spark, lambda a, b: text.join_text(a, b), None, "x") == "x"
    assert apply(spark, lambda a, b: text.join_text(a, b), None, None) == ""


def test_sql_functions_agree_with_column_functions(spark):
    from tributary.functions.sql import register

    register(spark)
    samples = ["1.234,56", "(1.234,56)", "", "  ", None, "NaN", "-7,5", "abc", "FEV/2024", "000/2024", "13/2024", "XXX/2024", "FEV",
               "2024NC000123", "2024NC12"]
    frame = spark.createDataFrame([(s,) for s in samples], "s string")
    both = frame.select(
        "s", money.parse_money("s").alias("m"), dates.parse_month_label("s").alias("d"), text.canonical_document("s").alias("n"))
    by_name = frame.selectExpr("s", "parse_financial_value(s) AS m", "parse_date(s) AS d", "format_nc(s) AS n")
    assert both.exceptAll(by_name).collect() == [] and by_name.exceptAll(both).collect() == []


def test_python_list_keeps_odd_bytes(spark):
    frame = spark.createDataFrame([("[{'a': 'x\\xa0y'}]",), ("[{'a': 'it\\'s', 'b': None}]",), ("[{'a': 'c:\\\\xa0'}]",)], ["t"])
    found = [r[0][0]["a"] for r in frame.select(text.python_list("t", "a string")).collect()]
    assert found == ["x\u00a0y", "it's", "c:\\xa0"]


def test_money_is_read_alike_by_name_and_by_column(spark):
    odd = ["(1234)", "(0,5) ", "(1.234,56)", "1.234,56", " 7,00 ", "", " ", "NaN", "x", "(", "(x,1)", "-3,10", None]
    sql.register(spark)
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    both = df.select(money.parse_money("v").alias("column"), F.expr("parse_financial_value(v)").alias("name"))
    assert both.where("not (column <=> name)").count() == 0


def test_list_words_are_looked_up_before_their_surroundings(spark):
    """The words of a list's text form: rewritten only where they stand as a value, by patterns that begin with the word."""
    texts = ["[{'a': None}]", "[{'a':None,'b': True}]", "[{'a': 'x None, y'}]", "[{'a': '\\x41'}]", "[{'a':  None}]", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    parsed = df.select("i", text.python_list("t", "a: string, b: string").alias("l"))
    found = {r.i: r.l and tuple(r.l[0]) for r in parsed.collect()}
    assert found == {0: (None, None), 1: (None, "true"), 2: ("x None, y", None), 3: ("A", None), 4: None, 5: None}
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert all(f", {word}(?<=" in plan for word in ("None", "True", "False"))
