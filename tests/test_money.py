from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import as_dicts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.config import BRL, BRL_INNER, BRL_POINT, MoneyStyle
from ledgerloom.functions.money import (
    format_money,
    format_money_columns,
    money_rejects,
    parse_money,
    parse_money_columns,
    sign_class,
)

PARSED = [
    ("R$ 1.234,56 (P)", "1234.56"),
    ("R$\u00a01.234,56", "1234.56"),
    ("\u2007R$\u202f1.234,56\t\n", "1234.56"),
    ("R$ 1.234,56", "1234.56"),
    ("-R$ 5,10", "-5.10"),
    ("R$ -5,10", "-5.10"),
    ("(R$ 5,10)", None),
    ("(a) 7,00 (b)", "7.00"),
    ("abc", None),
    ("", None),
    ("   ", None),
    ("\t\u00a0\n", None),
    (None, None),
    ("R$ 1.234.567.890,12", "1234567890.12"),
    ("17", "17.00"),
]

FORMATTED = [
    ("1234.56", "R$ 1.234,56", "R$ 1.234,56", "R$ 1,234.56"),
    ("-1000", "-R$ 1.000,00", "R$ -1.000,00", "R$ -1,000.00"),
    ("0.125", "R$ 0,13", "R$ 0,13", "R$ 0.13"),
    ("-0.004", "R$ 0,00", "R$ 0,00", "R$ 0.00"),
    ("-0.005", "-R$ 0,01", "R$ -0,01", "R$ -0.01"),
    ("0", "R$ 0,00", "R$ 0,00", "R$ 0.00"),
    ("12345678901234567.89", "R$ 12.345.678.901.234.567,89",
     "R$ 12.345.678.901.234.567,89", "R$ 12,345,678,901,234,567.89"),
    (None, None, None, None),
]


def test_parse(spark):
    df = spark.createDataFrame([(t,) for t, _ in PARSED], "t string")
    found = [r["v"] for r in as_dicts(df.select(parse_money(F.col("t")).alias("v")))]
    assert found == [None if v is None else Decimal(v) for _, v in PARSED]


def test_rejects(spark):
    df = spark.createDataFrame([(t,) for t, _ in PARSED], "t string")
    (row,) = as_dicts(money_rejects(df, ["t"]))
    assert row == {
        "column_name": "t", "n_texts": len(PARSED) - 1, "n_rejects": 2,
        "first_reject": "(R$ 5,10)", "last_reject": "abc",
    }
    (none,) = as_dicts(money_rejects(df.where("false"), ["t"]))
    assert none["n_texts"] == 0 and none["n_rejects"] == 0 and none["first_reject"] is None


def test_format(spark):
    data = [(None if v is None else Decimal(v),) for v, *_ in FORMATTED]
    df = spark.createDataFrame(data, "v decimal(28,4)")
    for place, style in enumerate((BRL, BRL_INNER, BRL_POINT), 1):
        found = [r["t"] for r in as_dicts(df.select(format_money(F.col("v"), style).alias("t")))]
        assert found == [case[place] for case in FORMATTED]
    inner = df.select(format_money(F.col("v"), BRL, F.col("v") < -1).alias("t"))
    assert [r["t"] for r in as_dicts(inner)][1:5] == ["R$ -1.000,00", "R$ 0,13", "R$ 0,00", "-R$ 0,01"]


def test_format_columns_leaves_text_alone(spark):
    df = spark.sql("SELECT 'x' AS label, 5 AS n, CAST(2.5 AS DECIMAL(18,2)) AS v, 1.5D AS d")
    assert as_dicts(format_money_columns(df)) == [
        {"label": "x", "n": "R$ 5,00", "v": "R$ 2,50", "d": "R$ 1,50"}
    ]
    assert as_dicts(format_money_columns(df, ["v"]))[0]["n"] == 5


def test_parse_columns_leaves_others_alone(spark):
    df = spark.sql("SELECT 'R$ 1,00' AS label, 'R$ 1,00' AS jan, 'R$ 2,00' AS total")
    row = as_dicts(parse_money_columns(df, ["jan"]))[0]
    assert row == {"label": "R$ 1,00", "jan": Decimal(1), "total": "R$ 2,00"}


def test_sign_class(spark):
    df = spark.sql("SELECT explode(array(-1, 0, 2, NULL)) AS v")
    assert [r["s"] for r in as_dicts(df.select(sign_class(F.col("v")).alias("s")))] == [
        "neg", "pos", "pos", None
    ]


def test_style_checks():
    with pytest.raises(ValueError):
        MoneyStyle(negative="left")
    with pytest.raises(ValueError):
        MoneyStyle(thousands="")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(10**24), 10**24), min_size=200, max_size=400))
def test_parse_reverses_format(spark, cents):
    amounts = [Decimal(c).scaleb(-2) for c in cents]
    df = spark.createDataFrame([(a,) for a in amounts], "v decimal(28,2)")
    for style in (BRL, BRL_INNER):
        back = df.select("v", parse_money(format_money(F.col("v"), style)).alias("b"))
        assert back.where(~F.col("v").eqNullSafe(F.col("b"))).count() == 0
