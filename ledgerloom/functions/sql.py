"""The library's expressions as functions for SQL text.

Each is a SQL function of one expression, which Spark puts in place of the call: no Python runs and
plans are as good as with the DataFrame functions. ``report_grid()`` is a table: every listed revenue
account in every month of the year. They depend on a report's settings, so they
exist only while a text is analysed (``sql_functions``), under plain names.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from ledgerloom.config import MONEY, MoneyStyle, ReportConfig
from ledgerloom.functions.money import WHITE_SPACE
from ledgerloom.functions.text import sql_text
from ledgerloom.operators.lookup import lookup_sql

AMOUNT = "DECIMAL(38,8)"


def _label(column: str) -> str:
    return f"upper(rtrim({column}))"


def _money_text(style: MoneyStyle) -> str:
    minus = style.symbol + "-" if style.negative == "inner" else "-" + style.symbol
    digits = f"translate(format_number(abs(round(amount, 2)), 2), ',.', {sql_text(style.thousands + style.decimal)})"
    return f"concat(CASE WHEN round(amount, 2) < 0 THEN {sql_text(minus)} ELSE {sql_text(style.symbol)} END, {digits})"


def _money_value(style: MoneyStyle) -> str:
    """As ``functions.money.parse_money``."""
    bare = rf"regexp_replace(text, {sql_text(r'\(.*?\)')}, '')"
    symbol = "".join(c for c in style.symbol if c not in "-0123456789")
    other = "" if "." in style.decimal + style.thousands else "."
    taken = sql_text(style.decimal + other + style.thousands + symbol + WHITE_SPACE)
    given = sql_text("." + other.replace(".", "?"))
    decimal, thousands = sql_text(style.decimal), sql_text(style.thousands)
    foreign = f"contains({bare}, {decimal}) AND contains(substring_index({bare}, {decimal}, -1), {thousands})"
    return f"CASE WHEN NOT ({foreign}) THEN try_cast(translate({bare}, {taken}, {given}) AS {MONEY}) END"


def _texts(labels: list[str]) -> str:
    return f"array({', '.join(map(sql_text, labels))})" if labels else "CAST(array() AS ARRAY<STRING>)"


def definitions(cfg: ReportConfig) -> dict[str, str]:
    """name -> parameters, result type and expression, for one report's settings."""
    labels = _texts(list(cfg.month_labels))
    ranks = {
        name: lookup_sql(["label"], {(a,): i for i, a in enumerate(listed, 1)}, str(cfg.unlisted_rank))
        for name, listed in (("revenue_rank", cfg.revenue_labels), ("expense_rank", cfg.expense_labels))
    }
    forecast = f"trunc(month, 'MM') = trunc(add_months(DATE'{cfg.as_of.isoformat()}', -1), 'MM')"
    exempt = f"array_contains({_texts(cfg.exempt_labels)}, account)"
    months = f"sequence(DATE'{cfg.year}-01-01', DATE'{cfg.year}-12-01', INTERVAL 1 MONTH)"
    moved = lookup_sql(["account", _label("sub_code")], cfg.reclass_targets, "account")
    return {
        "label_key": f"(label STRING) RETURNS STRING RETURN {_label('label')}",
        "money_text": f"(amount {AMOUNT}) RETURNS STRING RETURN {_money_text(cfg.money)}",
        "surplus_text": f"(amount {AMOUNT}) RETURNS STRING RETURN {_money_text(cfg.surplus_money)}",
        "money_value": f"(text STRING) RETURNS {MONEY} RETURN {_money_value(cfg.money)}",
        "month_start": "(day DATE) RETURNS DATE RETURN trunc(day, 'MM')",
        "month_label": f"(day DATE) RETURNS STRING RETURN element_at({labels}, month(day))",
        "reclassified": f"(account STRING, sub_code STRING) RETURNS STRING RETURN {moved}",
        "may_forecast": f"(account STRING, month DATE) RETURNS BOOLEAN RETURN {forecast} AND NOT {exempt}",
        "revenue_rank": f"(label STRING) RETURNS INT RETURN {ranks['revenue_rank']}",
        "expense_rank": f"(label STRING) RETURNS INT RETURN {ranks['expense_rank']}",
        "report_grid": f"() RETURNS TABLE (account STRING, month DATE) RETURN SELECT account, explode({months}) AS month "
        f"FROM (SELECT explode({_texts(cfg.revenue_labels)}) AS account)",
    }


@contextmanager
def sql_functions(spark: SparkSession, cfg: ReportConfig) -> Iterator[list[str]]:
    """The functions for SQL text analysed within the block; frames made there stay good after it.
    A temporary function of the session with one of the names is an error, and stays."""
    made: list[str] = []
    try:
        for name, definition in definitions(cfg).items():
            spark.sql(f"CREATE TEMPORARY FUNCTION {name}{definition}")
            made.append(name)
        yield made
    finally:
        for name in made:
            spark.sql(f"DROP TEMPORARY FUNCTION {name}")
