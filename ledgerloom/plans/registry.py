"""Named queries: a title and a builder, or a title and Spark SQL text over ``{ledger}``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from ledgerloom.config import ReportConfig
from ledgerloom.functions.money import format_money_columns
from ledgerloom.functions.sql import sql_functions
from ledgerloom.operators.matrix import matrix_text, ordered
from ledgerloom.plans.reports import expense_matrix, revenue_matrix, surplus_table

Builder = Callable[[DataFrame, ReportConfig, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class NamedQuery:
    title: str
    build: Builder

    @staticmethod
    def from_sql(title: str, text: str, **args: object) -> NamedQuery:
        """Query from SQL text. ``{ledger}`` stands for the ledger; ``:name`` parameters come
        from ``args``, and ``:first_day`` / ``:next_first_day`` bound the report year. The text may
        call the functions of ``functions.sql`` for the report's settings."""

        def build(ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str]) -> DataFrame:
            bounds = {
                "first_day": date(cfg.year, 1, 1),
                "next_first_day": date(cfg.year + 1, 1, 1),
            }
            spark = ledger.sparkSession
            with sql_functions(spark, cfg):
                return spark.sql(text, args={**bounds, **args}, ledger=ledger)

        return NamedQuery(title, build)


class QueryRegistry(dict[str, NamedQuery]):
    """name -> NamedQuery; extend it by adding entries."""

    def run(
        self, name: str, ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()
    ) -> DataFrame:
        """The query's result as a lazy DataFrame."""
        if name not in self:
            raise KeyError(f"no query {name!r}; known: {', '.join(sorted(self))}")
        return self[name].build(ledger, cfg, keys)


def default_registry() -> QueryRegistry:
    """The report queries, as shown to a reader: text matrices in display order."""

    def shown(matrix: Builder) -> Builder:
        return lambda ledger, cfg, keys: matrix_text(
            ordered(matrix(ledger, cfg, keys), keys), cfg
        ).drop("row_type", "rank")

    def shown_surplus(ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str]) -> DataFrame:
        rows = ordered(surplus_table(ledger, cfg, keys), keys).drop("rank")
        return format_money_columns(rows, [*cfg.month_labels, "total"], cfg.surplus_money)

    return QueryRegistry(
        revenue=NamedQuery("Revenue by month", shown(revenue_matrix)),
        expense=NamedQuery("Expense by month", shown(expense_matrix)),
        surplus=NamedQuery("Surplus by month", shown_surplus),
    )
