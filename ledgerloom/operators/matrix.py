"""Account by month matrices: pivot, row and grand totals, ranks, order, text form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import MONEY, ReportConfig
from ledgerloom.functions.money import format_money
from ledgerloom.operators.lookup import lookup

FORECAST_MARK = " (P)"


def month_pivot(
    cells: DataFrame, by: Sequence[str], labels: Sequence[str], aggregate: Column | None = None
) -> DataFrame:
    """One row per distinct ``by``, one column per month; ``cells.month`` is 1 to 12.

    The month list is fixed, so no job runs to find it. Rows first collapse to one per
    ``by`` and month on the map side, and only those travel; a group however hot sends at
    most twelve rows per task. A NULL month fills no column, but its group stays.
    """
    aggregate = F.sum("amount") if aggregate is None else aggregate
    wide = cells.groupBy(*by).pivot("month", list(range(1, 13))).agg(aggregate)
    return wide.toDF(*by, *labels)


def row_total(months: Sequence[Column]) -> Column:
    """Sum over the months, missing ones as 0; 0 when all are missing."""
    return reduce(lambda a, b: a + b, [F.coalesce(m, F.lit(0)) for m in months])


def any_value(months: Sequence[Column]) -> Column:
    return F.coalesce(*months).isNotNull()


def grand_total(
    matrix: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Column sums per entity, rounded to cents. Without keys always exactly one row, all NULL on
    empty input."""
    return matrix.groupBy(*keys).agg(*[F.sum(c).cast(MONEY).alias(c) for c in columns])


def carry_month(matrix: DataFrame, cfg: ReportConfig, only: Column | None = None) -> DataFrame:
    """Forecast on the pivoted form, where the previous month is the column to the left.

    Same result as ``densify`` and ``carry_previous`` (an account without any actual value
    has nothing to carry), without building the grid or sorting a window. Adds
    ``forecast_month``: the number of the forecast column, or NULL.
    """
    number = cfg.forecast_month
    if number is None:
        return matrix.withColumn("forecast_month", F.lit(None).cast("int"))
    current, before = cfg.month_labels[number - 1], cfg.month_labels[number - 2]
    carried = F.col(current).isNull() & F.col(before).isNotNull()
    if cfg.exempt_labels:
        carried = carried & ~F.col("account").isin(cfg.exempt_labels)
    if only is not None:
        carried = carried & only
    return matrix.withColumns({
        "forecast_month": F.when(carried, F.lit(number)),
        current: F.when(carried, F.col(before)).otherwise(F.col(current)),
    })


def ranked(
    df: DataFrame, label: str, labels: Sequence[str], default: int, name: str = "rank"
) -> DataFrame:
    """Add the 1-based position of ``label`` in ``labels``, or ``default``."""
    table = {(text,): position for position, text in enumerate(labels, 1)}
    return lookup(df, [F.col(label)], table, name, F.lit(default))


def ordered(matrix: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Display order; accounts of equal rank by label."""
    return matrix.orderBy(*keys, "rank", "label")


def matrix_text(matrix: DataFrame, cfg: ReportConfig, inner_if: Column | None = None) -> DataFrame:
    """Every amount as money text; forecast cells carry the mark. ``inner_if`` chooses the place
    of the minus row by row."""
    text = {
        name: F.concat(
            format_money(F.col(name), cfg.money, inner_if),
            F.when(F.col("forecast_month") == number, FORECAST_MARK).otherwise(""),
        )
        for number, name in enumerate(cfg.month_labels, 1)
    }
    return matrix.withColumns({**text, "total": format_money(F.col("total"), cfg.money, inner_if)}).drop(
        "forecast_month"
    )
