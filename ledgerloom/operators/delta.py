"""Difference rows: revenue less expense, with and without one revenue account.

They start from one row of totals per entity with columns ``revenue_<month>``,
``expense_<month>`` and ``excluded_<month>``; months are matched by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import MONEY, ReportConfig
from ledgerloom.operators.matrix import row_total

PARTS = ("revenue", "expense", "excluded")


def surplus_structs(cfg: ReportConfig) -> list[Column]:
    """One struct (label, rank, months, total) per difference row.

    A month missing on any side is missing in the result; totals skip it.
    """
    plain, reduced = [], []
    for name in cfg.month_labels:
        revenue, expense, excluded = (F.col(f"{part}_{name}") for part in PARTS)
        if cfg.missing_as_zero:
            excluded = F.coalesce(excluded, F.lit(0))
        plain.append((revenue - expense).cast(MONEY))
        reduced.append((revenue - excluded - expense).cast(MONEY))
    rows = [(cfg.surplus_label, plain)]
    if cfg.excluded_label is not None:
        rows.append((cfg.surplus_excluding_label, reduced))
    return [
        F.struct(
            F.lit(label).alias("label"),
            F.lit(rank).alias("rank"),
            *[m.alias(name) for m, name in zip(months, cfg.month_labels)],
            row_total(months).cast(MONEY).alias("total"),
        )
        for rank, (label, months) in enumerate(rows, 1)
    ]


def surplus_rows(totals: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()) -> DataFrame:
    """Difference table: [keys], label, rank, months, total."""
    return totals.select(*keys, F.inline(F.array(*surplus_structs(cfg))))


def totals_of_matrices(
    revenue: DataFrame, expense: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()
) -> DataFrame:
    """Bring both total rows and the excluded account's row onto one row per entity.

    Done by grouping tagged rows, not by joining: an entity (or the excluded account)
    missing on one side leaves NULLs, a NULL entity key is an entity like any other, and
    without keys there is always one row.
    """
    is_total = F.col("row_type") == "total"
    part = F.when(is_total, "revenue")
    if cfg.excluded_label is not None:
        part = part.when(F.col("label") == cfg.excluded_label, "excluded")
    months = cfg.month_labels
    # Untagged revenue rows are left to the aggregate, which skips them: filtered out here, they
    # would part the ways of detail and total rows down at the ledger, and scan it twice.
    tagged = revenue.select(*keys, part.alias("part"), *months).unionByName(
        expense.where(is_total).select(*keys, F.lit("expense").alias("part"), *months)
    )
    return tagged.groupBy(*keys).agg(*[
        F.max(F.when(F.col("part") == p, F.col(name))).alias(f"{p}_{name}")
        for p in PARTS
        for name in months
    ])
