"""Reports as lazy DataFrames. Nothing here runs a job.

All reports grow from one frame, ``account_months``: a single pass over the ledger that
leaves one row per entity, kind and account. Totals, differences, ranks and text work on
that frame only. With ``keys`` one job makes the report of every entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import MONEY, RAW, RESERVED, ReportConfig, label_text
from ledgerloom.functions.text import label_key
from ledgerloom.operators.cells import reclassify, year_kind_filter
from ledgerloom.operators.delta import PARTS, surplus_rows, surplus_structs, totals_of_matrices
from ledgerloom.operators.lookup import lookup
from ledgerloom.operators.matrix import (
    any_value,
    carry_month,
    grand_total,
    month_pivot,
    row_total,
)


def check_keys(cfg: ReportConfig, keys: Sequence[str]) -> None:
    """Entity keys may not be named like a column of the ledger or the report."""
    months = {m.lower() for m in cfg.month_labels}
    made = {f"{part}_{m}" for part in PARTS for m in [*months, "total"]}
    taken = sorted({k.lower() for k in keys} & (RESERVED | months | made))
    if taken:
        raise ValueError(f"rename these entity keys, the reports use the names: {taken}")


def account_months(
    ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str], kinds: Sequence[str]
) -> DataFrame:
    """[keys], is_revenue, account, months, forecast_month, total; amounts as precise as the
    ledger's, to be rounded by what is made of them.

    Revenue outside the listed accounts keeps neither account nor amount: it folds into one
    empty row per entity with a NULL total, which holds the entity's place in the totals.
    """
    check_keys(cfg, keys)
    wanted = {label_text(k) for k in kinds}
    revenue = label_text(cfg.revenue_kind)
    has_revenue = revenue in wanted
    # For a single kind a constant, which Catalyst takes out of the grouping.
    is_revenue = F.lit(has_revenue) if len(wanted) == 1 else label_key(F.col("kind")) == revenue

    source = [*keys, is_revenue.alias("is_revenue"), label_key(F.col("account")).alias("account")]
    if has_revenue and cfg.reclass:
        source.append("sub_code")
    postings = year_kind_filter(ledger, cfg.year, sorted(wanted)).select(
        *source, F.month("entry_date").alias("month"), "amount"
    )
    if has_revenue:
        postings = reclassify(postings, cfg.reclass_targets, F.col("is_revenue"))
        kept = ~F.col("is_revenue") | F.col("account").isin(cfg.revenue_labels)
        postings = postings.withColumns({
            "account": F.when(kept, F.col("account")),
            "amount": F.when(kept, F.col("amount")),
        })

    wide = month_pivot(
        postings, [*keys, "is_revenue", "account"], cfg.month_labels, F.sum("amount").cast(RAW)
    )
    wide = carry_month(wide, cfg, F.col("is_revenue"))
    months = [F.col(m) for m in cfg.month_labels]
    shown = ~F.col("is_revenue") | any_value(months)
    return wide.withColumn("total", F.when(shown, row_total(months)))


def _details(wide: DataFrame, cfg: ReportConfig, keys: Sequence[str]) -> DataFrame:
    ranks = {("revenue", a): i for i, a in enumerate(cfg.revenue_labels, 1)}
    ranks |= {("expense", a): i for i, a in enumerate(cfg.expense_labels, 1)}
    section = F.when(F.col("is_revenue"), "revenue").otherwise("expense")
    return lookup(
        wide.where(F.col("total").isNotNull()).withColumn("section", section),
        [F.col("section"), F.col("account")],
        ranks,
        "rank",
        F.lit(cfg.unlisted_rank),
    ).select(
        *keys,
        "section",
        F.lit("detail").alias("row_type"),
        F.col("account").alias("label"),
        "rank",
        *[F.col(name).cast(MONEY).alias(name) for name in [*cfg.month_labels, "total"]],
        "forecast_month",
    )


def _matrix(wide: DataFrame, cfg: ReportConfig, keys: Sequence[str]) -> DataFrame:
    amounts = [*cfg.month_labels, "total"]
    total = grand_total(wide, amounts, keys).select(
        *keys,
        F.lit("total").alias("row_type"),
        F.lit(cfg.total_label).alias("label"),
        F.lit(cfg.total_rank).alias("rank"),
        *amounts,
        F.lit(None).cast("int").alias("forecast_month"),
    )
    return _details(wide, cfg, keys).drop("section").unionByName(total)


def revenue_matrix(ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()) -> DataFrame:
    """Listed revenue accounts by month, with forecast and total row:
    [keys], row_type, label, rank, months, total, forecast_month."""
    return _matrix(account_months(ledger, cfg, keys, [cfg.revenue_kind]), cfg, keys)


def expense_matrix(ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()) -> DataFrame:
    """All expense accounts by month, with total row; columns as in ``revenue_matrix``."""
    return _matrix(account_months(ledger, cfg, keys, [cfg.expense_kind]), cfg, keys)


def surplus(
    revenue: DataFrame, expense: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()
) -> DataFrame:
    """Difference rows of two finished matrices: [keys], label, rank, months, total.

    From a ledger, ``surplus_table`` gives the same in one pass over it.
    """
    return surplus_rows(totals_of_matrices(revenue, expense, cfg, keys), cfg, keys)


def _entity_totals(wide: DataFrame, cfg: ReportConfig, keys: Sequence[str]) -> DataFrame:
    """One row per entity: every total and the excluded account, from one aggregate."""
    is_revenue = F.col("is_revenue")
    is_excluded = is_revenue & (F.col("account") == F.lit(cfg.excluded_label).cast("string"))
    return wide.groupBy(*keys).agg(*[
        F.sum(F.when(chosen, F.col(name))).cast(MONEY).alias(f"{part}_{name}")
        for part, chosen in zip(PARTS, (is_revenue, ~is_revenue, is_excluded))
        for name in [*cfg.month_labels, "total"]
    ])


def surplus_table(ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()) -> DataFrame:
    """Difference rows straight from the ledger, in one pass over both kinds."""
    wide = account_months(ledger, cfg, keys, [cfg.revenue_kind, cfg.expense_kind])
    return surplus_rows(_entity_totals(wide, cfg, keys), cfg, keys)


def report_bundle(ledger: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()) -> DataFrame:
    """All three tables of every entity from one ledger pass.

    [keys], section ('expense', 'revenue', 'surplus'), row_type, label, rank, months,
    total, forecast_month. Each entity with a posting in the year gets all three sections.
    """
    wide = account_months(ledger, cfg, keys, [cfg.revenue_kind, cfg.expense_kind])
    details = _details(wide, cfg, keys)

    amounts = [*cfg.month_labels, "total"]
    no_forecast = F.lit(None).cast("int").alias("forecast_month")
    rows = [
        F.struct(
            F.lit(part).alias("section"),
            F.lit("total").alias("row_type"),
            F.lit(cfg.total_label).alias("label"),
            F.lit(cfg.total_rank).alias("rank"),
            *[F.col(f"{part}_{name}").alias(name) for name in amounts],
            no_forecast,
        )
        for part in ("expense", "revenue")
    ] + [
        F.struct(
            F.lit("surplus").alias("section"),
            F.lit("detail").alias("row_type"),
            *[row[name].alias(name) for name in ["label", "rank", *amounts]],
            no_forecast,
        )
        for row in surplus_structs(cfg)
    ]
    totals = _entity_totals(wide, cfg, keys).select(*keys, F.inline(F.array(*rows)))
    return details.unionByName(totals)
