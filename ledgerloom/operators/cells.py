"""From postings to one amount per entity, account and month."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import MONEY, PLAIN_KINDS, ReportConfig, label_text
from ledgerloom.functions.dates import in_year, month_before, month_start, months_of
from ledgerloom.functions.text import label_key
from ledgerloom.operators.lookup import lookup


def has_plain_kinds(ledger: DataFrame) -> bool:
    return bool(ledger.schema["kind"].metadata.get(PLAIN_KINDS))


def year_kind_filter(ledger: DataFrame, year: int, kinds: Sequence[str]) -> DataFrame:
    """Postings of one year and the given kinds. Where the ledger is known to hold kinds in the form
    in which they are compared, the kinds reach the file scan as the year does."""
    wanted = [label_text(k) for k in kinds]
    kind = F.col("kind") if has_plain_kinds(ledger) else label_key(F.col("kind"))
    return ledger.where(in_year(F.col("entry_date"), year) & kind.isin(wanted))


def reclassify(
    postings: DataFrame,
    targets: Mapping[tuple[str, str], str],
    only: Column | None = None,
) -> DataFrame:
    """Rename ``account`` (already a label key) where (account, code) has a target and
    ``only`` holds."""
    if not targets:
        return postings
    moved = lookup(
        postings, [F.col("account"), label_key(F.col("sub_code"))], targets, "__moved", F.col("account")
    )
    account = F.col("__moved") if only is None else F.when(only, F.col("__moved")).otherwise(F.col("account"))
    return moved.withColumn("account", account).drop("__moved")


def month_sums(
    ledger: DataFrame, cfg: ReportConfig, kind: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Sum per entity, reclassified account and month: [keys], account, month, amount. The rules
    move revenue only. Each sum is rounded to cents once."""
    rules = cfg.reclass_targets if label_text(kind) == label_text(cfg.revenue_kind) else {}
    postings = year_kind_filter(ledger, cfg.year, [kind]).select(
        *keys,
        label_key(F.col("account")).alias("account"),
        "sub_code",
        month_start(F.col("entry_date")).alias("month"),
        "amount",
    )
    return (
        reclassify(postings, rules)
        .groupBy(*keys, "account", "month")
        .agg(F.sum("amount").cast(MONEY).alias("amount"))
    )


def month_account_grid(entities: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Every listed revenue account in every month, for each row of ``entities``.

    The lists come from settings, so each entity row expands by a fixed factor in place;
    nothing is joined or moved.
    """
    accounts = F.array(*[F.lit(a) for a in cfg.revenue_labels])
    return entities.withColumn("account", F.explode(accounts)).withColumn(
        "month", F.explode(months_of(cfg.year))
    )


def densify(grid: DataFrame, sums: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Grid cells with their sum where there is one. Sums outside the grid are dropped.

    Both sides have one row per (entity, account, month), so no join key can be hot.
    A NULL entity key matches itself.
    """
    on_columns = [*keys, "account", "month"]
    right = sums.select(*[F.col(c).alias(f"__{c}") for c in on_columns], "amount")
    on = F.lit(True)
    for c in on_columns:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return grid.join(right, on, "left").select(*on_columns, "amount")


def previous_month(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``previous``: the amount one month earlier. Needs dense cells (12 rows per window)."""
    calendar = Window.partitionBy(*keys, "account").orderBy("month")
    return cells.withColumn("previous", F.lag("amount").over(calendar))


def carry_previous(cells: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()) -> DataFrame:
    """Fill the month before ``as_of`` from the month before it, where it has no value.

    Only actual values are carried, so a forecast never feeds another one.
    """
    forecast = (
        F.col("amount").isNull()
        & F.col("previous").isNotNull()
        & (F.col("month") == month_before(F.lit(cfg.as_of)))
    )
    if cfg.exempt_labels:
        forecast = forecast & ~F.col("account").isin(cfg.exempt_labels)
    return previous_month(cells, keys).select(
        *keys,
        "account",
        "month",
        F.when(F.col("amount").isNotNull(), F.col("amount"))
        .when(forecast, F.col("previous"))
        .alias("amount"),
        forecast.alias("is_forecast"),
    )
