"""What a report leaves out: counted and summed while the report reads the ledger.

Every posting is in exactly one class of ``CLASSES``: in the report, or left out for the first
reason that holds. ``Audit`` hangs the classes' counts and sums on the ledger as observed metrics,
which the report's own job fills in; no pass of its own is needed. As postings of other years count
as well, an audited ledger is read as a whole: neither year nor kind reaches the files.
"""

from __future__ import annotations

from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.config import ReportConfig, label_text
from ledgerloom.functions.dates import in_year
from ledgerloom.functions.text import label_key
from ledgerloom.operators.lookup import lookup_value

#: Reasons in order, then what is left.
CLASSES = ("no date", "other year", "other kind", "unlisted revenue", "reported")


def posting_class(cfg: ReportConfig) -> Column:
    """Class of a posting; a posting without a kind is of another kind."""
    kind, account = label_key(F.col("kind")), label_key(F.col("account"))
    is_revenue = kind == label_text(cfg.revenue_kind)
    is_expense = kind == label_text(cfg.expense_kind)
    account = lookup_value([account, label_key(F.col("sub_code"))], cfg.reclass_targets, account)
    listed = F.coalesce(account.isin(cfg.revenue_labels), F.lit(False))
    return (
        F.when(F.col("entry_date").isNull(), CLASSES[0])
        .when(~in_year(F.col("entry_date"), cfg.year), CLASSES[1])
        .when(~F.coalesce(is_revenue | is_expense, F.lit(False)), CLASSES[2])
        .when(is_revenue & ~listed, CLASSES[3])
        .otherwise(CLASSES[4])
    )


def _metrics() -> list[Column]:
    out = []
    for i, name in enumerate(CLASSES):
        chosen = F.col("_class") == name
        out += [
            F.count(F.when(chosen, 1)).alias(f"n_{i}"),
            F.count(F.when(chosen, F.col("amount"))).alias(f"with_amount_{i}"),
            F.sum(F.when(chosen, F.col("amount"))).alias(f"amount_{i}"),
        ]
    return out


class Audit:
    """``ledger`` is the given one, observed: make one report of it and run that, then ask ``rows``."""

    def __init__(self, ledger: DataFrame, cfg: ReportConfig) -> None:
        self._marked = ledger.withColumn("_class", posting_class(cfg))
        self._observation = Observation()
        self.ledger = self._marked.observe(self._observation, *_metrics()).drop("_class")

    def rows(self) -> list[tuple[str, int, int, Decimal]]:
        """Class, postings, those of them that have an amount, and the sum. Waits for the report.

        Where nothing at all is in the report, Spark drops the way from the ledger to it, and what
        was observed on the way; only then a job of its own takes the sums."""
        try:
            found = self._observation.get
        except Py4JJavaError:
            found = self._marked.agg(*_metrics()).first()
        return [(name, found[f"n_{i}"], found[f"with_amount_{i}"], found[f"amount_{i}"] or Decimal(0)) for i, name in enumerate(CLASSES)]
