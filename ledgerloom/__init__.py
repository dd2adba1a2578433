"""Period-close budget reporting over ledgers of any size, on Spark DataFrames."""

from ledgerloom.config import MONTH_LABELS, MoneyStyle, Reclass, ReportConfig
from ledgerloom.operators.audit import Audit
from ledgerloom.plans.delivery import deliver_report, publish_report, read_published
from ledgerloom.plans.registry import NamedQuery, QueryRegistry, default_registry
from ledgerloom.plans.reports import (
    expense_matrix,
    report_bundle,
    revenue_matrix,
    surplus,
    surplus_table,
)
from ledgerloom.plans.sql_reports import sql_queries
from ledgerloom.plans.stored import store_matrix, stored_surplus
from ledgerloom.sources.cells import CellStore
from ledgerloom.sources.ledger import read_ledger, read_stored_ledger, write_ledger

__all__ = [
    "Audit",
    "CellStore",
    "MONTH_LABELS",
    "MoneyStyle",
    "NamedQuery",
    "QueryRegistry",
    "Reclass",
    "ReportConfig",
    "default_registry",
    "deliver_report",
    "expense_matrix",
    "publish_report",
    "read_ledger",
    "read_published",
    "read_stored_ledger",
    "report_bundle",
    "revenue_matrix",
    "sql_queries",
    "store_matrix",
    "stored_surplus",
    "surplus",
    "surplus_table",
    "write_ledger",
]
