"""The reports computed plainly in Python, for small ledgers."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

from ledgerloom import ReportConfig
from ledgerloom.config import label_text


def _add(a, b):
    return b if a is None else a if b is None else a + b


def _key(text):
    return None if text is None else label_text(text)


def bundle(rows: list[tuple], cfg: ReportConfig) -> dict[tuple, tuple]:
    """(unit, section, row_type, label) -> (rank, [12 months], total, forecast_month), from rows
    (date, kind, account, sub_code, amount, unit)."""
    revenue: dict = defaultdict(lambda: defaultdict(lambda: [None] * 12))
    expense: dict = defaultdict(lambda: defaultdict(lambda: [None] * 12))
    units = set()
    for day, kind, account, code, amount, unit in rows:
        kind, account, code = _key(kind), _key(account), _key(code)
        if day is None or day.year != cfg.year or kind not in ("REVENUE", "EXPENSE"):
            continue
        units.add(unit)
        if kind == "REVENUE":
            account = cfg.reclass_targets.get((account, code), account)
            if account not in cfg.revenue_labels:
                continue
        cells = (revenue if kind == "REVENUE" else expense)[unit][account]
        cells[day.month - 1] = _add(cells[day.month - 1], amount)

    result: dict[tuple, tuple] = {}

    def total(cells):
        return sum((c for c in cells if c is not None), Decimal(0))

    def add_total(unit, section, table):
        sums, grand = [None] * 12, None
        for cells in table:
            sums = [_add(s, c) for s, c in zip(sums, cells)]
            grand = _add(grand, total(cells))
        result[unit, section, "total", "TOTAL"] = (cfg.total_rank, sums, grand, None)
        return sums

    for unit in units:
        shown = []
        excluded = [None] * 12
        for account, cells in revenue[unit].items():
            actual, forecast = list(cells), None
            i = cfg.forecast_month
            if i and account not in cfg.exempt_labels:
                if actual[i - 1] is None and actual[i - 2] is not None:
                    cells[i - 1], forecast = actual[i - 2], i
            if any(c is not None for c in cells):
                rank = cfg.revenue_labels.index(account) + 1
                result[unit, "revenue", "detail", account] = (rank, cells, total(cells), forecast)
                shown.append(cells)
                if account == cfg.excluded_label:
                    excluded = cells
        revenue_sums = add_total(unit, "revenue", shown)
        for account, cells in expense[unit].items():
            labels = cfg.expense_labels
            rank = labels.index(account) + 1 if account in labels else cfg.unlisted_rank
            result[unit, "expense", "detail", account] = (rank, cells, total(cells), None)
        expense_sums = add_total(unit, "expense", expense[unit].values())

        plain = [None if None in p else p[0] - p[1] for p in zip(revenue_sums, expense_sums)]
        less = [
            None if None in p else p[0] - p[1] - p[2]
            for p in zip(revenue_sums, excluded, expense_sums)
        ]
        result[unit, "surplus", "detail", cfg.surplus_label] = (1, plain, total(plain), None)
        result[unit, "surplus", "detail", cfg.surplus_excluding_label] = (2, less, total(less), None)
    return result
