"""The reports as SQL texts, to run as they are or to start from.

The texts are made for a report's settings as far as names go (months, entity keys); everything
else comes from the functions of ``functions.sql`` and from parameters, so a text can be edited
without touching the library. Results equal those of ``default_registry``, ranks and all.
"""

from __future__ import annotations

from collections.abc import Sequence

from ledgerloom.config import MONEY, RAW, ReportConfig, label_text
from ledgerloom.functions.text import sql_name, sql_text
from ledgerloom.plans.registry import NamedQuery


class _Parts:
    """Lists of columns that the texts share."""

    def __init__(self, cfg: ReportConfig, keys: Sequence[str]) -> None:
        self.cfg, self.months = cfg, [sql_name(m) for m in cfg.month_labels]
        self.amounts, self.marks = ([sql_name(f"{m}_{part}") for m in cfg.month_labels] for part in ("amount", "mark"))
        names = [sql_name(k) for k in keys]
        self.keys = "".join(f"{k}, " for k in names)
        self.by = [*names, "account"]
        self.group = f"GROUP BY {', '.join(names)}" if keys else ""
        self.same = lambda a, b: " AND ".join([f"{a}.{k} <=> {b}.{k}" for k in names] or ["true"])
        self.names = ", ".join(f"{sql_text(m)} AS {sql_name(m)}" for m in cfg.month_labels)
        self.row_total = " + ".join(f"coalesce({m}, 0)" for m in self.months)
        self.year = "entry_date >= :first_day AND entry_date < :next_first_day"

    def sums(self, source: str) -> str:
        """A row of column sums for each entity of ``source``; one row if there are no keys."""
        cells = ", ".join(f"CAST(sum({m}) AS {MONEY}) AS {m}" for m in [*self.months, "total"])
        return f"SELECT {self.keys}{cells} FROM {source} {self.group}"

    def texts(self, function: str = "money_text") -> str:
        return ", ".join(f"{function}({m}) AS {m}" for m in [*self.months, "total"])


def _revenue(p: _Parts) -> str:
    """CTEs up to ``revenue_numbers`` (listed accounts) and ``revenue_total``."""
    entities = f"(SELECT DISTINCT {p.keys.rstrip(', ')} FROM revenue_cells)" if p.keys else "(SELECT 1)"
    return f"""revenue_cells AS (
    SELECT {p.keys}reclassified(label_key(account), sub_code) AS account, month_start(entry_date) AS month,
           CAST(sum(amount) AS {RAW}) AS amount
    FROM {{ledger}}
    WHERE {p.year} AND label_key(kind) = :revenue_kind
    GROUP BY ALL
),
revenue_grid AS (SELECT e.*, g.account, g.month FROM {entities} e CROSS JOIN report_grid() g),
dense AS (
    SELECT g.*, c.amount, lag(c.amount) OVER (PARTITION BY {", ".join(f"g.{k}" for k in p.by)} ORDER BY g.month) AS previous
    FROM revenue_grid g LEFT JOIN revenue_cells c ON g.account = c.account AND g.month = c.month AND {p.same("g", "c")}
),
carried AS (
    SELECT {p.keys}account, month_label(month) AS name, coalesce(amount, previous) AS amount,
           CASE WHEN amount IS NULL THEN ' (P)' ELSE '' END AS mark
    FROM dense WHERE amount IS NOT NULL OR (previous IS NOT NULL AND may_forecast(account, month))
),
wide AS (
    SELECT * FROM (SELECT {p.keys}account, name, amount, mark FROM carried)
    PIVOT (sum(amount) AS amount, max(mark) AS mark FOR name IN ({p.names}))
),
revenue_numbers AS (
    SELECT {p.keys}account, {", ".join(f"{a} AS {m}, {mark}" for a, m, mark in zip(p.amounts, p.months, p.marks))},
           {" + ".join(f"coalesce({a}, 0)" for a in p.amounts)} AS total
    FROM wide
),
revenue_total AS ({p.sums(f"(SELECT e.*, {', '.join([*p.months, 'total'])} FROM {entities} e LEFT JOIN revenue_numbers n ON {p.same('e', 'n')})" if p.keys else "revenue_numbers")})"""


def _expense(p: _Parts) -> str:
    """CTEs up to ``expense_numbers`` and ``expense_total``."""
    return f"""expense_cells AS (
    SELECT {p.keys}label_key(account) AS account, month_label(entry_date) AS name, CAST(sum(amount) AS {RAW}) AS amount
    FROM {{ledger}}
    WHERE {p.year} AND label_key(kind) = :expense_kind
    GROUP BY ALL
),
expense_wide AS (SELECT * FROM expense_cells PIVOT (sum(amount) FOR name IN ({p.names}))),
expense_numbers AS (SELECT *, {p.row_total} AS total FROM expense_wide),
expense_total AS ({p.sums("expense_numbers")})"""


def revenue_sql(cfg: ReportConfig, keys: Sequence[str] = ()) -> str:
    """The revenue matrix as text: [keys], label, rank, months, total."""
    p = _Parts(cfg, keys)
    marked = ", ".join(f"concat(money_text({m}), {mark}) AS {m}" for m, mark in zip(p.months, p.marks))
    return f"""WITH {_revenue(p)}
SELECT {p.keys}account AS label, revenue_rank(account) AS rank, {marked}, money_text(total) AS total FROM revenue_numbers
UNION ALL
SELECT {p.keys}:total_label, {cfg.total_rank}, {p.texts()} FROM revenue_total"""


def expense_sql(cfg: ReportConfig, keys: Sequence[str] = ()) -> str:
    """The expense matrix as text: [keys], label, rank, months, total."""
    p = _Parts(cfg, keys)
    return f"""WITH {_expense(p)}
SELECT {p.keys}account AS label, expense_rank(account) AS rank, {p.texts()} FROM expense_numbers
UNION ALL
SELECT {p.keys}:total_label, {cfg.total_rank}, {p.texts()} FROM expense_total"""


def surplus_sql(cfg: ReportConfig, keys: Sequence[str] = ()) -> str:
    """Both difference rows as text: [keys], label, rank, months, total."""
    p = _Parts(cfg, keys)
    columns = "".join(f"coalesce(r.{k}, e.{k}) AS {k}, " for k in map(sql_name, keys))
    taken = "coalesce(x.{0}, 0)" if cfg.missing_as_zero else "x.{0}"
    plain = ", ".join(f"CAST(r.{m} - e.{m} AS {MONEY}) AS {m}" for m in p.months)
    reduced = ", ".join(f"CAST(r.{m} - CAST({taken.format(m)} AS {MONEY}) - e.{m} AS {MONEY}) AS {m}" for m in p.months)
    sides = f"revenue_total r FULL JOIN expense_total e ON {p.same('r', 'e')}"
    rows = f"SELECT {columns}:surplus_label AS label, 1 AS rank, {plain} FROM {sides}"
    if cfg.excluded_label is not None:
        chosen = "(SELECT * FROM revenue_numbers WHERE account = :excluded_label) x"
        rows += f"\nUNION ALL\nSELECT {columns}:surplus_excluding_label, 2, {reduced} FROM {sides} LEFT JOIN {chosen} ON {p.same('r', 'x')}"
    return f"""WITH {_revenue(p)},
{_expense(p)},
differences AS (
{rows}
)
SELECT {p.keys}label, rank, {p.texts("surplus_text")} FROM (SELECT *, {p.row_total} AS total FROM differences)"""


def sql_queries(cfg: ReportConfig, keys: Sequence[str] = ()) -> dict[str, NamedQuery]:
    """The three reports as named queries in SQL, for a registry. The texts fit these settings' month
    names, ranks of total rows and keys."""
    titles = dict(zip(("expense", "revenue", "surplus"), cfg.section_titles))
    common = {"revenue_kind": label_text(cfg.revenue_kind)}
    totals = {"total_label": cfg.total_label}
    spending = {"expense_kind": label_text(cfg.expense_kind)}
    differences = {"surplus_label": cfg.surplus_label}
    if cfg.excluded_label is not None:
        differences |= {"surplus_excluding_label": cfg.surplus_excluding_label, "excluded_label": cfg.excluded_label}
    return {
        "revenue": NamedQuery.from_sql(titles["revenue"], revenue_sql(cfg, keys), **common, **totals),
        "expense": NamedQuery.from_sql(titles["expense"], expense_sql(cfg, keys), **spending, **totals),
        "surplus": NamedQuery.from_sql(titles["surplus"], surplus_sql(cfg, keys), **common, **spending, **differences),
    }
