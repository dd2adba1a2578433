"""Report settings. Everything here is small, driver-side and known before a plan is built."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

# Short month names of the report's locale, January to December.
MONTH_LABELS = (
    "jan", "fev", "mar", "abr", "mai", "jun",
    "jul", "ago", "set", "out", "nov", "dez",
)

# Decimal type of every amount in a report: cents, rounded once, after all sums.
MONEY = "decimal(28,2)"

# Decimal type of postings and of their sums before rounding. Twelve of the sums add up without
# Spark having to give up decimals.
RAW_DECIMALS = 8
RAW = f"decimal(26,{RAW_DECIMALS})"

# Mark on the column ``kind`` of a ledger that holds kinds as ``label_text`` gives them.
PLAIN_KINDS = "ledgerloom.plain_kinds"

# Column names of ledgers, reports and documents; month labels and entity keys may use none.
RESERVED = frozenset({
    "entry_date", "kind", "account", "sub_code", "amount", "month", "is_revenue", "section",
    "row_type", "label", "rank", "total", "forecast_month", "report_year", "html", "opens",
    "title", "subject", "intro", "part_rank", "part_label", "line",
})

# The three tables of a report, in the order they are delivered.
SECTIONS = ("expense", "revenue", "surplus")


def label_text(label: str) -> str:
    """Python twin of ``functions.text.label_key``, for labels given in settings."""
    return label.rstrip(" ").upper()


@dataclass(frozen=True)
class MoneyStyle:
    """How an amount is written. ``negative`` puts the minus before ('outer') or after
    ('inner') the currency symbol."""

    symbol: str = "R$ "
    thousands: str = "."
    decimal: str = ","
    negative: str = "outer"

    def __post_init__(self) -> None:
        if self.negative not in ("outer", "inner"):
            raise ValueError(f"negative must be 'outer' or 'inner', got {self.negative!r}")
        if len(self.thousands) != 1 or len(self.decimal) != 1:
            raise ValueError("separators must be single characters")
        if not {self.thousands, self.decimal}.isdisjoint("&<>"):
            raise ValueError("separators must not be HTML signs")


BRL = MoneyStyle()
BRL_INNER = MoneyStyle(negative="inner")
BRL_POINT = MoneyStyle(thousands=",", decimal=".", negative="inner")


@dataclass(frozen=True)
class Reclass:
    """Postings of ``account`` with code ``sub_code`` are reported under ``to_account``."""

    account: str
    sub_code: str
    to_account: str


@dataclass(frozen=True)
class ReportConfig:
    """One report definition.

    ``revenue_accounts`` and ``expense_accounts`` are in display order: a label's rank is its
    position. Revenue outside its list is left out of the report; expenses outside theirs
    are kept and shown last.
    """

    year: int
    revenue_accounts: tuple[str, ...]
    expense_accounts: tuple[str, ...] = ()
    reclass: tuple[Reclass, ...] = ()
    forecast_exempt: tuple[str, ...] = ()
    excluded_account: str | None = None
    as_of: date = field(default_factory=date.today)
    revenue_kind: str = "REVENUE"
    expense_kind: str = "EXPENSE"
    total_label: str = "TOTAL"
    surplus_label: str = "SURPLUS"
    month_labels: tuple[str, ...] = MONTH_LABELS
    money: MoneyStyle = BRL
    surplus_negative: str = "inner"
    missing_as_zero: bool = False
    section_titles: tuple[str, str, str] = (
        "Expense by month", "Revenue by month", "Surplus by month"
    )
    label_heading: str = "label"
    total_heading: str = "total"
    subject: str = "Budget preview - "
    intro: str = "Expense and revenue as of "

    def __post_init__(self) -> None:
        if len(self.month_labels) != 12 or len(set(self.month_labels)) != 12:
            raise ValueError("month_labels must hold twelve different names")
        taken = sorted(RESERVED & {m.lower() for m in self.month_labels})
        if taken:
            raise ValueError(f"month_labels may not be names that the reports use: {taken}")

    @property
    def surplus_money(self) -> MoneyStyle:
        return replace(self.money, negative=self.surplus_negative)

    @property
    def revenue_labels(self) -> list[str]:
        return list(dict.fromkeys(label_text(a) for a in self.revenue_accounts))

    @property
    def expense_labels(self) -> list[str]:
        return list(dict.fromkeys(label_text(a) for a in self.expense_accounts))

    @property
    def exempt_labels(self) -> list[str]:
        return list(dict.fromkeys(label_text(a) for a in self.forecast_exempt))

    @property
    def excluded_label(self) -> str | None:
        return None if self.excluded_account is None else label_text(self.excluded_account)

    @property
    def reclass_targets(self) -> dict[tuple[str, str], str]:
        """(account, code) -> account. The first rule for a pair wins."""
        targets: dict[tuple[str, str], str] = {}
        for rule in self.reclass:
            targets.setdefault(
                (label_text(rule.account), label_text(rule.sub_code)), label_text(rule.to_account)
            )
        return targets

    @property
    def unlisted_rank(self) -> int:
        """Rank shared by expense accounts outside the list: 98, or the one after the longest
        list if that has 98 accounts or more."""
        return max(98, len(self.revenue_labels) + 1, len(self.expense_labels) + 1)

    @property
    def total_rank(self) -> int:
        return self.unlisted_rank + 1

    @property
    def surplus_excluding_label(self) -> str:
        return f"{self.surplus_label} EXCLUDING {self.excluded_label}"

    @property
    def forecast_month(self) -> int | None:
        """Number of the only month that may be forecast: the one before ``as_of``.

        None outside the report year, and for January, which has no month before it here.
        """
        year, month = self.as_of.year, self.as_of.month - 1
        if month == 0:
            year, month = year - 1, 12
        return month if year == self.year and month > 1 else None
