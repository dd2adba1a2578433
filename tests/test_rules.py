"""One test per report rule, on a handful of postings."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from conftest import as_dicts

from ledgerloom import Reclass, ReportConfig, expense_matrix, revenue_matrix, surplus, surplus_table
from ledgerloom.config import MONTH_LABELS
from ledgerloom.operators.cells import carry_previous, densify, month_account_grid, month_sums
from ledgerloom.operators.matrix import matrix_text, month_pivot, ordered
from ledgerloom.plans.registry import default_registry

CFG = ReportConfig(
    year=2001,
    as_of=date(2001, 9, 15),
    revenue_accounts=("A", "B", "Excluded"),
    expense_accounts=("E1", "E2"),
    excluded_account="Excluded",
)
JUN, JUL, AUG, SEP = "jun", "jul", "ago", "set"


def rev(month, account, amount, code="c"):
    return (month, "Revenue", account, code, amount)


def exp(month, account, amount):
    return (month, "EXPENSE", account, "c", amount)


def by_label(df):
    return {row["label"]: row for row in as_dicts(df)}


def test_forecast_of_the_month_before_as_of(make_ledger):
    rows = by_label(revenue_matrix(make_ledger([rev(7, "A", 10)]), CFG))
    assert rows["A"][AUG] == 10 and rows["A"]["forecast_month"] == 8
    assert rows["A"]["total"] == 20
    assert rows["TOTAL"][AUG] == 10 and rows["TOTAL"]["total"] == 20
    assert rows["TOTAL"]["forecast_month"] is None


def test_exempt_account_is_not_forecast(make_ledger):
    cfg = replace(CFG, forecast_exempt=("a ",))
    rows = by_label(revenue_matrix(make_ledger([rev(7, "A", 10)]), cfg))
    assert rows["A"][AUG] is None and rows["A"]["forecast_month"] is None


def test_only_one_month_back_is_carried(make_ledger):
    cfg = replace(CFG, as_of=date(2001, 10, 1))
    rows = by_label(revenue_matrix(make_ledger([rev(7, "A", 10)]), cfg))
    assert rows["A"][AUG] is None and rows["A"][SEP] is None


def test_forecasts_do_not_chain(make_ledger):
    rows = by_label(revenue_matrix(make_ledger([rev(6, "A", 10)]), CFG))
    assert rows["A"][JUL] is None and rows["A"][AUG] is None


def test_actual_zero_is_kept(make_ledger):
    rows = by_label(revenue_matrix(make_ledger([rev(7, "A", 10), rev(8, "A", 0)]), CFG))
    assert rows["A"][AUG] == 0 and rows["A"]["forecast_month"] is None


@pytest.mark.parametrize(
    "as_of, month",
    [
        (date(2001, 1, 31), None),
        (date(2001, 2, 1), None),
        (date(2001, 3, 31), 2),
        (date(2001, 12, 31), 11),
        (date(2002, 1, 1), 12),
        (date(2002, 2, 1), None),
        (date(2000, 9, 1), None),
    ],
)
def test_forecast_span(make_ledger, as_of, month):
    cfg = replace(CFG, as_of=as_of)
    assert cfg.forecast_month == month
    postings = make_ledger([rev(m, "A", m) for m in (1, 11)])
    wide = by_label(revenue_matrix(postings, cfg))["A"]
    assert wide["forecast_month"] == (month if month in (2, 12) else None)
    sums = month_sums(postings, cfg, "revenue")
    grid = month_account_grid(postings.sparkSession.range(1).select(), cfg)
    long = as_dicts(carry_previous(densify(grid, sums), cfg))
    assert [c["month"].month for c in long if c["is_forecast"]] == (
        [month] if month in (2, 12) else []
    )


def test_listed_account_without_postings_is_absent(make_ledger):
    assert set(by_label(revenue_matrix(make_ledger([rev(1, "A", 1)]), CFG))) == {"A", "TOTAL"}
    # only NULL amounts count as no value for revenue
    assert set(by_label(revenue_matrix(make_ledger([rev(1, "A", None)]), CFG))) == {"TOTAL"}


def test_unlisted_accounts(make_ledger):
    rows = by_label(revenue_matrix(make_ledger([rev(1, "A", 1), rev(1, "Other", 5)]), CFG))
    assert set(rows) == {"A", "TOTAL"} and rows["TOTAL"]["total"] == 1
    rows = by_label(expense_matrix(make_ledger([exp(1, "E2", 1), exp(1, "Other", 5)]), CFG))
    assert rows["OTHER"]["rank"] == 98 and rows["E2"]["rank"] == 2
    assert rows["TOTAL"]["total"] == 6 and rows["TOTAL"]["rank"] == 99


def test_expense_account_of_null_amounts_stays(make_ledger):
    rows = by_label(expense_matrix(make_ledger([exp(1, "E1", None), exp(2, "E2", 5)]), CFG))
    assert [rows["E1"][m] for m in MONTH_LABELS] == [None] * 12
    assert rows["E1"]["total"] == 0


def test_expense_without_account_stays(make_ledger):
    rows = by_label(expense_matrix(make_ledger([exp(1, None, 4)]), CFG))
    assert rows[None]["total"] == 4 and rows[None]["rank"] == 98


def test_expense_is_not_forecast_nor_reclassified(make_ledger):
    cfg = replace(CFG, reclass=(Reclass("E1", "c", "E2"),))
    postings = make_ledger([exp(7, "E1", 3), rev(7, "A", 1)])
    assert set(by_label(expense_matrix(postings, cfg))) == {"E1", "TOTAL"}
    assert by_label(expense_matrix(postings, cfg))["E1"][AUG] is None
    rows = as_dicts(surplus_table(postings, cfg))
    assert rows[0][JUL] == -2 and rows[0][AUG] is None


def test_surplus_month_missing_on_one_side(make_ledger):
    row = by_label(surplus_table(make_ledger([rev(1, "A", 9), exp(1, "E1", 4), exp(9, "E1", 5)]), CFG))
    assert row["SURPLUS"]["jan"] == 5 and row["SURPLUS"][SEP] is None
    assert row["SURPLUS"]["total"] == 5


def test_surplus_of_nothing(make_ledger):
    rows = as_dicts(surplus_table(make_ledger([]), CFG))
    assert [r["label"] for r in rows] == ["SURPLUS", "SURPLUS EXCLUDING EXCLUDED"]
    for row in rows:
        assert [row[m] for m in MONTH_LABELS] == [None] * 12 and row["total"] == 0


def test_surplus_without_the_excluded_account(make_ledger):
    postings = make_ledger([
        rev(1, "A", 10), rev(1, "Excluded", 2), exp(1, "E1", 3), rev(3, "A", 8), exp(3, "E1", 3),
    ])
    for rows in (
        by_label(surplus_table(postings, CFG)),
        by_label(surplus(revenue_matrix(postings, CFG), expense_matrix(postings, CFG), CFG)),
    ):
        assert rows["SURPLUS"]["mar"] == 5
        reduced = rows["SURPLUS EXCLUDING EXCLUDED"]
        assert reduced["jan"] == 7 and reduced["mar"] is None and reduced["total"] == 7
    zero = by_label(surplus_table(postings, replace(CFG, missing_as_zero=True)))
    assert zero["SURPLUS EXCLUDING EXCLUDED"]["mar"] == 5


def test_excluded_account_without_a_row(make_ledger):
    postings = make_ledger([rev(1, "A", 10), exp(1, "E1", 3)])
    row = by_label(surplus_table(postings, CFG))["SURPLUS EXCLUDING EXCLUDED"]
    assert [row[m] for m in MONTH_LABELS] == [None] * 12 and row["total"] == 0


def test_total_of_no_revenue(make_ledger):
    rows = as_dicts(revenue_matrix(make_ledger([exp(1, "E1", 1), rev(1, "Other", 1)]), CFG))
    assert len(rows) == 1 and rows[0]["row_type"] == "total"
    assert [rows[0][m] for m in [*MONTH_LABELS, "total"]] == [None] * 13


def test_account_named_like_the_total(make_ledger):
    postings = make_ledger([exp(1, "Total", 4), exp(1, "E1", 1), rev(1, "A", 10)])
    rows = [r for r in as_dicts(expense_matrix(postings, CFG)) if r["label"] == "TOTAL"]
    assert sorted((r["row_type"], r["total"]) for r in rows) == [("detail", 4), ("total", 5)]
    both = surplus(revenue_matrix(postings, CFG), expense_matrix(postings, CFG), CFG)
    assert by_label(both)["SURPLUS"]["jan"] == 5


def test_labels_compare_without_case_and_trailing_spaces(make_ledger):
    postings = make_ledger([
        (1, "revenue", "a", "c", 1), (1, "REVENUE ", "A  ", "c", 2), (1, "Revenue", "A", "c", 4),
    ])
    rows = by_label(revenue_matrix(postings, CFG))
    assert set(rows) == {"A", "TOTAL"} and rows["A"]["jan"] == 7


def test_accents_are_kept_apart(make_ledger):
    rows = by_label(expense_matrix(make_ledger([exp(1, "órgão", 1), exp(1, "orgao", 2)]), CFG))
    assert rows["ÓRGÃO"]["jan"] == 1 and rows["ORGAO"]["jan"] == 2


def test_reclass_first_rule_wins(make_ledger):
    cfg = replace(CFG, reclass=(Reclass("a", "X.1", "B"), Reclass("A", "x.1 ", "Excluded")))
    postings = make_ledger([rev(1, "A", 3, "x.1"), rev(1, "A", 5, "other"), rev(1, "A", 7, None)])
    rows = by_label(revenue_matrix(postings, cfg))
    assert rows["B"]["jan"] == 3 and rows["A"]["jan"] == 12 and "EXCLUDED" not in rows


def test_reclass_into_the_list_from_outside(make_ledger):
    cfg = replace(CFG, reclass=(Reclass("Other", "c", "B"),))
    assert by_label(revenue_matrix(make_ledger([rev(1, "Other", 3)]), cfg))["B"]["jan"] == 3


def test_display_order(make_ledger):
    postings = make_ledger([exp(1, a, 1) for a in ("zeta", "alpha", "E2", "E1", "mid")])
    labels = [r["label"] for r in as_dicts(ordered(expense_matrix(postings, CFG)))]
    assert labels == ["E1", "E2", "ALPHA", "MID", "ZETA", "TOTAL"]


def test_other_years_are_left_out(make_ledger):
    postings = make_ledger([exp(1, "E1", 1)])
    other = postings.selectExpr(
        "explode(array(date'2000-12-31', date'2001-12-31', date'2002-01-01')) AS entry_date",
        "kind", "account", "sub_code", "amount",
    )
    row = by_label(expense_matrix(other, CFG))["E1"]
    assert row["dez"] == 1 and row["total"] == 1


def test_null_month_keeps_its_group(spark):
    cells = spark.createDataFrame(
        [("a", None, Decimal(5)), ("b", 2, Decimal(3))], "account string, month int, amount decimal(18,2)"
    )
    rows = {r["account"]: r for r in as_dicts(month_pivot(cells, ["account"], MONTH_LABELS))}
    assert all(rows["a"][m] is None for m in MONTH_LABELS) and rows["b"]["fev"] == 3


def test_text_matrix_marks_forecasts_only_in_detail(make_ledger):
    postings = make_ledger([rev(7, "A", "1234.5"), rev(8, "B", "-5.1")])
    rows = by_label(matrix_text(revenue_matrix(postings, CFG), CFG))
    assert rows["A"][AUG] == "R$ 1.234,50 (P)" and rows["A"][JUL] == "R$ 1.234,50"
    assert rows["A"]["jan"] is None and rows["A"]["total"] == "R$ 2.469,00"
    assert rows["B"][AUG] == "-R$ 5,10"
    assert rows["TOTAL"][AUG] == "R$ 1.229,40"


def test_registry(make_ledger):
    registry = default_registry()
    shown = registry.run("revenue", make_ledger([rev(1, "B", 1), rev(1, "A", 2)]), CFG)
    assert shown.columns == ["label", *MONTH_LABELS, "total"]
    assert [r["label"] for r in as_dicts(shown)] == ["A", "B", "TOTAL"]
    assert registry["expense"].title == "Expense by month"
    with pytest.raises(KeyError, match="no query 'profit'"):
        registry.run("profit", make_ledger([]), CFG)


def test_entity_keys_named_like_report_columns(make_ledger):
    for name in ("Section", "jan", "amount"):
        with pytest.raises(ValueError, match="rename these entity keys"):
            revenue_matrix(make_ledger([]), CFG, [name])


def test_config_checks():
    with pytest.raises(ValueError):
        replace(CFG, month_labels=("jan",) * 12)
    many = tuple(f"E{i}" for i in range(150))
    cfg = replace(CFG, expense_accounts=many)
    assert cfg.unlisted_rank == 151 and cfg.total_rank == 152
