"""Whole reports against plain Python, and laws that hold between them."""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import brute
import pytest
from conftest import as_dicts
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom import (
    Reclass,
    ReportConfig,
    expense_matrix,
    report_bundle,
    revenue_matrix,
    surplus,
    surplus_table,
)
from ledgerloom.config import MONTH_LABELS
from ledgerloom.operators.cells import carry_previous, densify, month_account_grid, month_sums
from ledgerloom.operators.matrix import month_pivot
from ledgerloom.sources.ledger import LEDGER_SCHEMA

UNIT = ["unit"]
SCHEMA = StructType([*LEDGER_SCHEMA.fields, StructField("unit", StringType())])
CFG = ReportConfig(
    year=2001,
    as_of=date(2001, 9, 15),
    revenue_accounts=tuple(f"Acc {i}" for i in range(8)),
    expense_accounts=tuple(f"Cost {i}" for i in range(5)),
    reclass=(Reclass("Acc 1", "4.1", "Acc 2"), Reclass("Acc 99", "4.2", "Acc 3")),
    forecast_exempt=("Acc 4",),
    excluded_account="Acc 2",
)


def random_rows(seed: int, count: int) -> list[tuple]:
    """Postings with a hot unit and account holding a third of all, NULL keys, labels of
    changing case, other kinds and other years."""
    pick = random.Random(seed)
    rows = []
    for _ in range(count):
        hot = pick.random() < 0.33
        kind = "Revenue" if hot else pick.choice(
            ["Revenue", "revenue ", "EXPENSE", "Expense", "EXPENSE", "Transfer", None]
        )
        prefix = "Acc" if kind and kind.lower().startswith("rev") else "Cost"
        account = f"{prefix} 0" if hot else pick.choice(
            [f"{prefix} {pick.randrange(12)}", f"{prefix.upper()} {pick.randrange(12)}  ", "Acc 99", None]
        )
        rows.append((
            None if pick.random() < 0.01 else date(2000, 10, 1) + timedelta(pick.randrange(560)),
            kind,
            account,
            pick.choice(["4.1", "4.2", "9", None]),
            None if pick.random() < 0.05 else Decimal(pick.randrange(-10**6, 10**8)).scaleb(-2),
            "hot" if hot else pick.choice(["u1", "u2", "u3", "u4", None]),
        ))
    # a unit with unlisted revenue only, one with expenses only, one outside the year
    rows += [
        (date(2001, 2, 1), "Revenue", "Stray", None, Decimal(5), "stray"),
        (date(2001, 2, 1), "Expense", "Cost 1", None, Decimal(5), "spender"),
        (date(1999, 2, 1), "Expense", "Cost 1", None, Decimal(5), "past"),
    ]
    return rows


def found(df, unit: str | None = "unit") -> dict[tuple, tuple]:
    result = {}
    for r in as_dicts(df):
        key = (r[unit] if unit else None, r["section"], r["row_type"], r["label"])
        assert key not in result
        result[key] = (r["rank"], [r[m] for m in MONTH_LABELS], r["total"], r["forecast_month"])
    return result


@pytest.fixture(scope="module")
def rows():
    return random_rows(7, 3000)


@pytest.fixture(scope="module")
def postings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


def test_keyed_bundle(rows, postings):
    expected = brute.bundle(rows, CFG)
    assert any(forecast for *_, forecast in expected.values())
    assert {k[0] for k in expected} >= {None, "hot", "stray", "spender"}
    assert found(report_bundle(postings, CFG, UNIT)) == expected


def test_single_entity_bundle(rows, postings):
    single = [(*r[:5], None) for r in rows]
    assert found(report_bundle(postings.drop("unit"), CFG), None) == brute.bundle(single, CFG)


@pytest.mark.parametrize("as_of", [date(2001, 2, 28), date(2001, 5, 31), date(2002, 1, 9)])
def test_other_clocks(spark, as_of):
    cfg = replace(CFG, as_of=as_of)
    rows = random_rows(as_of.month, 400)
    assert found(report_bundle(spark.createDataFrame(rows, SCHEMA), cfg, UNIT)) == brute.bundle(rows, cfg)


def test_single_reports_agree_with_the_bundle(postings):
    bundle = report_bundle(postings, CFG, UNIT).cache()

    def section(name, *columns):
        return bundle.where(F.col("section") == name).select(*columns)

    columns = [*UNIT, "row_type", "label", "rank", *MONTH_LABELS, "total", "forecast_month"]
    for name, build in (("revenue", revenue_matrix), ("expense", expense_matrix)):
        alone = Counter(map(str, build(postings, CFG, UNIT).select(columns).collect()))
        joint = Counter(map(str, section(name, *columns).collect()))
        # alone, a matrix knows only the entities with postings of its kind
        assert alone <= joint
        extra = joint - alone
        assert all("row_type='total'" in row and "total=None" in row for row in extra)
    columns = [*UNIT, "label", "rank", *MONTH_LABELS, "total"]
    joint = Counter(map(str, section("surplus", *columns).collect()))
    assert Counter(map(str, surplus_table(postings, CFG, UNIT).select(columns).collect())) == joint
    of_matrices = surplus(
        revenue_matrix(postings, CFG, UNIT), expense_matrix(postings, CFG, UNIT), CFG, UNIT
    )
    assert Counter(map(str, of_matrices.select(columns).collect())) == joint


def test_grid_and_lag_agree_with_the_pivoted_forecast(postings):
    units = postings.select("unit").distinct()
    grid = month_account_grid(units, CFG)
    assert grid.count() == units.count() * 8 * 12
    cells = carry_previous(densify(grid, month_sums(postings, CFG, "Revenue", UNIT), UNIT), CFG, UNIT)
    assert cells.count() == units.count() * 8 * 12
    known = cells.where(F.col("amount").isNotNull())
    long = month_pivot(known.withColumn("month", F.month("month")), ["unit", "account"], MONTH_LABELS)
    wide = revenue_matrix(postings, CFG, UNIT).where(F.col("row_type") == "detail")
    wide = wide.select("unit", F.col("label").alias("account"), *MONTH_LABELS)
    assert sorted(map(str, long.collect())) == sorted(map(str, wide.collect()))
    flagged = cells.where("is_forecast").count()
    assert flagged == revenue_matrix(postings, CFG, UNIT).where("forecast_month IS NOT NULL").count() > 0


def test_totals_add_up(postings):
    cfg = replace(CFG, as_of=date(2003, 1, 1))
    for build in (revenue_matrix, expense_matrix):
        matrix = build(postings, cfg, UNIT).cache()
        detail = matrix.where(F.col("row_type") == "detail").groupBy("unit")
        sums = {r["unit"]: r["s"] for r in detail.agg(F.sum("total").alias("s")).collect()}
        for row in as_dicts(matrix.where(F.col("row_type") == "total")):
            assert row["total"] == sums.get(row["unit"])
            months = [row[m] for m in MONTH_LABELS if row[m] is not None]
            assert (row["total"] or 0) == sum(months)
    # nothing forecast: the matrix total is the plain sum over listed accounts
    direct = postings.where(
        F.upper(F.trim("kind")).isin("EXPENSE") & (F.year("entry_date") == 2001)
    ).agg(F.sum("amount"))
    total = expense_matrix(postings, cfg).where(F.col("row_type") == "total").select("total")
    assert direct.first()[0] == total.first()[0]


def test_reduced_surplus_plus_excluded_account(postings):
    bundle = found(report_bundle(postings, CFG, UNIT))
    for unit in {k[0] for k in bundle}:
        plain = bundle[unit, "surplus", "detail", "SURPLUS"][1]
        less = bundle[unit, "surplus", "detail", "SURPLUS EXCLUDING ACC 2"][1]
        excluded = bundle.get((unit, "revenue", "detail", "ACC 2"), (0, [None] * 12))[1]
        for p, r, x in zip(plain, less, excluded):
            assert r is None or r + x == p


def test_partitioning_of_the_input_does_not_matter(postings):
    expected = found(report_bundle(postings, CFG, UNIT))
    for shuffled in (postings.coalesce(1), postings.repartition(17, "account"), postings.orderBy("amount")):
        assert found(report_bundle(shuffled, CFG, UNIT)) == expected


def test_two_keys(postings):
    by_code = postings.withColumn("branch", F.col("sub_code"))
    rows = report_bundle(by_code, CFG, ["unit", "branch"])
    assert rows.columns[:3] == ["unit", "branch", "section"]
    total = rows.where("section = 'expense' AND row_type = 'detail'").agg(F.sum("total")).first()[0]
    one = report_bundle(postings, CFG).where("section = 'expense' AND row_type = 'total'")
    assert total == one.first()["total"]


def test_many_listed_accounts_use_the_joined_lookup(spark):
    rows = random_rows(3, 600)
    cfg = replace(
        CFG,
        revenue_accounts=(*CFG.revenue_accounts, *(f"More {i}" for i in range(100))),
        reclass=(*CFG.reclass, *(Reclass(f"None {i}", "x", "Acc 1") for i in range(100))),
    )
    df = report_bundle(spark.createDataFrame(rows, SCHEMA), cfg, UNIT)
    assert found(df) == brute.bundle(rows, cfg)
