"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import (
    Reclass,
    ReportConfig,
    expense_matrix,
    report_bundle,
    revenue_matrix,
    surplus,
    surplus_table,
)
from ledgerloom.functions.money import format_money, parse_money
from checks.queries import QUERIES
from ledgerloom.operators.cells import densify, month_account_grid, month_sums
from ledgerloom.operators.lookup import lookup
from ledgerloom.sources.ledger import read_ledger
from ledgerloom.sources.sinks import in_reading_order, report_documents

CFG = ReportConfig(
    year=2001,
    as_of=date(2001, 9, 15),
    revenue_accounts=("A0", "A1", "A2"),
    expense_accounts=("B0", "B1"),
    reclass=(Reclass("A1", "c1", "A2"),),
    excluded_account="A2",
)
UNIT = ["unit"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ledger") / "postings")
    n = F.col("id")
    revenue = n % 2 == 0
    spark.range(0, 20_000, 1, 4).select(
        F.date_add(F.lit(date(2000, 6, 1)), (n % 700).cast("int")).alias("entry_date"),
        F.when(revenue, "Revenue").otherwise("Expense").alias("kind"),
        F.concat(F.when(revenue, "A").otherwise("B"), (n % 7).cast("string")).alias("account"),
        F.concat(F.lit("c"), (n % 3).cast("string")).alias("sub_code"),
        (n % 1000).cast("decimal(18,2)").alias("amount"),
        F.concat(F.lit("u"), (n % 5).cast("string")).alias("unit"),
        F.lit("never read").alias("remark"),
    ).write.parquet(path)
    return path


def run_plan(df) -> str:
    """The plan as it really ran, reuse and adaptive changes included."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


REPORTS = {
    "revenue": revenue_matrix,
    "expense": expense_matrix,
    "surplus": surplus_table,
    "bundle": report_bundle,
    "documents": lambda ledger, cfg, keys: report_documents(report_bundle(ledger, cfg, keys), cfg, keys),
}


@pytest.mark.parametrize("keys", [[], UNIT], ids=["one", "keyed"])
@pytest.mark.parametrize("name", REPORTS)
def test_one_scan_of_the_year(spark, stored, name, keys):
    plan = run_plan(REPORTS[name](read_ledger(spark, stored, keys=UNIT), CFG, keys))
    scans = re.findall(r"FileScan parquet \[(.*?)\].*?PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert len(scans) == 1
    columns, pushed = scans[0]
    assert "remark" not in columns
    assert ("unit" in columns) == bool(keys)
    assert ("sub_code" in columns) == (name != "expense")
    assert "GreaterThanOrEqual(entry_date,2001-01-01)" in pushed
    assert "LessThan(entry_date,2002-01-01)" in pushed
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert node not in plan
    if keys:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("keys", [[], UNIT], ids=["one", "keyed"])
@pytest.mark.parametrize("name", REPORTS)
def test_one_scan_in_the_static_plan(spark, stored, name, keys):
    """Adaptive execution leaves branches it dropped out of its final plan, scans and all; the
    static plan shows every branch."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = REPORTS[name](read_ledger(spark, stored, keys=UNIT), CFG, keys)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") == 1


def test_surplus_of_matrices_scans_once_per_kind(spark, stored):
    ledger = read_ledger(spark, stored, keys=UNIT)
    plan = run_plan(
        surplus(revenue_matrix(ledger, CFG, UNIT), expense_matrix(ledger, CFG, UNIT), CFG, UNIT)
    )
    assert plan.count("FileScan") == 2


def test_postings_are_aggregated_before_they_move(spark, stored):
    plan = run_plan(report_bundle(read_ledger(spark, stored, keys=UNIT), CFG, UNIT))
    below_scan = plan[: plan.index("FileScan")]
    first_exchange = below_scan[below_scan.rindex("Exchange hashpartitioning"):]
    assert "partial_sum(amount" in first_exchange


def test_grid_is_built_in_place(spark, stored):
    ledger = read_ledger(spark, stored, keys=UNIT)
    grid = month_account_grid(ledger.select("unit").distinct(), CFG)
    plan = run_plan(densify(grid, month_sums(ledger, CFG, "revenue", UNIT), UNIT))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_money_is_codegen_only(spark, stored):
    text = format_money(F.col("amount"))
    plan = run_plan(spark.read.parquet(stored).select(text.alias("t"), parse_money(text).alias("v")))
    assert "Python" not in plan and re.search(r"\*\(\d+\) Project", plan)


@pytest.mark.parametrize("entries", [1, 1000])
def test_settings_move_no_rows(spark, stored, entries):
    rules = tuple(Reclass(f"A{i % 7}", f"c{i}", f"A{(i + 1) % 3}") for i in range(entries))
    ledger = read_ledger(spark, stored, keys=UNIT)
    cfg = replace(CFG, reclass=rules)
    plan = run_plan(revenue_matrix(ledger, cfg, UNIT))
    assert "Join" not in plan and plan.count("FileScan") == 1
    below_scan = plan[: plan.index("FileScan")]
    assert "partial_sum(amount" in below_scan[below_scan.rindex("Exchange hashpartitioning"):]
    targets = cfg.reclass_targets
    moved: dict[str, Decimal] = {}
    for r in ledger.where("kind = 'Revenue' AND year(entry_date) = 2001").collect():
        account = targets.get((r.account, r.sub_code.upper()), r.account)
        moved[account] = moved.get(account, Decimal(0)) + r.amount
    got = {}
    for r in revenue_matrix(ledger, replace(cfg, as_of=date(2003, 1, 1))).where("row_type = 'detail'").collect():
        got[r.label] = r.total
    assert got == {a: t for a, t in moved.items() if a in ("A0", "A1", "A2")}


def test_lookup_of_missing_and_null_keys(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("b", "x")], "k string, l string")
    one = lookup(df, [F.col("k")], {("a",): 1, ("c",): 3}, "v", F.lit(-1))
    assert [r.v for r in one.collect()] == [1, 1, -1, -1]
    two = lookup(df, [F.col("k"), F.col("l")], {("a", "x"): 1}, "v", F.lit(-1))
    assert [r.v for r in two.collect()] == [1, -1, -1, -1]


def test_documents_have_one_plan_for_any_length(spark, stored, tmp_path):
    short = str(tmp_path / "short")
    spark.read.parquet(stored).limit(5).write.parquet(short)
    plans = []
    for path in (short, stored):
        ledger = read_ledger(spark, path, keys=UNIT)
        documents = in_reading_order(report_documents(report_bundle(ledger, CFG, UNIT), CFG, UNIT), UNIT)
        plan = documents._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "collect_list" not in plan
        plans.append(re.sub(r"#\d+L?", "", plan))
    assert plans[0] == plans[1]


LONG_FORM = ["month_account_grid", "densified_cells", "previous_month_value", "carried_cells", "revenue_pivot", "forecast_text_pivot"]


@pytest.mark.parametrize("name", LONG_FORM)
def test_long_form_reads_the_year_only(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = run_plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = re.findall(r"FileScan parquet \[[ol]_.*?PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert scans and all(re.search(r"GreaterThanOrEqual\([ol]_\w+date,2001-01-01", pushed) for pushed in scans)


@pytest.mark.parametrize("name", ["surplus_row", "surplus_excluding_account", "surplus_excluding_missing_account"])
def test_differences_read_each_table_once(spark, name):
    plan = run_plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan parquet [o_") == 1 and plan.count("FileScan parquet [l_") == 1


@pytest.mark.parametrize("folders", [{"year": "y"}, {"year": "y", "month": "m"}])
def test_year_and_month_folders_are_pruned(spark, stored, tmp_path, folders):
    path = str(tmp_path / "by_folder")
    parts = {"y": F.year("entry_date"), "m": F.month("entry_date")}
    spark.read.parquet(stored).withColumns({c: parts[c] for c in folders.values()}).write.partitionBy(*folders.values()).parquet(path)
    ledger = read_ledger(spark, path, keys=UNIT, year=2001, folders=folders)
    plan = run_plan(report_bundle(ledger, CFG, UNIT))
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert len(filters) == 1 and re.search(r"y#\d+ = 2001", filters[0])
    assert ("m#" in filters[0]) == ("month" in folders)
    whole = report_bundle(read_ledger(spark, stored, keys=UNIT), CFG, UNIT)
    assert sorted(map(str, report_bundle(ledger, CFG, UNIT).collect())) == sorted(map(str, whole.collect()))
    with pytest.raises(ValueError, match="year"):
        read_ledger(spark, path, folders=folders)
