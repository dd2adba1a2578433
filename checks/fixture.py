"""Ledger and settings the checks run on, made from the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import Reclass, ReportConfig
from ledgerloom.sources.ledger import as_ledger

CONFIG = ReportConfig(
    year=2001,
    as_of=date(2001, 9, 15),
    revenue_accounts=(*(f"NATION_{i}" for i in range(6)), "INVESTMENT", "NATION_6"),
    expense_accounts=tuple(f"Brand#{i}" for i in range(1, 13)),
    reclass=(Reclass("NATION_6", "5-LOW", "INVESTMENT"),),
    forecast_exempt=("NATION_4",),
    excluded_account="INVESTMENT",
)


# Columns the checks use. Stating them spares a schema-reading job per table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Orders as revenue of the customer's nation, line items as postings of the part's brand:
    returned ones expenses, all others of a kind no report asks for. ``keyed`` adds the region of
    customer or supplier as ``unit``."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    revenue = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("kind", F.lit("Revenue"))
    )
    expense = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("kind", F.when(F.col("l_returnflag") == "R", "EXPENSE").otherwise("Open item"))
    )
    keys: tuple[str, ...] = ()
    if keyed:
        keys = ("unit",)
        revenue = revenue.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        expense = (
            expense.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )
    revenue_columns = {
        "entry_date": "o_orderdate", "account": "n_name", "sub_code": "o_orderpriority",
        "amount": "o_totalprice", "unit": "r_name",
    }
    expense_columns = {
        "entry_date": "l_shipdate", "account": "p_brand", "sub_code": "p_type",
        "amount": "l_extendedprice", "unit": "r_name",
    }
    return as_ledger(revenue, revenue_columns, keys).unionByName(
        as_ledger(expense, expense_columns, keys)
    )


def item_ledger(spark: SparkSession, sf_dir: str, account: Column, amount: Column) -> DataFrame:
    """Every line item as an expense, with an account and amount of choice."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("entry_date"), F.lit("Expense").alias("kind"), account.alias("account"),
        F.col("l_returnflag").alias("sub_code"), amount.alias("amount"),
    )
    return as_ledger(items)
