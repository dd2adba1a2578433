"""One query per operator and report, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import CONFIG, item_ledger, ledger, table
from ledgerloom.config import BRL, BRL_INNER, BRL_POINT, MONEY, RAW, label_text
from ledgerloom.functions.dates import (
    day_text,
    month_before,
    month_from_key,
    month_from_parts,
    month_key,
    month_label,
    month_start,
)
from ledgerloom.functions.money import (
    format_money,
    format_money_columns,
    money_reject_samples,
    money_rejects,
    parse_money_columns,
    sign_class,
)
from ledgerloom.functions.text import label_key
from ledgerloom.operators.audit import Audit
from ledgerloom.operators.cells import (
    carry_previous,
    densify,
    month_account_grid,
    month_sums,
    previous_month,
    year_kind_filter,
)
from ledgerloom.operators.matrix import (
    FORECAST_MARK,
    any_value,
    grand_total,
    matrix_text,
    month_pivot,
    ordered,
    ranked,
    row_total,
)
from ledgerloom.plans.delivery import deliver_report, publish_report, read_published
from ledgerloom.plans.registry import NamedQuery, default_registry
from ledgerloom.plans.reports import (
    expense_matrix,
    report_bundle,
    revenue_matrix,
    surplus,
    surplus_table,
)
from ledgerloom.plans.sql_reports import sql_queries
from ledgerloom.plans.stored import store_matrix, stored_surplus
from ledgerloom.session import scratch_folder
from ledgerloom.sources.cells import CellStore, month_cells
from ledgerloom.sources.ledger import read_stored_ledger, write_ledger
from ledgerloom.sources.sinks import document_lines, report_documents, write_report

Query = Callable[[SparkSession, str], DataFrame]

MONTHS = CONFIG.month_labels
UNIT = ["unit"]


def sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_sums(ledger(spark, sf_dir, keyed=True), CONFIG, CONFIG.revenue_kind, UNIT)


def units(cells: DataFrame) -> DataFrame:
    """Entities with revenue in the year, from its sums."""
    return cells.select("unit").distinct()


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = sums(spark, sf_dir)
    return densify(month_account_grid(units(cells), CONFIG), cells, UNIT)


def carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carry_previous(dense(spark, sf_dir), CONFIG, UNIT)


def money_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order total written in a style that its priority chooses: forecast mark, no-break
    space, leading minus, accounting negative, no number at all."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    text = format_money(amount)
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(priority == "1-URGENT", F.concat(text, F.lit(FORECAST_MARK)))
        .when(priority == "2-HIGH", F.translate(text, " ", "\u00a0"))
        .when(priority == "3-MEDIUM", format_money(-amount, BRL_INNER))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("("), text, F.lit(")")))
        .otherwise(F.concat(F.lit("n/a "), F.col("o_orderstatus")))
        .alias("price_text"),
        F.when(F.col("o_orderstatus") == "F", format_money(-amount))
        .when(F.col("o_orderstatus") == "O", text)
        .otherwise(F.when(priority != "5-LOW", ""))
        .alias("status_text"),
    )


def q_year_kind_filter(spark, sf_dir):
    return year_kind_filter(ledger(spark, sf_dir), CONFIG.year, [CONFIG.expense_kind])


def q_reclassified_month_sum(spark, sf_dir):
    return month_sums(ledger(spark, sf_dir), CONFIG, CONFIG.revenue_kind).select(
        "account", month_key(F.col("month")).alias("month"), "amount"
    )


def q_month_account_grid(spark, sf_dir):
    grid = month_account_grid(units(sums(spark, sf_dir)), CONFIG)
    key = month_key(F.col("month"))
    return grid.select(
        "unit",
        "account",
        month_from_key(key).alias("month"),
        month_from_parts(key).alias("month_again"),
    )


def q_densified_cells(spark, sf_dir):
    return dense(spark, sf_dir)


def q_previous_month_value(spark, sf_dir):
    return previous_month(dense(spark, sf_dir), UNIT)


def q_carried_cells(spark, sf_dir):
    return carried(spark, sf_dir)


def q_revenue_pivot(spark, sf_dir):
    cells = carried(spark, sf_dir).where(F.col("amount").isNotNull())
    return month_pivot(
        cells.withColumn("month", F.month("month")), [*UNIT, "account"], MONTHS
    ).select(*UNIT, "account", *[F.col(m).cast(MONEY).alias(m) for m in MONTHS])


def q_forecast_text_pivot(spark, sf_dir):
    cells = carried(spark, sf_dir).where(F.col("amount").isNotNull())
    mark = F.when(F.col("is_forecast"), FORECAST_MARK).otherwise("")
    text = F.concat(format_money(F.col("amount")), mark)
    return month_pivot(
        cells.select(*UNIT, "account", F.month("month").alias("month"), text.alias("text")),
        [*UNIT, "account"],
        MONTHS,
        F.max("text"),
    )


def _sub_code_pivot(spark, sf_dir, year):
    postings = year_kind_filter(ledger(spark, sf_dir), year, [CONFIG.expense_kind])
    return month_pivot(
        postings.select("sub_code", F.month("entry_date").alias("month"), "amount"),
        ["sub_code"],
        MONTHS,
    )


def q_row_totals(spark, sf_dir):
    months = [F.col(m) for m in MONTHS]
    return _sub_code_pivot(spark, sf_dir, CONFIG.year).select(
        "sub_code", row_total(months).cast(MONEY).alias("total"), any_value(months).alias("any_value")
    )


def _grand_total(spark, sf_dir, year):
    matrix = _sub_code_pivot(spark, sf_dir, year)
    matrix = matrix.withColumn("total", row_total([F.col(m) for m in MONTHS]))
    return grand_total(matrix, [*MONTHS, "total"]).withColumn("label", F.lit(CONFIG.total_label))


def q_grand_total_row(spark, sf_dir):
    return _grand_total(spark, sf_dir, CONFIG.year)


def q_empty_grand_total(spark, sf_dir):
    """A year the ledger has no postings in."""
    return _grand_total(spark, sf_dir, 1990)


def q_ranked_accounts(spark, sf_dir):
    accounts = (
        ledger(spark, sf_dir)
        .where(F.col("kind") == "EXPENSE")
        .groupBy(label_key(F.col("account")).alias("label"))
        .agg(F.sum("amount").cast(MONEY).alias("amount"))
    )
    return ordered(ranked(accounts, "label", CONFIG.expense_labels, CONFIG.unlisted_rank))


def q_month_labels(spark, sf_dir):
    day = F.col("entry_date")
    return (
        ledger(spark, sf_dir)
        .groupBy(month_start(day).alias("month"))
        .agg(F.count("*").alias("n_postings"), F.max("entry_date").alias("last_day"))
        .select(
            "month",
            F.year("month").alias("year"),
            month_key(F.col("month")).alias("month_key"),
            F.date_format("month", "yyyyMM").alias("month_number_text"),
            month_label(F.col("month"), MONTHS).alias("month_label"),
            month_before(F.col("last_day")).alias("month_before"),
            day_text(F.col("last_day")).alias("last_day_text"),
            "n_postings",
        )
    )


def q_revenue_matrix(spark, sf_dir):
    return ordered(revenue_matrix(ledger(spark, sf_dir), CONFIG))


def q_revenue_matrix_text(spark, sf_dir):
    return matrix_text(ordered(revenue_matrix(ledger(spark, sf_dir), CONFIG)), CONFIG)


def q_expense_matrix(spark, sf_dir):
    return ordered(expense_matrix(ledger(spark, sf_dir), CONFIG))


def q_expense_matrix_text(spark, sf_dir):
    return matrix_text(ordered(expense_matrix(ledger(spark, sf_dir), CONFIG)), CONFIG)


def q_surplus_row(spark, sf_dir):
    return surplus_table(ledger(spark, sf_dir), replace(CONFIG, excluded_account=None))


def q_surplus_excluding_account(spark, sf_dir):
    both = surplus_table(ledger(spark, sf_dir), CONFIG)
    return both.where(F.col("label") == CONFIG.surplus_excluding_label)


def q_surplus_excluding_missing_account(spark, sf_dir):
    return surplus_table(ledger(spark, sf_dir), replace(CONFIG, excluded_account="no such account"))


def q_surplus_of_written_matrices(spark, sf_dir):
    """Both matrices written first, the differences made from what was written."""
    folder = scratch_folder(spark)
    write_report(report_bundle(ledger(spark, sf_dir), CONFIG), CONFIG, folder)
    written = spark.read.parquet(folder)
    revenue, expense = (written.where(F.col("section") == s) for s in ("revenue", "expense"))
    return surplus(revenue, expense, CONFIG)


def q_subcent_expense_matrix(spark, sf_dir):
    """Amounts of four decimals, rounded to cents after all sums."""
    price, discount = (F.col(c).cast("decimal(12,2)") for c in ("l_extendedprice", "l_discount"))
    brand = F.concat(F.lit("Brand#"), F.col("l_partkey") % 20)
    postings = item_ledger(spark, sf_dir, brand, price * (1 - discount))
    return ordered(expense_matrix(postings, CONFIG))


def q_long_section_documents(spark, sf_dir):
    """One account per line item: a section of as many lines as the year has items."""
    item = F.concat_ws("-", F.lit("item"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    postings = item_ledger(spark, sf_dir, item, F.col("l_extendedprice").cast("decimal(12,2)"))
    return report_documents(report_bundle(postings, CONFIG), CONFIG)


def q_surplus_missing_as_zero(spark, sf_dir):
    cfg = replace(CONFIG, missing_as_zero=True)
    return surplus_table(ledger(spark, sf_dir), cfg)


def q_surplus_table(spark, sf_dir):
    return surplus_table(ledger(spark, sf_dir), CONFIG)


def q_surplus_table_text(spark, sf_dir):
    table_ = surplus_table(ledger(spark, sf_dir), CONFIG)
    return format_money_columns(table_, [*MONTHS, "total"], CONFIG.surplus_money)


def q_keyed_revenue_matrix(spark, sf_dir):
    return ordered(revenue_matrix(ledger(spark, sf_dir, keyed=True), CONFIG, UNIT), UNIT)


def q_keyed_expense_matrix(spark, sf_dir):
    return ordered(expense_matrix(ledger(spark, sf_dir, keyed=True), CONFIG, UNIT), UNIT)


def q_keyed_surplus(spark, sf_dir):
    return surplus_table(ledger(spark, sf_dir, keyed=True), CONFIG, UNIT)


def q_report_bundle(spark, sf_dir):
    return report_bundle(ledger(spark, sf_dir, keyed=True), CONFIG, UNIT)


def q_document_lines(spark, sf_dir):
    return document_lines(q_report_bundle(spark, sf_dir), CONFIG, UNIT)


def q_report_documents(spark, sf_dir):
    return report_documents(q_report_bundle(spark, sf_dir), CONFIG, UNIT)


def q_written_report_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark)
    bundle = report_bundle(ledger(spark, sf_dir, keyed=True), CONFIG, UNIT)
    write_report(bundle, CONFIG, folder)
    return spark.read.parquet(folder).where(F.col("report_year") == CONFIG.year).select(bundle.columns)


def q_delivered_documents(spark, sf_dir):
    """Tables written, documents made from them and written, both below the shared folder."""
    folder = scratch_folder(spark)
    postings = ledger(spark, sf_dir, keyed=True)
    _, documents = deliver_report(postings, CONFIG, folder, UNIT)
    return spark.read.parquet(documents).drop("report_year")


def q_money_format(spark, sf_dir):
    amount = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(
        F.col("l_extendedprice")
    )
    amount = F.when(F.col("l_returnflag") != "N", amount.cast("decimal(18,2)"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        format_money(amount, BRL).alias("outer_text"),
        format_money(amount, BRL_INNER).alias("inner_text"),
        format_money(amount, BRL_POINT).alias("point_text"),
    )


def q_money_parse(spark, sf_dir):
    return parse_money_columns(money_texts(spark, sf_dir), ["price_text", "status_text"])


def q_money_parse_rejects(spark, sf_dir):
    return money_rejects(
        money_texts(spark, sf_dir), ["price_text", "status_text"], ["o_orderpriority"]
    )


def q_sign_class(spark, sf_dir):
    rows = q_keyed_surplus(spark, sf_dir)
    return rows.select(
        "unit", "label", *[sign_class(F.col(m)).alias(m) for m in [*MONTHS, "total"]]
    )


def q_case_insensitive_accounts(spark, sf_dir):
    """The same ledger with kinds and labels in changing case and with trailing spaces."""
    urgent = F.col("sub_code").isin("1-URGENT", "TYPE_1")
    written = ledger(spark, sf_dir).withColumns({
        "kind": F.when(urgent, F.lower("kind")).otherwise(F.concat(F.upper("kind"), F.lit(" "))),
        "account": F.when(urgent, F.concat(F.lower("account"), F.lit("  "))).otherwise(
            F.initcap("account")
        ),
        "sub_code": F.concat(F.lower("sub_code"), F.lit(" ")),
    })
    return month_sums(written, CONFIG, "revenue")


def q_named_query(spark, sf_dir):
    return default_registry().run("revenue", ledger(spark, sf_dir), CONFIG)


def q_named_expense_query(spark, sf_dir):
    return default_registry().run("expense", ledger(spark, sf_dir), CONFIG)


def q_named_surplus_query(spark, sf_dir):
    return default_registry().run("surplus", ledger(spark, sf_dir, keyed=True), CONFIG, UNIT)


def q_named_sql_query(spark, sf_dir):
    registry = default_registry()
    registry["expense codes"] = NamedQuery.from_sql(
        "Expense by code",
        """
        WITH chosen AS (
            SELECT sub_code, amount FROM {ledger}
            WHERE entry_date >= :first_day AND entry_date < :next_first_day AND upper(kind) = :kind
        )
        SELECT sub_code, CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM chosen GROUP BY sub_code
        """,
        kind=label_text(CONFIG.expense_kind),
    )
    return registry.run("expense codes", ledger(spark, sf_dir), CONFIG)


def q_sql_revenue_matrix_text(spark, sf_dir):
    """The revenue matrix as SQL text over the library's functions."""
    return sql_queries(CONFIG)["revenue"].build(ledger(spark, sf_dir), CONFIG, [])


def q_sql_keyed_revenue_text(spark, sf_dir):
    return sql_queries(CONFIG, UNIT)["revenue"].build(ledger(spark, sf_dir, keyed=True), CONFIG, UNIT)


def q_sql_expense_matrix_text(spark, sf_dir):
    return sql_queries(CONFIG)["expense"].build(ledger(spark, sf_dir), CONFIG, [])


def q_sql_surplus_text(spark, sf_dir):
    return sql_queries(CONFIG)["surplus"].build(ledger(spark, sf_dir), CONFIG, [])


def q_sql_keyed_surplus_text(spark, sf_dir):
    return sql_queries(CONFIG, UNIT)["surplus"].build(ledger(spark, sf_dir, keyed=True), CONFIG, UNIT)


def q_sql_functions(spark, sf_dir):
    """Every SQL function over orders: texts of amounts, their values again, months, ranks."""
    registry = default_registry()
    registry["functions"] = NamedQuery.from_sql(
        "Functions",
        """
        SELECT o_orderkey, money_text(amount) AS outer_text, surplus_text(-amount) AS inner_text,
               money_value(money_text(-amount)) AS parsed, money_value(concat('(', money_text(amount), ')')) AS rejected,
               month_label(day) AS month_name, month_start(day) AS month, label_key(concat(lower(status), '  ')) AS label,
               revenue_rank(concat('NATION_', cust % 9)) AS revenue_rank, expense_rank(concat('BRAND#', cust % 20)) AS expense_rank,
               reclassified(concat('NATION_', cust % 9), concat(lower(priority), ' ')) AS account,
               may_forecast(concat('NATION_', cust % 9), day) AS may_forecast
        FROM (SELECT *, CAST(price AS DECIMAL(18,2)) AS amount FROM {ledger})
        """,
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    )
    return registry.run("functions", orders, CONFIG)


def q_late_postings_bundle(spark, sf_dir):
    """Cells of what was posted first, then late postings of four months added to them, twice sent."""
    postings = ledger(spark, sf_dir, keyed=True)
    late = F.month("entry_date").isin(1, 2, 6, 12) & F.col("sub_code").isin("1-URGENT", "5-LOW", "TYPE_1", "TYPE_3")
    store = CellStore(spark, scratch_folder(spark), UNIT)
    store.write(postings.where(~late))
    for _ in range(2):
        store.add(postings.where(late), "late postings")
    return report_bundle(store.read(CONFIG.year), CONFIG, UNIT)


def q_streamed_postings_bundle(spark, sf_dir):
    """Cells that start empty and get all postings as a stream of files."""
    folder = scratch_folder(spark)
    postings = ledger(spark, sf_dir, keyed=True).where(F.year("entry_date") == CONFIG.year)
    postings.repartition(2).write.parquet(f"{folder}/inbox")
    late = spark.readStream.schema(postings.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/inbox")
    store = CellStore(spark, f"{folder}/cells", UNIT)
    store.follow(late, "inbox", f"{folder}/progress").awaitTermination()
    return report_bundle(store.read(CONFIG.year), CONFIG, UNIT)


def q_rebuilt_months_bundle(spark, sf_dir):
    """Cells of wrong amounts in two months, which are then summed again."""
    postings = ledger(spark, sf_dir, keyed=True)
    wrong = F.when(F.month("entry_date").isin(3, 4), F.col("amount") * 2).otherwise(F.col("amount"))
    store = CellStore(spark, scratch_folder(spark), UNIT)
    store.write(postings.withColumn("amount", wrong.cast(RAW)))
    store.rebuild(postings, [date(CONFIG.year, 3, 1), date(CONFIG.year, 4, 1)])
    return report_bundle(store.read(CONFIG.year), CONFIG, UNIT)


def q_month_cells(spark, sf_dir):
    """All cells of the ledger, in every year."""
    return month_cells(ledger(spark, sf_dir, keyed=True), UNIT).withColumn("amount", F.col("amount").cast(MONEY))


def q_published_report(spark, sf_dir):
    """A report published over one of other settings; read as its readers do."""
    folder = scratch_folder(spark)
    postings = ledger(spark, sf_dir, keyed=True)
    publish_report(postings, replace(CONFIG, excluded_account=None), folder, UNIT)
    publish_report(postings, CONFIG, folder, UNIT)
    tables, _ = read_published(spark, CONFIG, folder)
    return tables.select("unit", "section", "row_type", "label", "rank", *MONTHS, "total", "forecast_month")


def q_money_reject_samples(spark, sf_dir):
    return money_reject_samples(money_texts(spark, sf_dir), ["price_text", "status_text"], ["o_orderpriority"], k=4)


def q_stored_surplus(spark, sf_dir):
    """Keyed matrices stored in buckets, and their differences."""
    folder = scratch_folder(spark)
    postings = ledger(spark, sf_dir, keyed=True)
    names = {kind: f"{kind}_{folder.rsplit('/', 1)[-1]}" for kind in ("revenue", "expense")}
    for kind, matrix in (("revenue", revenue_matrix), ("expense", expense_matrix)):
        store_matrix(matrix(postings, CONFIG, UNIT), names[kind], UNIT, 4, f"{folder}/{kind}")
    return stored_surplus(spark, names["revenue"], names["expense"], CONFIG, UNIT)


def q_left_out(spark, sf_dir):
    """What the report of all entities left out, observed while it was written."""
    audit = Audit(ledger(spark, sf_dir, keyed=True), CONFIG)
    write_report(report_bundle(audit.ledger, CONFIG, UNIT), CONFIG, scratch_folder(spark))
    return spark.createDataFrame(audit.rows(), f"reason string, n_postings long, n_amounts long, amount {RAW}")


def q_stored_ledger_bundle(spark, sf_dir):
    """The report on a ledger written with its kinds in plain form."""
    folder = scratch_folder(spark)
    write_ledger(ledger(spark, sf_dir, keyed=True), folder, by_year=True)
    return report_bundle(read_stored_ledger(spark, folder, UNIT, CONFIG.year), CONFIG, UNIT)


QUERIES: dict[str, Query] = {
    name[2:]: query for name, query in list(globals().items()) if name.startswith("q_")
}
