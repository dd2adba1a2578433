"""Stored cells, published reports, bucketed matrices, audits, and SQL functions."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom import MoneyStyle, NamedQuery, Reclass, ReportConfig, default_registry, expense_matrix, report_bundle, revenue_matrix, surplus
from ledgerloom.config import BRL, BRL_INNER, BRL_POINT
from ledgerloom.functions.money import WHITE_SPACE, format_money, money_reject_samples, parse_money
from ledgerloom.functions.sql import sql_functions
from ledgerloom.operators.audit import CLASSES, Audit
from ledgerloom.operators.lookup import lookup_value
from ledgerloom.plans import delivery
from ledgerloom.plans.delivery import publish_report, read_published
from ledgerloom.plans.sql_reports import sql_queries
from ledgerloom.plans.stored import store_matrix, stored_surplus
from ledgerloom.session import remove_scratch, scratch_folder
from ledgerloom.sources.cells import CellStore, month_cells, months_range
from ledgerloom.sources.ledger import LEDGER_SCHEMA, read_ledger, read_stored_ledger, write_ledger
from ledgerloom.sources.published import Published
from tests.test_plans import run_plan

CFG = ReportConfig(
    year=2001,
    as_of=date(2001, 9, 15),
    revenue_accounts=("A0", "A1", "A2"),
    expense_accounts=("B0", "B1"),
    reclass=(Reclass("A1", "c1", "A2"), Reclass("O'Brien \\ \"x\"", "ç", "A0")),
    forecast_exempt=("A0",),
    excluded_account="A2",
)
UNIT = ["unit"]


@pytest.fixture(scope="module")
def postings(spark):
    """Two and a half years, every kind of gap: unlisted accounts, other kinds, NULLs."""
    n = F.col("id")
    kind = F.when(n % 11 == 0, "open item").when(n % 13 == 0, F.lit(None)).when(n % 2 == 0, "Revenue ").otherwise("expense")
    return spark.range(0, 6000, 1, 4).select(
        F.when(n % 97 != 0, F.date_add(F.lit(date(2000, 6, 1)), (n % 900).cast("int"))).alias("entry_date"),
        kind.alias("kind"),
        F.when(n % 89 != 0, F.concat(F.when(n % 2 == 0, "a").otherwise("b"), (n % 5).cast("string"))).alias("account"),
        F.when(n % 83 != 0, F.concat(F.lit("c"), (n % 3).cast("string"))).alias("sub_code"),
        F.when(n % 79 != 0, (n % 1000 - 300).cast("decimal(20,4)") / 8).cast("decimal(26,8)").alias("amount"),
        F.when(n % 4 != 0, F.concat(F.lit("u"), (n % 4).cast("string"))).alias("unit"),
    ).cache()


def rows(df):
    return sorted(map(str, df.collect()))


def reports(ledger, keys=UNIT):
    return rows(report_bundle(ledger, CFG, keys))


@pytest.fixture
def whole_filters(spark):
    """Plans that show long filters as a whole."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


class TestCells:
    def test_cells_are_a_ledger(self, spark, postings, tmp_path):
        store = CellStore(spark, str(tmp_path), UNIT)
        assert store.read().collect() == [] and store.read(2001).collect() == []
        store.write(postings)
        assert reports(store.read()) == reports(store.read(2001)) == reports(postings)
        assert rows(month_cells(store.read(), UNIT)) == rows(month_cells(postings, UNIT))
        assert store.read().agg(F.sum("n_postings")).first()[0] == 6000

    @pytest.mark.parametrize("keys", [[], UNIT])
    def test_late_postings(self, spark, postings, tmp_path, keys):
        late = F.coalesce(F.month("entry_date").isin(2, 3) & (F.col("sub_code") == "c1"), F.col("account") == "a4", F.lit(True))
        store = CellStore(spark, str(tmp_path), keys)
        store.write(postings.where(~late))
        months = store.add(postings.where(late), "b1")
        assert "2001-02" in months and "none" in months
        assert store.add(postings.where(late), "b1") == []  # sent twice
        assert reports(store.read(2001), keys) == reports(postings, keys)
        assert rows(month_cells(store.read(), keys)) == rows(month_cells(postings, keys))

    def test_nothing_late(self, spark, postings, tmp_path):
        store = CellStore(spark, str(tmp_path), UNIT)
        assert store.add(postings.limit(0), "none") == []
        assert store.read().collect() == [] and store.published.batches() == {"none"}

    def test_only_touched_months_are_read(self, spark, postings, tmp_path, monkeypatch, whole_filters):
        store = CellStore(spark, str(tmp_path / "cells"), UNIT)
        store.write(postings)
        read = []
        load = CellStore._load
        monkeypatch.setattr(CellStore, "_load", lambda self, folders: read.extend(folders) or load(self, folders))
        days = [(date(2001, 3, 9), "Revenue", "a1", "c0", Decimal(5), "u1"), (date(2001, 11, 2), "Revenue", "a1", "c0", Decimal(7), None)]
        store.add(spark.createDataFrame(days, postings.schema), "b2")
        assert {f.rsplit("month=")[1] for f in read} == {"2001-03", "2001-11"}
        kept = store.published.current()
        assert len({f.split("/runs/")[1][:32] for f in kept.values()}) == 2  # other months stay where they were

        path = str(tmp_path / "ledger")
        postings.write.parquet(path)
        stored = read_ledger(spark, path, keys=UNIT)
        plan = run_plan(month_cells(stored.where(months_range([date(2001, 3, 1), date(2001, 12, 1), date(2001, 4, 1)])), UNIT))
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan)[1]
        for bound in ("2001-03-01", "2001-05-01", "2001-12-01", "2002-01-01"):
            assert bound in pushed
        assert "2001-04-01" not in pushed

    def test_a_stream_of_late_postings(self, spark, postings, tmp_path):
        """Three files one by one, then the stream's progress is lost and it starts over."""
        store = CellStore(spark, str(tmp_path / "cells"), UNIT)
        store.write(postings.where("sub_code IS NULL OR sub_code = 'c0'"))
        inbox = str(tmp_path / "inbox")
        for part in ("sub_code = 'c1' AND month(entry_date) < 6", "sub_code = 'c1' AND (month(entry_date) >= 6 OR entry_date IS NULL)", "sub_code = 'c2'"):
            postings.where(part).coalesce(1).write.mode("append").parquet(inbox)
        late = spark.readStream.schema(postings.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        for attempt in ("a", "b"):
            store.follow(late, "inbox", str(tmp_path / f"progress-{attempt}")).awaitTermination()
            assert store.published.batches() == {"inbox-0", "inbox-1", "inbox-2"}
            assert reports(store.read(2001)) == reports(postings)
            assert rows(month_cells(store.read(), UNIT)) == rows(month_cells(postings, UNIT))

    def test_rebuilt_months(self, spark, postings, tmp_path):
        store = CellStore(spark, str(tmp_path), UNIT)
        store.write(postings.withColumn("amount", F.when(F.month("entry_date") == 3, 1).otherwise(F.col("amount")).cast("decimal(26,8)")))
        store.rebuild(postings, [date(2001, 3, 20), date(2002, 3, 1)])
        assert reports(store.read(2001)) == reports(postings)
        # a month whose postings are gone
        store.rebuild(postings.where("entry_date < '2001-05-01' OR entry_date >= '2001-06-01'"), [date(2001, 5, 1)])
        assert store.read(2001).where("month(entry_date) = 5").collect() == []
        store.write(postings.where("year(entry_date) = 2001"))
        assert {r[0] for r in store.read().select(F.year("entry_date")).distinct().collect()} == {2001}

    def test_a_failed_change_changes_nothing(self, spark, postings, tmp_path):
        store = CellStore(spark, str(tmp_path), UNIT)
        store.write(postings.where("sub_code = 'c0'"))
        before = rows(store.read())
        broken = postings.withColumn("amount", F.when(F.col("sub_code") == "c2", F.raise_error(F.lit("broken"))).otherwise(F.col("amount")))
        with pytest.raises(Exception, match="broken"):
            store.add(broken, "late")
        assert rows(store.read()) == before
        store.add(postings.where("sub_code != 'c0' OR sub_code IS NULL"), "late")
        assert reports(store.read()) == reports(postings)


class TestPublished:
    def test_a_failed_run_leaves_the_former_report(self, spark, postings, tmp_path, monkeypatch):
        path = str(tmp_path)
        with pytest.raises(LookupError):
            read_published(spark, CFG, path)
        first = publish_report(postings, CFG, path, UNIT)
        before = [rows(df) for df in read_published(spark, CFG, path)]
        # one fails while it reads, one after its tables are written
        broken = postings.withColumn("amount", F.when(F.col("amount") > 80, F.raise_error(F.lit("broken"))).otherwise(F.col("amount")))
        with pytest.raises(Exception, match="broken"):
            publish_report(broken, CFG, path, UNIT)

        def fails(*_):
            raise RuntimeError("no documents")

        with monkeypatch.context() as patched:
            patched.setattr(delivery, "report_documents", fails)
            with pytest.raises(RuntimeError):
                publish_report(postings.limit(10), CFG, path, UNIT)
        assert [rows(df) for df in read_published(spark, CFG, path)] == before

        cfg = replace(CFG, excluded_account=None)
        second = publish_report(postings, cfg, path, UNIT)
        other = publish_report(postings, replace(CFG, year=2002), path, UNIT)
        tables, documents = read_published(spark, CFG, path)
        assert rows(tables.select(report_bundle(postings, cfg, UNIT).columns)) == rows(report_bundle(postings, cfg, UNIT))
        assert documents.count()
        store = Published(spark, path)
        assert store.remove_old() == [first] and store.remove_old() == []
        assert {f.split("/runs/")[1][:32] for f in store.current().values()} == {second, other}
        assert tables.count() == read_published(spark, CFG, path)[0].count()


class TestBuckets:
    @pytest.fixture
    def tables(self, spark, postings):
        for name, matrix in (("stored_revenue", revenue_matrix), ("stored_expense", expense_matrix)):
            lacking = postings if name == "stored_revenue" else postings.where("unit IS NULL OR unit <> 'u2'")
            store_matrix(matrix(lacking, CFG, UNIT), name, UNIT, 4)
        yield "stored_revenue", "stored_expense"
        for name in ("stored_revenue", "stored_expense"):
            spark.sql(f"DROP TABLE {name}")

    def test_no_row_moves_before_the_joins(self, spark, tables):
        plan = run_plan(stored_surplus(spark, *tables, CFG, UNIT))
        assert plan.count("SortMergeJoin") == 1 and plan.count("FileScan") == 2
        assert "Exchange" not in plan

    def test_same_as_from_matrices(self, spark, postings, tables):
        """With a NULL entity and one that has no expenses."""
        lacking = postings.where("unit IS NULL OR unit <> 'u2'")
        want = surplus(revenue_matrix(postings, CFG, UNIT), expense_matrix(lacking, CFG, UNIT), CFG, UNIT)
        got = stored_surplus(spark, *tables, CFG, UNIT)
        assert rows(got) == rows(want) and got.columns == want.columns
        assert {r.unit for r in got.collect()} == {None, "u1", "u2", "u3"}
        with pytest.raises(ValueError):
            store_matrix(revenue_matrix(postings, CFG), "no_keys", [], 4)


class TestAudit:
    @pytest.mark.parametrize("keys", [[], UNIT])
    def test_all_that_is_left_out(self, spark, postings, keys):
        audit = Audit(postings, CFG)
        found = report_bundle(audit.ledger, CFG, keys).collect()
        assert sorted(map(str, found)) == reports(postings, keys)
        audit = {name: (n, amount) for name, n, _, amount in audit.rows()}
        assert list(audit) == list(CLASSES) and all(n for n, _ in audit.values())
        assert sum(n for n, _ in audit.values()) == 6000
        assert sum(a for _, a in audit.values()) == postings.agg(F.sum("amount")).first()[0]
        exact = replace(CFG, as_of=date(2003, 1, 1))  # without forecasts
        months = [F.col(m) for m in CFG.month_labels]
        wide = report_bundle(postings, exact, keys).where("row_type = 'total'").select(sum(F.coalesce(m, F.lit(0)) for m in months))
        cents = sum(r[0] for r in wide.collect())
        assert abs(cents - audit["reported"][1]) < Decimal("0.5")  # totals are rounded to cents once each

    def test_nothing_to_report(self, spark, postings, tmp_path):
        postings.limit(0).write.parquet(str(tmp_path / "empty"))
        audit = Audit(read_ledger(spark, str(tmp_path / "empty")), CFG)
        report_bundle(audit.ledger, CFG).collect()
        assert audit.rows() == [(name, 0, 0, Decimal(0)) for name in CLASSES]
        audit = Audit(postings, replace(CFG, year=1990))
        assert report_bundle(audit.ledger, replace(CFG, year=1990), UNIT).collect() == []
        assert [r[1] for r in audit.rows()] == [62, 5938, 0, 0, 0]


class TestKinds:
    @pytest.mark.parametrize("by_year", [False, True])
    def test_kinds_are_pushed_down(self, spark, postings, tmp_path, by_year, whole_filters):
        path = str(tmp_path / "ledger")
        write_ledger(postings, path, by_year)
        ledger = read_stored_ledger(spark, path, UNIT, 2001 if by_year else None)
        plan = run_plan(expense_matrix(ledger, CFG, UNIT))
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan)[1]
        assert "EqualTo(kind_key,EXPENSE)" in pushed and "upper(" not in plan.split("FileScan")[0].split("Filter")[-1]
        if by_year:
            assert re.search(r"PartitionFilters: \[[^]]*posting_year#\d+ = 2001", plan)
        assert reports(ledger) == reports(postings)
        with pytest.raises(ValueError):
            postings.write.parquet(path + "2")
            read_stored_ledger(spark, path + "2")


class TestLookup:
    def test_many_entries(self, spark):
        table = {(f"k{i}", "x" * (i % 3)): f"v{i}" for i in range(3000)} | {("", ""): "empty", ("é\0", "'"): "odd"}
        cases = [*table, ("k1", "xx"), ("K1", "x"), ("", "x"), (None, ""), ("", None)]
        df = spark.createDataFrame([(*c, table.get(c, "-")) for c in cases], "k string, l string, want string")
        assert df.where(lookup_value([F.col("k"), F.col("l")], table, F.lit("-")) != F.col("want")).count() == 0
        numbers = {(k,): i for i, (k, l) in enumerate(table) if not l}
        got = df.select("k", lookup_value([F.col("k")], numbers, F.lit(-1)).alias("v"))
        assert all(r.v == numbers.get((r.k,), -1) for r in got.collect())

    def test_a_row_looks_at_one_bucket(self, spark):
        """However many entries there are, buckets hold a few."""
        from ledgerloom.operators.lookup import _directory
        import json

        n, buckets, _ = _directory({(f"account {i}", f"4.1.{i % 7}"): "x" for i in range(5000)})
        assert n >= 10_000 and max(map(len, json.loads(buckets))) <= 8


class TestSamples:
    def test_same_on_any_partitioning(self, spark):
        texts = [(f"u{i % 3}", f"bad {i % 40}" if i % 4 else "R$ 1,00", "hot" if i % 2 else None) for i in range(2000)]
        df = spark.createDataFrame(texts, "unit string, a string, b string")
        found = [rows(money_reject_samples(part, ["a", "b"], UNIT, k=3)) for part in (df, df.repartition(13), df.coalesce(1).orderBy("a"))]
        assert found[0] == found[1] == found[2]
        got = money_reject_samples(df, ["a", "b"], UNIT, k=3).collect()
        for unit in ("u0", "u1", "u2"):
            assert len({r.reject for r in got if r.unit == unit and r.column_name == "a"}) == 3
            hot = [r for r in got if r.unit == unit and r.column_name == "b"]
            assert [r.reject for r in hot] == ["hot"]
            assert hot[0].n_rows == sum(u == unit and b == "hot" for u, _, b in texts)
        assert money_reject_samples(df.limit(0), ["a"]).collect() == []
        assert money_reject_samples(df, ["a"], k=100).where("reject LIKE 'bad%'").count() == len({a for _, a, _ in texts} - {"R$ 1,00"})


STYLES = [BRL, BRL_INNER, BRL_POINT, MoneyStyle(symbol="it's \\ $1 ", thousands="'", decimal=",")]


class TestSqlFunctions:
    @pytest.mark.parametrize("style", STYLES)
    def test_money(self, spark, style):
        amounts = [None, "0", "-0.004", "0.005", "-1234567.895", "99999999999999.99", "12.3", "-0.01"]
        texts = [None, "", "n/a", "R$ 1.234,56", "-R$ 1,5", "R$ -2,00", "(3,00)", "4,00 (P)", "1,234.56", "1.234,5,6", f"7{WHITE_SPACE}8", "it's \\ $1 1'000,5"]
        df = spark.createDataFrame([(a, t) for a in amounts for t in texts], "a string, t string").withColumn("a", F.col("a").cast("decimal(26,8)"))
        with sql_functions(spark, replace(CFG, money=style)):
            got = df.selectExpr("a", "t", "money_text(a) AS x", "money_value(t) AS v", "money_value(money_text(a)) AS back")
        same = got.where(
            F.col("x").eqNullSafe(format_money(F.col("a"), style)) & F.col("v").eqNullSafe(parse_money(F.col("t"), style))
            & F.col("back").eqNullSafe(parse_money(format_money(F.col("a"), style), style))
        )
        assert same.count() == df.count()
        plan = run_plan(got)
        assert "Python" not in plan and re.search(r"\*\(\d+\) Project", plan)

    def test_labels_and_rules(self, spark):
        accounts = ["a1", "A1", "A1 ", "O'BRIEN \\ \"X\"", "A0", "x", None]
        df = spark.createDataFrame([(a, c) for a in accounts for c in ("c1", "C1 ", "ç", None)], "a string, c string")
        with sql_functions(spark, CFG):
            got = df.selectExpr("a", "c", "reclassified(label_key(a), c) AS to", "revenue_rank(label_key(a)) AS rank").collect()
        for r in got:
            key = None if r.a is None else (r.a.rstrip(" ").upper(), None if r.c is None else r.c.rstrip(" ").upper())
            assert r.to == (None if key is None else CFG.reclass_targets.get(key, key[0]))
            assert r["rank"] == ({"A0": 1, "A1": 2, "A2": 3}.get(key[0], CFG.unlisted_rank) if key else CFG.unlisted_rank)

    def test_they_go_and_leave_others_alone(self, spark):
        with sql_functions(spark, CFG) as made:
            grid = spark.sql("SELECT * FROM report_grid()")
            assert "money_text" in made
        assert grid.count() == 36
        with pytest.raises(AnalysisException):
            spark.sql("SELECT money_text(1)")
        spark.sql("CREATE TEMPORARY FUNCTION month_label(x INT) RETURNS INT RETURN x + 1")
        try:
            with pytest.raises(AnalysisException), sql_functions(spark, CFG):
                pass
            assert spark.sql("SELECT month_label(1)").first()[0] == 2
            with pytest.raises(AnalysisException):
                spark.sql("SELECT money_text(1)")
        finally:
            spark.sql("DROP TEMPORARY FUNCTION month_label")

    def test_query_in_sql(self, spark, postings):
        query = NamedQuery.from_sql("By account", "SELECT label_key(account) AS label, money_text(sum(amount)) AS text FROM {ledger} GROUP BY 1")
        df = query.build(postings.select(LEDGER_SCHEMA.fieldNames()), CFG, [])
        want = postings.groupBy(F.upper(F.rtrim("account")).alias("label")).agg(format_money(F.sum("amount")).alias("text"))
        assert rows(df) == rows(want) and "Python" not in run_plan(df)


class TestSqlReports:
    @pytest.mark.parametrize("keys", [[], UNIT])
    @pytest.mark.parametrize("change", [{}, {"excluded_account": None}, {"missing_as_zero": True, "as_of": date(2001, 12, 3)}])
    def test_same_as_the_builders(self, spark, postings, keys, change):
        cfg = replace(CFG, **change)
        for name, query in sql_queries(cfg, keys).items():
            got, want = query.build(postings, cfg, keys), default_registry().run(name, postings, cfg, keys)
            assert rows(got.select(want.columns)) == rows(want), name
            assert query.title == dict(zip(("expense", "revenue", "surplus"), cfg.section_titles))[name]

    def test_odd_names(self, spark, postings):
        months = tuple(f"m`{i}' \\ é" for i in range(12))
        cfg = replace(CFG, month_labels=months, total_label="it's \\ all")
        keyed = postings.withColumnRenamed("unit", "my `unit")
        for name, query in sql_queries(cfg, ["my `unit"]).items():
            got = query.build(keyed, cfg, ["my `unit"])
            want = default_registry().run(name, postings, replace(CFG, total_label="it's \\ all"), UNIT)
            assert rows(got.drop("rank").toDF(*want.columns)) == rows(want), name

    @pytest.mark.parametrize("keys", [[], UNIT])
    def test_nothing_posted(self, spark, postings, keys):
        for name, query in sql_queries(CFG, keys).items():
            got, want = query.build(postings.limit(0), CFG, keys), default_registry().run(name, postings.limit(0), CFG, keys)
            assert rows(got.select(want.columns)) == rows(want), name

    def test_plans(self, spark, postings, tmp_path, whole_filters):
        postings.write.parquet(str(tmp_path / "ledger"))
        ledger = read_ledger(spark, str(tmp_path / "ledger"), keys=UNIT)
        for name, query in sql_queries(CFG, UNIT).items():
            plan = run_plan(query.build(ledger, CFG, UNIT))
            pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)
            assert pushed and all("GreaterThanOrEqual(entry_date,2001-01-01)" in p for p in pushed), name
            assert "Python" not in plan and "partial_sum" in plan


def test_scratch_is_one_folder_that_goes(spark):
    folders = [scratch_folder(spark) for _ in range(2)]
    assert len({f.rsplit("/", 1)[0] for f in folders}) == 1 and folders[0] != folders[1]
    assert spark.sparkContext.applicationId in folders[0]
    for folder in folders:
        spark.range(3).write.parquet(folder)
    assert remove_scratch(spark) and not remove_scratch(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(folders[0])
