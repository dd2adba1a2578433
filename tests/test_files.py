"""Sources and sinks."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from ledgerloom import MoneyStyle, ReportConfig, deliver_report, report_bundle, surplus_table
from ledgerloom.plans.registry import NamedQuery, QueryRegistry
from ledgerloom.session import scratch_folder
from ledgerloom.sources.ledger import (
    LEDGER_SCHEMA,
    as_ledger,
    jdbc_ledger_options,
    read_ledger,
    read_ledger_jdbc,
    read_ledger_table,
    read_sql,
)
from ledgerloom.sources.sinks import document_lines, report_documents, write_report

CFG = ReportConfig(
    year=2001,
    as_of=date(2001, 9, 5),
    revenue_accounts=("A", "B"),
    expense_accounts=("E1",),
    excluded_account="B",
)


@pytest.fixture()
def postings(make_ledger):
    rows = [(m, "Revenue", a, "c", 100 * m) for m in (1, 7) for a in ("A", "B")]
    rows.append((1, "Expense", None, "c", 3))
    rows += [(m, "Expense", f"Cost <{i}> & co", "c", m + i) for m in (1, 2) for i in range(30)]
    return make_ledger([(*r, u) for r in rows for u in ("u1", None)], keyed=True)


def test_as_ledger_maps_and_casts(spark):
    source = spark.sql(
        "SELECT TIMESTAMP_NTZ'2001-02-03 23:59:59' AS d, 'Revenue' AS k, 'A' AS a, 7 AS c, 1.235D AS v, 9 AS u"
    )
    columns = {"entry_date": "d", "kind": "k", "account": "a", "sub_code": "c", "amount": "v", "unit": "u"}
    df = as_ledger(source, columns, ["unit"])
    assert df.schema.names == [*LEDGER_SCHEMA.names, "unit"]
    assert [f.dataType for f in df.schema][:5] == [f.dataType for f in LEDGER_SCHEMA]
    assert as_dicts(df)[0] == {
        "entry_date": date(2001, 2, 3), "kind": "Revenue", "account": "A", "sub_code": "7",
        "amount": Decimal("1.23500000"), "unit": "9",
    }
    with pytest.raises(ValueError, match=r"lacks columns \['amount'\]"):
        as_ledger(source, {k: v for k, v in columns.items() if k != "amount"}, ["unit"])


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_file_formats(spark, postings, tmp_path, fmt):
    path = str(tmp_path / fmt)
    renamed = postings.withColumnRenamed("amount", "value").select(
        "unit", "value", "sub_code", "account", "kind", "entry_date"
    )
    renamed.write.format(fmt).option("header", "true").save(path)
    df = read_ledger(spark, path, fmt, {"amount": "value"}, ["unit"])
    assert df.schema.names == postings.schema.names
    assert sorted(map(str, df.collect())) == sorted(map(str, postings.collect()))


def test_table(spark, postings):
    postings.createOrReplaceTempView("some_postings")
    df = read_ledger_table(spark, "some_postings", keys=["unit"])
    assert df.count() == postings.count()


def test_partitioned_ledger_is_pruned(spark, postings, tmp_path):
    path = str(tmp_path / "by_day")
    postings.write.partitionBy("entry_date").parquet(path)
    plan = surplus_table(read_ledger(spark, path), replace(CFG, year=2002))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(entry_date" in text


class RecordingReader:
    """Stands in for a session whose database nobody can reach here."""

    def __init__(self, result):
        self.result, self.given = result, {}
        self.read = self

    def format(self, name):
        self.given["format"] = name
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def load(self):
        return self.result


def test_jdbc_reads_one_year_in_parallel(postings):
    options = jdbc_ledger_options("jdbc:x", "fact", 2001, 64, {"entry_date": "day"}, ["unit"])
    assert options == {
        "url": "jdbc:x",
        "dbtable": "(SELECT day, kind, account, sub_code, amount, unit FROM fact "
        "WHERE day >= '2001-01-01' AND day < '2002-01-01') postings",
        "partitionColumn": "day",
        "lowerBound": "2001-01-01",
        "upperBound": "2002-01-01",
        "numPartitions": "64",
        "fetchsize": "10000",
    }
    split = jdbc_ledger_options("jdbc:x", "fact", 2001, 8, split_on=("posting_id", "1", "900"))
    assert split["dbtable"].startswith("(SELECT entry_date, kind, account, sub_code, amount, posting_id ")
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"]) == ("posting_id", "1", "900")
    reader = RecordingReader(postings)
    df = read_ledger_jdbc(reader, "jdbc:x", "fact", 2001, 64, keys=["unit"], user="me", fetchsize="5")
    assert df.columns == postings.columns
    assert reader.given["format"] == "jdbc" and reader.given["numPartitions"] == "64"
    assert reader.given["user"] == "me" and reader.given["fetchsize"] == "5"
    reader = RecordingReader(postings)
    assert read_sql(reader, "jdbc:x", "SELECT 1", user="me") is postings
    assert reader.given == {"format": "jdbc", "url": "jdbc:x", "query": "SELECT 1", "user": "me"}


def test_sql_text_query(postings):
    registry = QueryRegistry()
    registry["codes"] = NamedQuery.from_sql(
        "Codes",
        "SELECT sub_code, count(*) AS n FROM {ledger} WHERE entry_date >= :first_day "
        "AND entry_date < :next_first_day AND kind = :kind GROUP BY sub_code",
        kind="Expense",
    )
    assert as_dicts(registry.run("codes", postings, CFG)) == [{"sub_code": "c", "n": 122}]
    assert as_dicts(registry.run("codes", postings, replace(CFG, year=1990))) == []


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_written_sections(spark, postings, tmp_path, fmt):
    path = str(tmp_path / fmt)
    bundle = report_bundle(postings, CFG, ["unit"])
    write_report(bundle, CFG, path, fmt)
    assert sorted(p.name for p in Path(path, "report_year=2001").glob("section=*")) == [
        "section=expense", "section=revenue", "section=surplus"
    ]
    back = spark.read.format(fmt).schema(bundle.schema).option("header", "true").load(path)
    assert sorted(map(str, back.select(bundle.columns).collect())) == sorted(map(str, bundle.collect()))


def test_a_rerun_replaces_its_own_year_only(spark, postings, tmp_path):
    path = str(tmp_path / "reports")
    for year in (2001, 2002, 2001):
        cfg = replace(CFG, year=year)
        write_report(report_bundle(postings, cfg), cfg, path)
    back = spark.read.parquet(path).groupBy("report_year").count().collect()
    # 2002 has no postings: two empty total rows and two empty differences
    assert sorted(tuple(r) for r in back) == [(2001, 2 + 1 + 31 + 1 + 2), (2002, 4)]


def test_extra_folders(postings, tmp_path):
    path = str(tmp_path / "by_unit")
    write_report(report_bundle(postings, CFG, ["unit"]), CFG, path, partition_by=["unit"])
    assert Path(path, "report_year=2001", "unit_folder=u1", "section=surplus").is_dir()


def test_key_folders_leave_the_key_as_it_is(spark, make_ledger, tmp_path):
    path = str(tmp_path / "numbered")
    rows = [(1, "Revenue", "A", "c", 5, f"00{i}") for i in range(3)]
    write_report(report_bundle(make_ledger(rows, keyed=True), CFG, ["unit"]), CFG, path, partition_by=["unit"])
    assert {r.unit for r in spark.read.parquet(path).collect()} == {"000", "001", "002"}


def joined(documents) -> dict[tuple, dict]:
    """Lines of each section in reading order, put together."""
    out: dict[tuple, dict] = {}
    for line in as_dicts(documents.orderBy("part_rank", "part_label")):
        key = tuple(line[c] for c in ("unit", "section") if c in line)
        if key not in out:
            assert line["part_rank"] == 0 and line["part_label"] == ""
            out[key] = line
        else:
            assert line["title"] is None and line["subject"] is None and line["intro"] is None
            out[key]["html"] += line["html"]
    return out


def test_documents(postings):
    by = joined(report_documents(report_bundle(postings, CFG, ["unit"]), CFG, ["unit"]))
    assert len(by) == 6
    revenue = by[None, "revenue"]
    assert revenue["subject"].endswith("05/09/2001") and revenue["intro"].endswith("05/09/2001")
    html = revenue["html"]
    assert html.startswith('<table border="1"><thead><tr align="center"><th>label</th><th>jan</th>')
    assert html.endswith("</tr></tbody></table>") and html.count("<table") == 1
    assert html.index("<td>A</td>") < html.index("<td>B</td>") < html.index("<td>TOTAL</td>")
    assert "<td>R$ 700,00 (P)</td>" in html and "<td></td>" in html and "null" not in html.lower()
    assert "<td>COST &lt;7&gt; &amp; CO</td>" in by["u1", "expense"]["html"]
    assert "<td>R$ -" not in by["u1", "revenue"]["html"]
    # Surplus text puts the minus inside.
    assert "<td>R$ -268,00</td>" in by["u1", "surplus"]["html"]
    assert by["u1", "surplus"]["html"].count("<tr") == 3


def test_headings_are_settings(postings):
    cfg = replace(CFG, label_heading="Group", total_heading="Year & all")
    by = joined(report_documents(report_bundle(postings, cfg), cfg))
    assert "<th>Group</th><th>jan</th>" in by["surplus",]["html"]
    assert "<th>Year &amp; all</th></tr>" in by["surplus",]["html"]


def test_currency_symbol_is_escaped(postings):
    cfg = replace(CFG, money=MoneyStyle(symbol="<&> "))
    lines = document_lines(report_bundle(postings, cfg), cfg).where("section = 'revenue'")
    html = "".join(row["html"] for row in as_dicts(lines))
    assert "<td>&lt;&amp;&gt; 1.400,00 (P)</td>" in html and "<&>" not in html


def test_long_sections_have_the_same_shape(make_ledger):
    rows = [(1, "Expense", f"Cost {i:05}", "c", 1, u) for i in range(3000) for u in ("hot",)] + [(1, "Expense", "x", "c", 1, "small")]
    documents = report_documents(report_bundle(make_ledger(rows, keyed=True), CFG, ["unit"]), CFG, ["unit"])
    lines = documents.where("section = 'expense'").groupBy("unit").count().collect()
    # opening line, details, total
    assert {r["unit"]: r["count"] for r in lines} == {"hot": 3002, "small": 3}
    html = joined(documents)["hot", "expense"]["html"]
    assert html.count("<tr>") == 3001 and html.index("COST 00009<") < html.index("COST 02999<") < html.index("TOTAL")


def test_documents_are_written_like_reports(spark, postings, tmp_path):
    path = str(tmp_path / "documents")
    documents = report_documents(report_bundle(postings, CFG, ["unit"]), CFG, ["unit"])
    write_report(documents, CFG, path)
    back = spark.read.parquet(path).where("section = 'expense'").select(documents.columns)
    expected = documents.where("section = 'expense'").collect()
    assert sorted(map(str, back.collect())) == sorted(map(str, expected))


def test_delivery(spark, postings, tmp_path):
    postings.write.parquet(str(tmp_path / "ledger"))
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    tables, documents = deliver_report(ledger, CFG, str(tmp_path / "out"), ["unit"])
    bundle = report_bundle(ledger, CFG, ["unit"])
    back = spark.read.parquet(tables).select(bundle.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, bundle.collect()))
    expected = report_documents(bundle, CFG, ["unit"])
    back = spark.read.parquet(documents).select(expected.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, expected.collect()))


def test_a_rerun_leaves_nothing_of_the_run_before(spark, postings, tmp_path):
    folder = str(tmp_path / "out")
    deliver_report(postings, CFG, folder, ["unit"])
    other = replace(CFG, year=2002)
    deliver_report(postings.withColumn("entry_date", F.add_months("entry_date", 12)), other, folder, ["unit"])
    tables, documents = deliver_report(postings.limit(0), CFG, folder, ["unit"])
    for path in (tables, documents):
        assert not [p for p in Path(path, "report_year=2001").rglob("*.parquet") if spark.read.parquet(str(p)).count()]
        assert spark.read.parquet(path + "/report_year=2002").count() > 0


JSON_LINES = {
    "text as amount": '{"entry_date":"2001-01-02","kind":"Revenue","account":"A","sub_code":"c","amount":"ten"}',
    "date of another order": '{"entry_date":"02/01/2001","kind":"Revenue","account":"A","sub_code":"c","amount":1}',
    "overflow": '{"entry_date":"2001-01-02","kind":"Revenue","account":"A","sub_code":"c","amount":1e30}',
    "broken": '{"entry_date":"2001-01-02","kind":',
}
GOOD = '{"entry_date":"2001-01-02","kind":"Revenue","account":"A","sub_code":7,"amount":100.0040}'


@pytest.mark.parametrize("bad", JSON_LINES)
def test_json_that_does_not_fit_fails(spark, tmp_path, bad):
    path = tmp_path / "ledger.json"
    path.write_text(GOOD + "\n" + JSON_LINES[bad] + "\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW|NUMERIC_VALUE_OUT_OF_RANGE|[Mm]alformed|MALFORMED"):
        report_bundle(read_ledger(spark, str(path), "json"), CFG).collect()


def test_json_columns_are_checked(spark, tmp_path):
    path = tmp_path / "ledger.json"
    path.write_text(GOOD + "\n")
    with pytest.raises(ValueError, match="amounts"):
        read_ledger(spark, str(path), "json", {"amount": "amounts"})
    (row,) = as_dicts(read_ledger(spark, str(path), "json"))
    assert row["amount"] == Decimal("100.004") and row["sub_code"] == "7"


def test_names_without_case(spark):
    source = spark.sql("SELECT DATE'2001-01-01' AS ENTRY_DATE, 'Revenue' AS Kind, 'A' AS ACCOUNT, 'c' AS SUB_CODE, 1 AS Amount")
    assert as_ledger(source).columns == LEDGER_SCHEMA.names


def test_amounts_are_summed_as_precise_as_they_come(spark):
    source = spark.range(1000).selectExpr(
        "DATE'2001-01-01' AS entry_date", "'Revenue' AS kind", "'A' AS account", "'c' AS sub_code",
        "CAST(0.0040 AS DECIMAL(19,4)) AS amount")
    ledger = as_ledger(source)
    assert {r["total"] for r in as_dicts(report_bundle(ledger, CFG).where("section = 'revenue'"))} == {Decimal("4.00")}
    with pytest.raises(ValueError, match="more decimals"):
        as_ledger(source.withColumn("amount", F.col("amount").cast("decimal(20,10)")))


@pytest.mark.parametrize("key", ["html", "opens", "title", "subject", "part_label", "LINE", "revenue_jan", "expense_total"])
def test_keys_named_like_report_columns_are_refused(postings, key):
    with pytest.raises(ValueError, match="rename"):
        report_bundle(postings.withColumnRenamed("unit", key), CFG, [key])


def test_month_labels_named_like_report_columns_are_refused():
    with pytest.raises(ValueError, match="total"):
        replace(CFG, month_labels=("Total", *CFG.month_labels[1:]))


def test_lines_without_an_excluded_account(postings):
    cfg = replace(CFG, excluded_account=None)
    lines = document_lines(report_bundle(postings, cfg), cfg).where(F.col("section") == "surplus")
    first, last = as_dicts(lines.orderBy("rank", "label"))
    assert first["rank"] == 0 and last["html"].endswith("</tbody></table>")
    assert last["label"] == "SURPLUS"


class ClusterSession:
    """Session of a cluster, as far as ``scratch_folder`` looks at one."""

    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_scratch_folder(spark):
    assert scratch_folder(spark) != scratch_folder(spark)
    warehouse = {"spark_sql_warehouse_dir": "hdfs:///warehouse"}
    first, second = (scratch_folder(ClusterSession(spark_checkpoint_dir="hdfs:///shared/", **warehouse)) for _ in range(2))
    assert first != second and first.startswith("hdfs:///shared/") and "//" not in first[8:]
    assert scratch_folder(ClusterSession(**warehouse)).startswith("hdfs:///warehouse/")
