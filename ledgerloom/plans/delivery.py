"""The whole report, delivered: tables and HTML documents as files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.config import ReportConfig
from ledgerloom.plans.reports import report_bundle
from ledgerloom.sources.published import Published
from ledgerloom.sources.sinks import in_reading_order, report_documents, write_report, year_folder


def deliver_report(
    ledger: DataFrame, cfg: ReportConfig, folder: str, keys: Sequence[str] = ()
) -> tuple[str, str]:
    """Write ``folder``/tables and ``folder``/documents; returns both paths.

    The documents are made from the written tables. The ledger is thus read once, and a
    failure while writing documents never costs its aggregation again.
    """
    tables, documents = f"{folder}/tables", f"{folder}/documents"
    bundle = report_bundle(ledger, cfg, keys)
    write_report(bundle, cfg, tables)
    written = ledger.sparkSession.read.schema(bundle.schema).parquet(year_folder(tables, cfg))
    lines = report_documents(written.select(bundle.columns), cfg, keys)
    write_report(in_reading_order(lines, keys), cfg, documents)
    return tables, documents


def _year_part(cfg: ReportConfig) -> str:
    return f"report_year={cfg.year}"


def publish_report(ledger: DataFrame, cfg: ReportConfig, path: str, keys: Sequence[str] = ()) -> str:
    """``deliver_report`` into a run folder of its own, which then becomes the current report of its
    year, tables and documents together. If anything fails before, the former report stays.
    Returns the run; ``Published.remove_old`` deletes former ones."""
    store = Published(ledger.sparkSession, path)
    run = store.new_run()
    deliver_report(ledger, cfg, f"{store.folder(run)}/report", keys)
    store.commit(run, {_year_part(cfg): "report"})
    return run


def read_published(spark: SparkSession, cfg: ReportConfig, path: str) -> tuple[DataFrame, DataFrame]:
    """Tables and documents of the current report of the year."""
    folder = Published(spark, path).current().get(_year_part(cfg))
    if folder is None:
        raise LookupError(f"no report of {cfg.year} is published in {path}")
    tables, documents = (spark.read.parquet(year_folder(f"{folder}/{kind}", cfg)) for kind in ("tables", "documents"))
    return tables, documents
