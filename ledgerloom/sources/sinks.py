"""Report output: section tables as files, and HTML tables as rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import SECTIONS, ReportConfig
from ledgerloom.functions.dates import day_text
from ledgerloom.functions.text import escape_html, html_row
from ledgerloom.operators.matrix import matrix_text


def year_folder(path: str, cfg: ReportConfig) -> str:
    return f"{path.rstrip('/')}/report_year={cfg.year}"


def write_report(
    bundle: DataFrame,
    cfg: ReportConfig,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a bundle (or its documents), one folder per year and section.

    No shuffle precedes the write; each task splits its rows by section. A re-run replaces the
    whole folder of its year, so nothing of an earlier run stays, and no other year's.
    Entity keys of few values may be added in ``partition_by``; as folders, many values would
    mean many small files. Such a key's folder is called ``<key>_folder`` and the key stays a
    column, since readers that infer types turn folder names like 007 into numbers.
    """
    folders = [f"{k}_folder" for k in partition_by]
    (
        bundle.withColumns({f: F.col(k) for f, k in zip(folders, partition_by)})
        .write.format(fmt)
        .mode(mode)
        .option("partitionOverwriteMode", "static")
        .options(**({"header": "true"} if fmt == "csv" else {}))
        .partitionBy(*folders, "section")
        .save(year_folder(path, cfg))
    )


def bundle_text(bundle: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Amounts as text: matrices in the report's style, differences in the surplus style."""
    inner = F.when(F.col("section") == "surplus", F.lit(cfg.surplus_negative)).otherwise(
        F.lit(cfg.money.negative)
    ) == "inner"
    return matrix_text(bundle, cfg, inner)


def document_lines(
    bundle: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()
) -> DataFrame:
    """HTML lines: [keys], section, rank, label, html. Sorted by rank and label, a section's
    lines are its table. The table's opening line has rank 0; the last row closes it.

    ``keys`` may name any columns to take along.
    """
    columns = ["label", *cfg.month_labels, "total"]
    shown = [cfg.label_heading, *cfg.month_labels, cfg.total_heading]
    heading = "".join(f"<th>{escape(c, quote=False)}</th>" for c in shown)
    opening = f'<table border="1"><thead><tr align="center">{heading}</tr></thead><tbody>'
    # Amounts are digits and the style's own signs, so only the style needs escaping, once.
    style = replace(cfg.money, symbol=escape(cfg.money.symbol, quote=False))

    # Every section has exactly one closing row, which also brings the opening line.
    last_surplus = 1 if cfg.excluded_label is None else 2
    closes = F.when(F.col("section") == "surplus", F.col("rank") == last_surplus).otherwise(
        F.col("row_type") == "total"
    )
    copies = F.when(closes, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    opens = F.col("opens")
    return (
        bundle_text(bundle, replace(cfg, money=style))
        .select(
            *keys,
            "section",
            "rank",
            "label",
            F.concat(
                html_row([escape_html(F.col("label")), *[F.col(c) for c in columns[1:]]]),
                F.when(closes, "</tbody></table>").otherwise(""),
            ).alias("html"),
            F.explode(copies).alias("opens"),
        )
        .select(
            *keys,
            "section",
            F.when(opens, 0).otherwise(F.col("rank")).alias("rank"),
            F.when(opens, "").otherwise(F.col("label")).alias("label"),
            F.when(opens, opening).otherwise(F.col("html")).alias("html"),
        )
    )


def report_documents(bundle: DataFrame, cfg: ReportConfig, keys: Sequence[str] = ()) -> DataFrame:
    """HTML tables with subject and introduction, a row for each line:
    [keys], section, part_rank, part_label, title, subject, intro, html.

    In order of (part_rank, part_label) the ``html`` of an entity's section is its whole table.
    Title, subject and introduction stand on the opening line (``part_rank`` 0) and are NULL on
    the others. The shape is the same for any number of accounts; no section is gathered.
    """
    as_of = day_text(F.lit(cfg.as_of))
    title = F.lit(None).cast("string")
    for section, text in zip(SECTIONS, cfg.section_titles):
        title = F.when(F.col("section") == section, text).otherwise(title)
    opens = F.col("rank") == 0
    return document_lines(bundle, cfg, keys).select(
        *keys,
        "section",
        F.col("rank").alias("part_rank"),
        F.col("label").alias("part_label"),
        F.when(opens, title).alias("title"),
        F.when(opens, F.concat(F.lit(cfg.subject), as_of)).alias("subject"),
        F.when(opens, F.concat(F.lit(cfg.intro), as_of)).alias("intro"),
        "html",
    )


def in_reading_order(documents: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Document lines in the order they are read, in ranges of about equal size: a section
    of very many lines spans several tasks and files."""
    order = [*keys, "section", "part_rank", "part_label"]
    return documents.repartitionByRange(*order).sortWithinPartitions(*order)
