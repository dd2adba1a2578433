"""Matrices stored by entity, and reports on what is stored.

Matrices of many entities are kept as bucketed tables: an entity's rows of every table are in the
bucket of the same number, sorted, so that tables join without moving a row. Buckets are chosen by
``entity``, the keys as one text that is never NULL, since a NULL key is an entity like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import ReportConfig
from ledgerloom.operators.delta import PARTS, surplus_rows


def entity_text(keys: Sequence[str]) -> Column:
    """The keys as one text; NULL, empty and any other key differ."""
    return F.to_json(F.array(*[F.struct(F.col(k).cast("string").alias("k")) for k in keys]))


def store_matrix(matrix: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Write a keyed matrix as table ``name`` of the catalog, one file per bucket. One shuffle, by
    entity; a matrix holds at most a few hundred accounts of each."""
    if not keys:
        raise ValueError("only matrices by entity are stored in buckets")
    stored = matrix.withColumn("entity", entity_text(keys)).repartition(buckets, "entity")
    writer = stored.write.mode("overwrite").format("parquet").bucketBy(buckets, "entity").sortBy("entity")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def _picked(matrix: DataFrame, parts: dict[str, Column], side: str, keys: Sequence[str], cfg: ReportConfig) -> DataFrame:
    """One row per entity with the months of a chosen row for each part, of which there is one at most."""
    kept = [F.max(F.when(chosen, F.col(m))).alias(f"{part}_{m}") for part, chosen in parts.items() for m in cfg.month_labels]
    return matrix.groupBy("entity").agg(*[F.max(k).alias(f"{side}_{k}") for k in keys], *kept)


def stored_surplus(spark: SparkSession, revenue: str, expense: str, cfg: ReportConfig, keys: Sequence[str]) -> DataFrame:
    """Difference rows of two stored matrices, as ``reports.surplus`` gives them. Each table is read
    once; grouping and join find the rows in place. Both tables must have the same number of buckets,
    else Spark shuffles one."""
    is_total = F.col("row_type") == "total"
    excluded = (F.col("row_type") == "detail") & (F.col("label") == F.lit(cfg.excluded_label).cast("string"))
    r = _picked(spark.table(revenue), {PARTS[0]: is_total, PARTS[2]: excluded}, "r", keys, cfg)
    e = _picked(spark.table(expense), {PARTS[1]: is_total}, "e", keys, cfg)
    totals = r.join(e, "entity", "full").withColumns({k: F.coalesce(f"r_{k}", f"e_{k}") for k in keys})
    return surplus_rows(totals, cfg, keys)
