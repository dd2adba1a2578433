"""Month cells: a ledger summed by month once, kept up to date by what comes later.

A cell is the sum of one entity's postings of one kind, account and code in one month, as precise
as the ledger's amounts. Sums of sums are exact, and the settings of a report (its rules, accounts,
kinds) apply to cells as they do to postings, so ``CellStore.read`` is a ledger of its own: every
report of it equals that of all postings.

Late postings, once or as a stream, are summed and added to the cells of just the months they touch; where postings were
corrected or removed, ``rebuild`` sums those months again. Months are parts of a ``Published``
folder, so a change takes effect for all its months at once, or not at all, and each batch of late
postings counts once however often it is sent.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.dates import month_start
from ledgerloom.functions.text import label_key
from ledgerloom.sources.published import Published

#: Folder of postings without a date.
NO_MONTH = "none"
#: Sums of amounts of eight decimals.
CELL = T.DecimalType(38, 8)


def month_cells(ledger: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ledger columns and ``n_postings``: one row per entity, kind, account, code and month, the
    month as its first day. Labels are in the form in which they are compared. Cells of cells are
    the same cells. Only partial sums move."""
    counted = F.col("n_postings") if "n_postings" in ledger.columns else F.lit(1)
    by = [
        *keys,
        month_start(F.col("entry_date")).alias("entry_date"),
        *[label_key(F.col(c)).alias(c) for c in ("kind", "account", "sub_code")],
    ]
    return (
        ledger.select(*by, F.col("amount").cast(CELL).alias("amount"), counted.cast("long").alias("n_postings"))
        .groupBy(*keys, "entry_date", "kind", "account", "sub_code")
        .agg(F.sum("amount").cast(CELL).alias("amount"), F.sum("n_postings").alias("n_postings"))
    )


def months_range(months: Iterable[date]) -> Column:
    """Postings of the months, as ranges on the date: they reach the file scan."""
    starts = sorted(set(months))
    if not starts:
        return F.lit(False)

    def after(day: date) -> date:
        return date(day.year + day.month // 12, day.month % 12 + 1, 1)

    spans: list[list[date]] = []
    for start in starts:
        if spans and spans[-1][1] == start:
            spans[-1][1] = after(start)
        else:
            spans.append([start, after(start)])
    day = F.col("entry_date")
    return reduce(lambda a, b: a | b, [(day >= F.lit(first)) & (day < F.lit(end)) for first, end in spans])


class CellStore:
    """Month cells of a ledger below ``path``; ``keys`` are its entity columns."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ()) -> None:
        self.spark, self.keys = spark, list(keys)
        self.published = Published(spark, path)
        texts = [*self.keys, "kind", "account", "sub_code"]
        self.schema = T.StructType([
            *[T.StructField(c, T.StringType()) for c in texts[: len(self.keys)]],
            T.StructField("entry_date", T.DateType()),
            *[T.StructField(c, T.StringType()) for c in texts[len(self.keys):]],
            T.StructField("amount", CELL), T.StructField("n_postings", T.LongType()),
        ])

    def _load(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _write(self, cells: DataFrame, run: str, place: str) -> dict[str, str]:
        """Cells by month below the run's folder; returns month -> place of the months written."""
        target = f"{self.published.folder(run)}/{place}"
        month = F.coalesce(F.date_format("entry_date", "yyyy-MM"), F.lit(NO_MONTH))
        # by month, large months in several files and small ones in few: adaptive execution sees to it
        cells.withColumn("month", month).hint("rebalance", "month").write.partitionBy("month").parquet(target)
        # a row per month folder, found by listing
        schema = T.StructType([*self.schema.fields, T.StructField("month", T.StringType())])
        found = self.spark.read.schema(schema).parquet(target).select("month").distinct().collect()
        return {r.month: f"{place}/month={r.month}" for r in found}

    def write(self, ledger: DataFrame, batch: str | None = None) -> None:
        """Cells of a whole ledger, in place of all there were."""
        run = self.published.new_run()
        parts = dict.fromkeys(self.published.current(), "")
        self.published.commit(run, parts | self._write(month_cells(ledger, self.keys), run, "cells"), batch)

    def add(self, late: DataFrame, batch: str) -> list[str]:
        """Add postings to the cells of the months they fall in; returns those months. Only the late
        postings and these months' cells are read. A batch that was added before changes nothing."""
        if batch in self.published.batches():
            return []
        run = self.published.new_run()
        added = self._write(month_cells(late, self.keys), run, "late")
        current = self.published.current()
        before = [current[m] for m in added if m in current]
        new = [f"{self.published.folder(run)}/{place}" for place in added.values()]
        merged = month_cells(self._load([*before, *new]), self.keys) if new else self._load([])
        self.published.commit(run, self._write(merged, run, "cells"), batch)
        return sorted(added)

    def follow(self, late: DataFrame, name: str, checkpoint: str, **trigger: object) -> StreamingQuery:
        """Start a streaming query that adds each micro-batch of late postings as it arrives.
        ``trigger`` is as for ``DataStreamWriter.trigger``: by default all there is, then it ends.

        A micro-batch is a batch of the store by ``name`` and number, so one that is run again
        after a failure counts once."""

        def apply(postings: DataFrame, number: int) -> None:
            store = CellStore(postings.sparkSession, self.published.path, self.keys)
            store.add(postings, f"{name}-{number}")

        trigger = trigger or {"availableNow": True}
        return late.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def rebuild(self, ledger: DataFrame, months: Iterable[date], batch: str | None = None) -> None:
        """Sum the postings of ``months`` again, reading no others; their former cells go."""
        months = [day.replace(day=1) for day in months]
        run = self.published.new_run()
        written = self._write(month_cells(ledger.where(months_range(months)), self.keys), run, "cells")
        emptied = {day.strftime("%Y-%m"): "" for day in months}
        self.published.commit(run, emptied | written, batch)

    def read(self, year: int | None = None) -> DataFrame:
        """Cells of a year, or all, as a ledger; the amounts' sums may be wider than postings."""
        current = self.published.current()
        return self._load([f for month, f in sorted(current.items()) if year is None or month.startswith(f"{year:04d}-")])
