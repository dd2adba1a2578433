"""Tables in the folder that driver and executors share, and columns that identify a document."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_folder, scratch_root

#: Rows of a batch that goes to a Python worker: texts are large, so far fewer than Spark's default.
BATCH_ROWS = 1000
#: Stands for a null doc_id in keys; sorts before every other.
NO_ID = -(2**63)


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below the one that driver and executors share. Tables kept there
    belong to whoever runs the operator: ``session.remove_scratch`` deletes them all, once what was
    made of the (lazy) results is written."""
    return scratch_root(spark)


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._kept_at = path
    return kept


def forget(kept: DataFrame) -> None:
    """Delete a kept table that nothing will read any more."""
    remove_folder(kept.sparkSession, kept._kept_at)


def broadcast_if_small(kept: DataFrame, rows: int = 500_000) -> DataFrame:
    """A kept table of a few numbers per row, marked for broadcast if its counted size allows;
    else Spark joins it as it would any table."""
    return F.broadcast(kept) if kept.count() <= rows else kept


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends at most ``BATCH_ROWS`` rows at a time to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def lean(work: Callable) -> Callable:
    """``work`` on batches, after which the Python worker gives back what memory it no longer uses:
    Spark keeps idle workers for a minute, beside those of the next stage."""

    def run(batches: Iterator) -> Iterator:
        pa.set_memory_pool(pa.system_memory_pool())  # others keep what they freed
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # a C library without it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # where the driver found this package by its own path only, workers look there too
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return in_small_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def doc_key() -> Column:
    """doc_id as a long that is never null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def doc_id_of(key: Column) -> Column:
    return F.when(key != NO_ID, key)


def identified(docs: DataFrame) -> DataFrame:
    """``_d`` and ``_t`` identify a document (rows equal in doc_id and text are one); ``_row``
    holds all columns of the input, so that none can clash with names used here."""
    return in_small_batches(docs).select(
        doc_key().alias("_d"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_t"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
