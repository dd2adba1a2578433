"""Ledger sources: files, tables and databases, brought to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.config import PLAIN_KINDS, RAW, RAW_DECIMALS
from ledgerloom.functions.text import label_key

LEDGER_SCHEMA = T.StructType([
    T.StructField("entry_date", T.DateType()),
    T.StructField("kind", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("sub_code", T.StringType()),
    T.StructField("amount", T.DecimalType(26, RAW_DECIMALS)),
])


def as_ledger(
    df: DataFrame, columns: Mapping[str, str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Project ``df`` onto the ledger schema plus entity ``keys``, which become text.

    ``columns`` maps ledger names to the source's own; case does not matter, as in Spark. Missing
    columns are an error; types are cast; in ANSI mode, Spark's default, a value that does not
    fit fails the job. Amounts keep up to eight decimals and are not rounded to cents here; a
    decimal column that has more is an error.
    """
    columns = dict(columns or {})
    names = {f.name: columns.get(f.name, f.name) for f in LEDGER_SCHEMA.fields}
    names |= {k: columns.get(k, k) for k in keys}
    there = {c.lower(): c for c in df.columns} | {c: c for c in df.columns}
    found = {name: there.get(source, there.get(source.lower())) for name, source in names.items()}
    missing = sorted(names[name] for name, source in found.items() if source is None)
    if missing:
        raise ValueError(f"ledger source lacks columns {missing}; it has {df.columns}")
    amount = df.schema[found["amount"]].dataType
    if isinstance(amount, T.DecimalType) and amount.scale > RAW_DECIMALS:
        raise ValueError(f"amounts of {amount.simpleString()} have more decimals than {RAW} keeps")
    types = {f.name: f.dataType for f in LEDGER_SCHEMA.fields}
    return df.select(*[
        F.col(f"`{source}`").cast(types.get(name, T.StringType())).alias(name)
        for name, source in found.items()
    ])


def read_ledger(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    columns: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
    year: int | None = None,
    folders: Mapping[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """Ledger from files. Partition them by posting date, month or year to prune the scan.

    Files partitioned by posting date are pruned by the report's own range. For folders by year,
    or by year and month, give the report's ``year`` and the folder columns as ``folders``:
    {"year": "y"} or {"year": "y", "month": "m"} with months 1 to 12. Other years' folders are
    then not even listed; the folders must agree with the posting dates.

    CSV files need a header, and columns are found by its names. The text formats are read as
    text and cast like any source, and a malformed line fails the job. JSON takes a pass over the
    data to learn its field names, so that a misspelt one is an error; a field that some lines
    lack is NULL there. ``samplingRatio`` shortens that pass.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true").option("mode", "FAILFAST")
    elif fmt == "json":
        reader = reader.option("primitivesAsString", "true").option("mode", "FAILFAST")
    df = reader.load(path)
    if folders:
        if year is None or "year" not in folders:
            raise ValueError("folders need the report's year and the column of the year folders")
        df = df.where(F.col(f"`{folders['year']}`") == year)
        if "month" in folders:
            df = df.where(F.col(f"`{folders['month']}`").between(1, 12))
    return as_ledger(df, columns, keys)


def write_ledger(ledger: DataFrame, path: str, by_year: bool = False, mode: str = "error") -> None:
    """Write a ledger as Parquet with its kinds in the form in which they are compared, in a column
    ``kind_key`` beside the original ``kind``, and with each task's rows in order of kind and date,
    so that a scan can skip the row groups of other kinds and dates. ``by_year`` makes folders by
    ``posting_year`` for ``read_stored_ledger``. Nothing is shuffled."""
    stored = ledger.withColumn("kind_key", label_key(F.col("kind")))
    order = ["kind_key", "entry_date"]
    if by_year:
        stored, order = stored.withColumn("posting_year", F.year("entry_date")), ["posting_year", *order]
    writer = stored.sortWithinPartitions(*order).write.mode(mode)
    (writer.partitionBy("posting_year") if by_year else writer).parquet(path)


def read_stored_ledger(
    spark: SparkSession, path: str, keys: Sequence[str] = (), year: int | None = None
) -> DataFrame:
    """Ledger that ``write_ledger`` wrote, with ``kind`` taken from ``kind_key``: reports then push
    their kinds down to the files. ``year`` reads just that year's folder, if there are such."""
    stored = spark.read.parquet(path)
    if "kind_key" not in stored.columns:
        raise ValueError(f"{path} holds no ledger written by write_ledger")
    if year is not None:
        stored = stored.where(F.col("posting_year") == year)
    ledger = as_ledger(stored, {"kind": "kind_key"}, keys)
    return ledger.withColumn("kind", F.col("kind").alias("kind", metadata={PLAIN_KINDS: True}))


def read_ledger_table(
    spark: SparkSession,
    table: str,
    columns: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Ledger from a catalog table."""
    return as_ledger(spark.table(table), columns, keys)


def jdbc_ledger_options(
    url: str,
    table: str,
    year: int,
    partitions: int,
    columns: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
    split_on: tuple[str, str, str] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel database read of one year, split on the posting date.

    Only the needed columns and the year's rows leave the database: they are named in the
    sub-select, which Spark takes as its table (a plain query cannot be split). Where a few
    dates hold much of the year, give ``split_on``, an evenly spread number or date with its
    bounds: ('posting_id', '1', '9000000'). Rows beyond the bounds are still read.
    """
    columns = dict(columns or {})
    day = columns.get("entry_date", "entry_date")
    names = [columns.get(n, n) for n in [*LEDGER_SCHEMA.fieldNames(), *keys]]
    if split_on is not None and split_on[0] not in names:
        names.append(split_on[0])
    first, following = date(year, 1, 1).isoformat(), date(year + 1, 1, 1).isoformat()
    column, lower, upper = split_on or (day, first, following)
    return {
        "url": url,
        "dbtable": f"(SELECT {', '.join(names)} FROM {table} "
        f"WHERE {day} >= '{first}' AND {day} < '{following}') postings",
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_ledger_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    year: int,
    partitions: int,
    columns: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
    split_on: tuple[str, str, str] | None = None,
    **options: str,
) -> DataFrame:
    """Ledger of one year from a database; drivers and logins go in ``options``."""
    split = jdbc_ledger_options(url, table, year, partitions, columns, keys, split_on)
    df = spark.read.format("jdbc").options(**{**split, **options}).load()
    return as_ledger(df, columns, keys)


def read_sql(spark: SparkSession, url: str, text: str, **options: str) -> DataFrame:
    """Result of SQL text run by a database, for results small enough for one connection."""
    return spark.read.format("jdbc").options(url=url, query=text, **options).load()
