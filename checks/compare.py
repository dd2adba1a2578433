"""Run every query against its DuckDB oracle: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> str:
    return format(value, "f") if isinstance(value, Decimal) else repr(value)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def mismatch(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """What differs between the two engines, or None."""
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = connection.sql(ORACLES[name])
    theirs = _rows(found.columns, found.fetchall())
    if sorted(df.columns) != sorted(found.columns):
        return f"columns {sorted(df.columns)} != {sorted(found.columns)}"
    types = {c: t.simpleString() for c, t in zip(df.columns, [f.dataType for f in df.schema])}
    named = {"decimal": "DECIMAL", "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT"}
    for column, type_ in zip(found.columns, found.types):
        expected = types[column]
        for ours_, theirs_ in named.items():
            expected = theirs_ + expected[len(ours_):] if expected.startswith(ours_) else expected
        if expected.upper() != str(type_).upper():
            return f"type of {column}: {types[column]} != {type_}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"first difference\n  spark  {mine}\n  duckdb {other}"
    return None


def main() -> None:
    from ledgerloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name in names:
        problem = mismatch(spark, connection, sf_dir, name) if name in ORACLES else "no oracle"
        bad += problem is not None
        print(f"{name}: {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
