from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import types as T

from ledgerloom.llm import shared

ROOT = Path(__file__).resolve().parents[2]
#: Columns that operators use inside under the same names.
CLASHING = ["_d", "_row", "key", "node", "words", "ids", "spans", "n"]


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Tests set a checkpoint folder of their own, as the session names none."""
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    before = shared.shared_dir
    shared.shared_dir = lambda _: folder
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(ROOT))
    yield
    shared.shared_dir = before


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) tuples, with columns whose names clash."""

    def make(rows):
        fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                  T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                  *[T.StructField(c, T.IntegerType()) for c in CLASHING]]
        data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", *range(len(CLASHING))) for r in rows]
        return spark.createDataFrame(data, T.StructType(fields))

    return make


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def run(sql: str, **tables):
        connection = duckdb.connect()
        for name, source in tables.items():
            if isinstance(source, str):
                connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
            else:
                connection.register(name, source)
        return sorted(connection.sql(sql).fetchall(), key=repr), connection.sql(sql).columns

    return run
