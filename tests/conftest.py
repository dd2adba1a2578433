from __future__ import annotations

import sys
from collections.abc import Callable, Iterable
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql.types import StringType, StructField, StructType

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.session import local_session  # noqa: E402
from ledgerloom.sources.ledger import LEDGER_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        8, shuffle_partitions=4, **{"spark.driver.memory": "4g", "spark.sql.warehouse.dir": warehouse}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_ledger(spark) -> Callable:
    """Ledger from (month, kind, account, sub_code, amount[, unit]) tuples of year 2001."""

    def make(rows: Iterable[tuple], keyed: bool = False):
        schema = LEDGER_SCHEMA
        if keyed:
            schema = StructType([*LEDGER_SCHEMA.fields, StructField("unit", StringType())])
        data = [
            (date(2001, r[0], 5), *r[1:4], None if r[4] is None else Decimal(str(r[4])), *r[5:])
            for r in rows
        ]
        return spark.createDataFrame(data, schema)

    return make


def as_dicts(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]
