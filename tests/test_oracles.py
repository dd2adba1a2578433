"""Every registered query against DuckDB SQL, and the figures known beforehand."""

from __future__ import annotations

import shutil
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import duck, mismatch
from checks.fixture import CONFIG, ledger
from checks.oracles import ORACLES
from checks.queries import QUERIES
from ledgerloom import surplus_table
from ledgerloom.config import MONTH_LABELS

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_without_the_training_data_queries():
    """The subpackage and the pipeline may be gone, or something that only they need."""
    code = "import sys; sys.modules[{!r}] = None; import __spark_entry__ as e; print(*sorted(e.queries()))"
    for name in ("ledgerloom.llm", "corpus_pipeline", "numpy", "public_tokenizers"):
        run = subprocess.run([sys.executable, "-c", code.format(name)], capture_output=True, text=True, cwd=ROOT)
        assert run.stdout.split() == sorted(QUERIES), run.stderr


def test_the_rest_without_the_training_data_folders(tmp_path):
    """A copy of the repository without them answers every report query's name and imports."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=copy)
    assert [line.split() for line in run.stdout.splitlines()] == [sorted(QUERIES)] * 2, run.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert mismatch(spark, connection, SMALL, name) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r["section"] for r in rows} == {"expense", "revenue", "surplus"}


def test_known_figures(spark):
    plain, reduced = surplus_table(ledger(spark, SMALL), CONFIG).orderBy("rank").collect()
    months = [
        "-457658.55", "-486293.08", "-87545.42", "-976803.80",
        "291307.77", "659686.66", "414933.65", "855960.16",
    ]
    assert [plain[m] for m in MONTH_LABELS] == [*map(Decimal, months), None, None, None, None]
    assert plain["total"] == Decimal("213587.39")
    assert [reduced[m] for m in MONTH_LABELS] == [
        Decimal("70141.23") if m == "mai" else None for m in MONTH_LABELS
    ]
