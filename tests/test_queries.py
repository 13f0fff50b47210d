"""Every registered query against its SQL oracle, and the driver contract."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry

ROOT = str(Path(__file__).resolve().parent.parent)
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, oracle, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], oracle) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["ts", "value", "is_outlier_value"]
    assert result.count() == 120


def test_entry_works_without_the_training_operators():
    code = (
        "import sys; sys.modules['millrace.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; q = e.queries()\n"
        "assert q and not any(n.startswith('op1') or n == 'pipeline' for n in q) and set(e.oracle_sql()) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
