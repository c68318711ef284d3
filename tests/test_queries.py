"""Every registered query against its SQL twin, at the scale the correctness gate uses."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from kerbside.queries import all_queries
from tests.compare import assert_same, duckdb_over

SF_DIR = "/root/testdata/sf0.01"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(ORACLES[name])
    assert_same(result, relation)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 876
    assert result.columns[:4] == ["service_type", "zone_id", "ts_hour", "pickups"]


@pytest.mark.parametrize("blocked", ["ahocorasick", "zstandard", "public_tokenizers", "corpus_pipeline", "kerbside.llm"])
def test_trip_queries_do_without_what_only_the_others_need(blocked):
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(*sorted(e.queries()))"
    root = Path(contract.__file__).parent
    found = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert found.stdout.split() == sorted(all_queries())
