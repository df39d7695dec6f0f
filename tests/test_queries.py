"""Every named query against its SQL on the smallest tables."""

import importlib.util
import pathlib

import pytest

import __spark_entry__ as contract
from ledgerspan.plans.oracle import ORACLE_SQL
from ledgerspan.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parents[1]
spec = importlib.util.spec_from_file_location("compare", ROOT / "tools" / "compare.py")
compare = importlib.util.module_from_spec(spec)
spec.loader.exec_module(compare)

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="test tables not present")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    problems, *_ = compare.compare(spark, compare.connect(SF_DIR), SF_DIR, name)
    assert problems == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
