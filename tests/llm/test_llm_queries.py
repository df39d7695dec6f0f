"""Every query of the subpackage that has SQL against it, on the smallest tables."""

from __future__ import annotations

import importlib.util
import pathlib

import pytest
from helpers import SF

from ledgerspan.llm.queries import ORACLE_SQL, QUERIES

ROOT = pathlib.Path(__file__).resolve().parents[2]
spec = importlib.util.spec_from_file_location("compare_llm", ROOT / "tools" / "compare.py")
compare = importlib.util.module_from_spec(spec)
spec.loader.exec_module(compare)


def test_names():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    problems, *_ = compare.compare(spark, compare.connect(SF), SF, name)
    assert problems == []
