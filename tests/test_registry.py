"""Every registered query against the same question in DuckDB SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry import ORACLES, QUERIES
from tests.conftest import SF, plan_of
from tools.check import compare, connection


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    built = []

    def query(session, sf_dir):
        built.append(QUERIES[name](session, sf_dir))
        return built[0]

    verdict, _ = compare(spark, duck, name, query, ORACLES[name], SF)
    assert verdict.startswith("ok"), verdict
    plan = plan_of(built[0])
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["event_type"] for r in rows} == {"click", "error", "purchase", "signup", "view"}
