"""Every catalogue query against its DuckDB twin, on the smallest tables."""

import pytest
from compare import DATA, connect, difference

from graphprep.plans.catalog import QUERIES
from graphprep.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def database():
    return connect("sf0.001")


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLE])
def test_matches_twin(spark, database, name):
    assert difference(QUERIES[name](spark, f"{DATA}/sf0.001"), database, ORACLE[name]) == ""


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize(
    "name, work", [("score_triples", "aggregate("), ("negative_samples", "md5("), ("split_hash", "md5("), ("entity_dictionary", "row_number(")]
)
def test_benchmark_does_the_work(spark, name, work):
    """What the benchmark writes keeps the columns that a count would drop."""
    plan = QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert work in plan
