"""Every query against its independent DuckDB form."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, same_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
TRAINED = ("train_", "segment_customers", "cluster_profile", "run_ml")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    same_rows(QUERIES[name](spark, FOLDER), duck, ORACLES[name])


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(QUERIES)


def test_oracle_integers_are_not_wide(duck):
    for name, sql in ORACLES.items():
        kinds = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
        wide = {c for c, kind in kinds.items() if kind == "HUGEINT" or kind.startswith("DECIMAL")}
        assert not wide, (name, wide)


@pytest.mark.parametrize(
    "name", sorted(n for n in set(QUERIES) - set(ORACLES) if not n.startswith(TRAINED))
)
def test_rows_only(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
