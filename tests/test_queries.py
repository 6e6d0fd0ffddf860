"""Every registered query next to its SQL, on the smallest tables."""

import duckdb
import pytest

from classkit.plans import ORACLES, QUERIES
from tools.check_queries import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    mine = rows_of(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert mine == rows_of(columns, result.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize(
    "name", ["mlp_report", "mlp_test_summary", "mlp_early_stop_history", "boosted_binary_report", "boosted_tree_nodes"]
)
def test_trained_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
