"""Every registered query with a SQL twin returns exactly the same values in another engine."""

import compare
import pytest

from __spark_entry__ import ORACLES, QUERIES, entry, oracle_sql, queries

SLOW_WITHOUT_SQL = {
    "train_models", "training_runs", "feature_importance_topk", "final_report", "score_with_trained_model",
}


@pytest.fixture(scope="module")
def connection(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, folder, connection, name):
    assert compare.differences(spark, connection, queries()[name], oracle_sql()[name], folder) == []


def test_every_query_has_sql_or_is_a_model_job():
    assert set(QUERIES) - set(ORACLES) == SLOW_WITHOUT_SQL


def test_entry(spark, folder):
    df = entry(spark)
    assert df.columns == ["customer_segment", "customers", "spend_30d", "lowest_score", "highest_score"]
    assert df.agg({"customers": "sum"}).first()[0] == 150
