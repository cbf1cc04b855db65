"""Every registered query with an oracle SQL equals DuckDB on the small scale factor."""

import pytest

from shiplens.plans.check import compare, duck_connect
from shiplens.plans.registry import ORACLE, QUERIES

SQL_NAMES = sorted(n for n in QUERIES if n in ORACLE)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connect(sf_dir)


def test_every_query_has_oracle_or_is_model():
    rows_only = {n for n in QUERIES if n not in ORACLE}
    assert rows_only <= {"model_eval", "zones_model_eval", "train_time_model", "train_cost_model", "quantile_predictions", "batch_predict", "predict_with_quantiles",
                         "predict_transit_only", "predict_cost_only"}


@pytest.mark.parametrize("name", SQL_NAMES)
def test_matches_duckdb(spark, sf_dir, con, name):
    res = compare(spark, name, sf_dir, con)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["duck_rows"], res
    assert res["values_match"], res
