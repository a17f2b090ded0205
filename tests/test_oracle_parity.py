"""Every SQL-checkable query against its independent DuckDB oracle (sf0.001 by default)."""

import pytest

from strata.plans.compare import compare
from strata.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    ok, msg = compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name])
    assert ok, msg


def test_every_query_is_registered_with_oracle_or_is_a_model():
    models = {"ml_customer_clusters", "ml_demand_forecast", "ml_silhouette",
              "mart_cluster_analysis_kmeans", "mart_forecast_analysis_gbt", "pipeline_checks"}
    assert set(QUERIES) - set(ORACLES) == models
