"""Every registered query next to its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
import check

SQL = entry.oracle_sql()
QUERIES = entry.queries()
# Fits of models and clusterings; their parts are tested one by one elsewhere.
LONG = {"model_comparison", "model_cross_validation", "model_random_forest", "model_logistic_regression", "model_risk_scores",
        "model_feature_importance", "model_attribution", "model_attribution_sample", "survival_hazard_ratios",
        "survival_model_concordance", "segment_choose_k", "segment_kmeans_export", "segment_components"}


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("op")))
def test_matches_sql(spark, con, sf, name):
    assert check.compare(QUERIES[name](spark, sf), con, SQL[name]) is None


def test_only_fitted_models_lack_sql():
    assert {name for name in set(QUERIES) - set(SQL) if not re.match(r"op\d+_|pipeline$", name)} == LONG


def test_flagship(spark):
    rows = entry.entry(spark).orderBy("stage_order").collect()
    assert [r["stage_order"] for r in rows] == list(range(1, 9))
