"""Every registered query beside its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from venue_queries import QUERIES
from tools.check_oracles import compare, connect

# what a fit finds has no SQL; ``test_forests`` and ``forest_routing`` hold it against the models
FITTED = {"feature_rank", "model_metrics", "model_rankings"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_query_matches_sql(spark, con, sf_dir, name):
    verdict = compare(spark, con, name, queries()[name], oracle_sql().get(name), sf_dir)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(QUERIES) - set(oracle_sql()) == FITTED
    assert set(oracle_sql()) <= set(queries())


def test_what_the_fits_found(spark, sf_dir):
    ranks = queries()["feature_rank"](spark, sf_dir).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 8)) and sum(r.importance for r in ranks) == pytest.approx(1)
    assert [r.importance for r in ranks] == sorted((r.importance for r in ranks), reverse=True)
    found = {(r.model, r.metric): r.value for r in queries()["model_metrics"](spark, sf_dir).collect()}
    assert len({m for m, _ in found}) == 6
    for (model, metric), value in found.items():
        assert value is None or metric in ("rmse", "n", "positives", "negatives", "r2") or 0 <= value <= 1, (model, metric)
    listed = queries()["model_rankings"](spark, sf_dir).collect()
    assert {(r.model, r["rank"]) for r in listed if r.model == "holdout_forest"} == {("holdout_forest", i) for i in range(1, 8)}


def test_entry(spark):
    assert entry(spark).columns == ["business_id", "avg_growth_rate", "avg_star_change", "years_with_data"]
