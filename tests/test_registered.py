"""Registered queries against their SQL, and the shape of their plans."""

from __future__ import annotations

import pytest
from compare import database, difference

from __spark_entry__ import entry, oracle_sql, queries
from pricewright.operators import candidates, experiment, optimize
from pricewright.plans import registered
from pricewright.sources import scratch, star_schema

FOLDER = "/root/testdata/sf0.001"
OWN = sorted(set(oracle_sql()) & set(registered.QUERIES))


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_all_queries_of_the_library_have_sql():
    assert OWN == sorted(registered.QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", OWN)
def test_same_rows_as_sql(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_store_clusters(spark):
    rows = experiment.cluster_stores(star_schema.stores(spark, FOLDER)).collect()
    assert len({r["cluster_val"] for r in rows}) == 3
    assert len({r["store_id"] for r in rows}) == len(rows)


def test_forest_recommendations_are_feasible(spark):
    rows = queries()["forest_recommendations"](spark, FOLDER)
    assert rows.count() == queries()["latest_treated"](spark, FOLDER).count()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["recommend_every_week", "aggregated_sales", "profit_gain", "step_times"])
def test_plans_stay_in_the_jvm_and_make_no_products(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan


def test_candidates_are_never_shuffled(spark):
    """Between candidates and the bounds of their sums lies no exchange."""
    products = scratch.stage(registered.offered(spark, FOLDER, every_week=True), "products")
    bounds = optimize.bounds(products, registered.MODEL)

    def exchanges(df):
        return plan_of(df).count("Exchange hashpartitioning")

    assert exchanges(bounds) == exchanges(candidates.sums(products)) <= exchanges(candidates.on_grid(products)) + 1
