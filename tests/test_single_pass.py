"""Steps that read or place their rows once."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from pricewright.operators import candidates, demand, experiment, optimize
from pricewright.plans import registered
from pricewright.sources import scratch


@pytest.fixture
def folder(spark, tmp_path):
    lines = [
        (o, n, 1 + (o + n) % 3, 1 + o % 2, 0.05 * (n % 2), datetime(1993 + o % 6, 1 + n, 1 + o))
        for o in range(12)
        for n in range(4)
    ]
    made = {
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_discount double, l_shipdate timestamp"),
        "part": ([(k, f"a d{k % 2} c{k}", f"Brand#1{k}", 90.0 + k) for k in (1, 2, 3)], "p_partkey long, p_name string, p_brand string, p_retailprice double"),
        "supplier": ([(1, 10.0), (2, 30.0)], "s_suppkey long, s_acctbal double"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_placed_once(spark, folder):
    """Transactions and documents are grouped where the units lie."""
    assert plan_of(registered._sales_documents(spark, folder)).count("Exchange hashpartitioning") == 1
    days = registered.flatten_nested_sales(spark, folder)
    assert days.where("sale_day IS NOT NULL").count() == 48


def test_training_rows_are_made_once(spark, folder, monkeypatch):
    stored, overwrite = [], registered.tables.overwrite

    def storing(df, path):
        stored.append(plan_of(df))
        overwrite(df, path)

    monkeypatch.setattr(registered.tables, "overwrite", storing)
    assert registered.training_rows(spark, folder).count() > 10
    assert len(stored) == 2 and not any("Join" in plan for plan in stored)


def test_categories_are_read_from_their_store(spark):
    rows = [("d", "x", 1.0), ("d", "y", 2.0), ("e", "y", 3.0)]
    made = demand.encode(spark.createDataFrame(rows, "department_id string, brand_id string, price double"))
    plan = plan_of(made)
    assert "Scan parquet" in plan and "ExistingRDD" not in plan and "LocalTableScan" not in plan
    assert {(r.field, r.category, r.rows, r.number) for r in made.collect()} == {
        ("department_id", "d", 2, 0), ("department_id", "e", 1, 1), ("brand_id", "y", 2, 0), ("brand_id", "x", 1, 1)
    }


def test_files_of_a_cycle_are_put_in_place_by_tasks(spark, folder, monkeypatch):
    options, option = {}, DataFrameWriter.option

    def noting(self, key, value):
        options[key] = value
        return option(self, key, value)

    monkeypatch.setattr(DataFrameWriter, "option", noting)
    rows = registered.read_cycle_logs(spark, folder).collect()
    assert options["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
    assert sum(r.units for r in rows) == 24


def test_what_a_stored_table_shuffled_is_removed(spark, monkeypatch):
    seen, parquet = [], DataFrameWriter.parquet

    def noting(self, *args, **more):
        seen.append(spark.conf.get(scratch._CLEANUP, "false"))
        return parquet(self, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", noting)
    before = spark.conf.get(scratch._CLEANUP, "false")
    staged = scratch.stage(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count(), "counts")
    assert seen == ["true"] and spark.conf.get(scratch._CLEANUP, "false") == before
    scratch.discard(staged)
    assert spark.read.parquet(staged.staged_at).count() == 0


def test_sales_of_other_stores_are_left_out_before_they_are_grouped(spark, folder):
    """The rows are those of treatment stores; before, every store's sales were grouped and joined."""
    made = registered.treated(spark, folder)
    want = experiment.treated(registered.aggregated(spark, folder))
    assert made.columns == want.columns
    assert sorted(made.collect()) == sorted(want.collect()) and made.count() > 5
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_product_rows_are_shuffled_once_for_their_grid(spark, folder):
    grid = candidates.on_grid(scratch.stage(registered.offered(spark, folder, every_week=True), "products"))
    assert grid.count() > 5
    grid.collect()
    plan = plan_of(grid).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 1 and "ReusedExchange" in plan


def test_the_search_empties_what_nothing_reads(spark, folder):
    products = scratch.stage(registered.offered(spark, folder, every_week=True), "products")
    known = len(scratch._staged)
    best = optimize.best_sum(products, registered.MODEL)
    full = {path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path in scratch._staged[known:] if spark.read.parquet(path).count()}
    assert full == {"best-sums"}
    # Of a product's prices only the one picked is kept.
    rows = best.collect()
    assert rows and all(len(p.choices) == 1 and p.choices[0].price_idx == i for r in rows for p, i in zip(r.products, r.picks, strict=True))


def test_candidates_are_made_from_a_stored_grid(spark, folder):
    plan = plan_of(registered.scored_candidates(spark, folder))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
