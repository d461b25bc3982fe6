"""The three jobs from JSON files to exported prices."""

from __future__ import annotations

import json
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from pricewright.functions.calendar import Cycle
from pricewright.plans import jobs

START = date(2017, 1, 2)
CYCLE = Cycle(START, date(2017, 1, 16))


def make_inputs(root):
    rng = random.Random(2)
    raw, parameters, results = (root / n for n in ("raw", "parameters", "results"))
    for folder in (raw, parameters, results):
        folder.mkdir()
    (parameters / "processed_time_df.csv").write_text("start,end\n2017-01-02,2017-01-16\n")
    stores = ["store,hhi,traffic"] + [f"{s},{50 + s * 7},{100 + s * 3}" for s in range(1, 7)]
    (parameters / "stores.csv").write_text("\n".join(stores) + "\n")
    products = ["d,b,p,m,c"] + [f"d{p % 2},b{p % 3},p{p},{12 + p},{5 + p / 2}" for p in range(6)]
    (parameters / "products.csv").write_text("\n".join(products) + "\n")
    units = 0
    for store in range(1, 7):
        for n in range(14):
            day = START + timedelta(days=n)
            stamp = f"{day} 10:00:00"
            basket = [f"p{p}" for p in range(6) for _ in range(rng.randint(0, 3))] or ["p0"]
            units += len(basket)
            document = {
                "SalesLogDateTime": stamp,
                "StoreID": store,
                "Transactions": [
                    {
                        "Subtotal": 1.0,
                        "Tax": 0.1,
                        "Total": 1.1,
                        "TransactionDateTime": stamp,
                        "Products": [{"Price": 1.0, "ProductID": p} for p in basket],
                    }
                ],
            }
            name = (day + timedelta(days=1)).strftime("%Y_%m_%d")
            (raw / f"sales_store{store}_{name}_00_00_00.json").write_text(json.dumps(document))
            if n % 7 == 0:
                updates = [
                    {"Price": round(rng.uniform(6 + p / 2, 12 + p), 2), "ProductID": f"p{p}"}
                    for p in range(6)
                ]
                change = {"PriceDate": f"{day} 00:00:00", "StoreID": store, "PriceUpdates": updates}
                (raw / f"pc_store{store}_{day.strftime('%Y_%m_%d')}_00_00_00.json").write_text(
                    json.dumps(change)
                )
    return jobs.Locations(str(raw), str(parameters), str(results)), units


def test_weekly_run(spark, tmp_path):
    at, units = make_inputs(tmp_path)
    cycle = jobs.read_cycle(spark, at)
    assert cycle == CYCLE
    for _ in range(2):
        jobs.aggregate(spark, at, cycle)
    weekly = spark.read.parquet(at.sales)
    assert weekly.agg(F.sum("sales")).first()[0] == units
    assert spark.table("df_sales").agg(F.sum("sales")).first()[0] == units
    assert weekly.where("price is null").count() == 0

    assert not jobs.train(spark, at, first_time=False, trees=5, depth=3)
    assert jobs.train(spark, at, first_time=True, trees=5, depth=3)
    assert not jobs.train(spark, at, first_time=True, trees=5, depth=3)
    assert jobs.train(spark, at, first_time=False, trees=5, depth=3)
    assert spark.table("df_model_performance").count() == 2
    assert spark.read.parquet(at.training_rows).count() == weekly.count()

    for _ in range(2):
        jobs.recommend(spark, at, cycle)
    chosen = spark.read.parquet(at.recommendations)
    last = weekly.where("week_start = '2017-01-09' and group_val = 'treatment'")
    assert chosen.count() == last.select("store_id", "product_id").distinct().count() > 0
    assert {str(r[0]) for r in chosen.select("week_start").distinct().collect()} == {"2017-01-16"}
    assert chosen.where("price < cost - 1e-9 or price > msrp + 1e-9").count() == 0
    assert spark.table("df_opt").count() == chosen.count()
    exported = spark.read.text(f"{at.exports}/suggested_prices_2017_01_02")
    assert exported.count() == chosen.count()
    finished = spark.table("df_time_final")
    assert finished.select("step").distinct().count() == 3

    jobs.views(spark, at)
    assert spark.sql("select * from Optimization_Result_Data limit 10").count() == min(10, chosen.count())
    assert spark.sql("select * from Model_Performance").count() == 2
