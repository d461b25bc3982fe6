"""Sales, experiment, features, sources, sinks, registry and reports on small frames."""

from __future__ import annotations

import json
import math
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from pricewright.functions.calendar import Cycle, latest, to_day
from pricewright.operators import demand, experiment, features, optimize, regression, reports, sales
from pricewright.sources import dimensions, logs, registry, scratch, tables

CYCLE = Cycle(date(2017, 1, 2), date(2017, 1, 16))


def test_missing_price_is_kept_and_double_price_fails(spark):
    week = date(2017, 1, 2)
    weekly = spark.createDataFrame(
        [(week, "1", "a", 3), (week, "1", "b", 4)],
        "week_start date, store_id string, product_id string, sales bigint",
    )
    price = (week, "1", "a", "2017-01-02 00:00:00", 2.0)
    schema = "week_start date, store_id string, product_id string, date string, price double"
    got = sales.attach_price(weekly, spark.createDataFrame([price], schema))
    assert {(r["product_id"], r["price"]) for r in got.collect()} == {("a", 2.0), ("b", None)}
    doubled = spark.createDataFrame([price, price], schema)
    with pytest.raises(Exception, match="more than one price change"):
        sales.attach_price(weekly, doubled).collect()


def test_group_price_counts_rows_without_price(spark):
    rows = [("w", "1", "d", 2.0, 4.0), ("w", "1", "d", None, 4.0), ("w", "1", "d", 4.0, 4.0)]
    df = spark.createDataFrame(
        rows, "week_start string, store_id string, department_id string, price double, msrp double"
    )
    got = features.price_features(df).orderBy(F.asc_nulls_last("price")).collect()
    assert [(r["rl_price"], r["discount"]) for r in got] == [(1.0, 0.5), (2.0, 0.0), (None, None)]


def test_standardize_without_spread(spark):
    one = spark.createDataFrame([("1", 5.0, 1.0)], "store_id string, avg_hhi double, avg_traffic double")
    got = features.standardize(one, experiment.ATTRIBUTES).first()
    assert (got["avg_hhi_std"], got["avg_traffic_std"]) == (0.0, 0.0)


@pytest.mark.parametrize("size, want", [(1, (0, 0)), (2, (1, 1)), (3, (1, 2)), (501, (250, 251))])
def test_store_split(spark, size, want):
    df = spark.range(size).select(
        F.col("id").cast("string").alias("store_id"), F.lit(0).alias("cluster_val")
    )
    first = experiment.assign_groups(df).collect()
    groups = [r["group_val"] for r in first]
    assert (groups.count("treatment"), groups.count("control")) == want
    assert groups.count("other") == (size == 1)
    ordered = sorted(first, key=lambda r: (r["rand"], r["store_id"]))
    assert [r["cum_dist"] for r in ordered] == [(i + 1) / size for i in range(size)]
    assert sorted(first) == sorted(experiment.assign_groups(df.repartition(3)).collect())
    assert size < 3 or sorted(first) != sorted(experiment.assign_groups(df, "other seed").collect())


def test_clusters(spark):
    schema = "store_id string, avg_hhi double, avg_traffic double"
    rows = [(str(i), float(i // 4 * 100 + i), float(i // 4 * 50)) for i in range(12)]
    got = experiment.cluster_stores(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 12 and len({r["cluster_val"] for r in got}) == 3
    two = experiment.cluster_stores(spark.createDataFrame(rows[:2], schema)).collect()
    assert {r["cluster_val"] for r in two} == {0}


def test_stored_groups_are_reused_and_read_errors_are_not_hidden(spark, tmp_path):
    path = str(tmp_path / "groups")
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([("1", "treatment")], "store_id string, group_val string")

    for _ in range(2):
        assert experiment.load_or_assign(spark, path, build).count() == 1
    assert len(built) == 1
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        experiment.load_or_assign(spark, str(broken), build).count()
    assert len(built) == 1


def write_log(folder, name, document):
    (folder / name).write_text(json.dumps(document, indent=2))


def sales_log(store, stamp, products):
    return {
        "SalesLogDateTime": stamp,
        "StoreID": store,
        "Transactions": [
            {
                "Subtotal": 1.0,
                "Tax": 0.0,
                "Total": 1.0,
                "TransactionDateTime": stamp,
                "Products": [{"Price": 1.0, "ProductID": p} for p in products],
            }
        ],
    }


def test_log_files_of_the_cycle(spark, tmp_path):
    days = {
        "2017_01_02": "2017-01-01 09:00:00",
        "2017_01_03": "2017-01-02 09:00:00",
        "2017_01_16": "2017-01-1509:00:00",
        "2017_01_17": "2017-01-16 09:00:00",
    }
    for day, stamp in days.items():
        write_log(tmp_path, f"sales_store1_{day}_00_00_00.json", sales_log(1, stamp, ["a", "a", "b"]))
        change = {"PriceDate": stamp, "StoreID": 1, "PriceUpdates": [{"Price": 2.5, "ProductID": "a"}]}
        write_log(tmp_path, f"pc_store1_{day}_00_00_00.json", change)
    sold = logs.flatten_sales(
        logs.read_sales_logs(spark, logs.cycle_globs(str(tmp_path), CYCLE, "sales"))
    )
    weekly = {
        (str(r["week_start"]), r["store_id"], r["product_id"], r["sales"])
        for r in sales.weekly_sales(sold, CYCLE).collect()
    }
    assert weekly == {
        ("2017-01-02", "1", "a", 2),
        ("2017-01-02", "1", "b", 1),
        ("2017-01-09", "1", "a", 2),
        ("2017-01-09", "1", "b", 1),
    }
    changes = logs.flatten_prices(
        logs.read_price_changes(spark, logs.cycle_globs(str(tmp_path), CYCLE, "prices"))
    )
    assert [(r["product_id"], r["store_id"], r["price"]) for r in changes.collect()] == [("a", "1", 2.5)]
    names = spark.createDataFrame([(f"/x/sales_store1_{d}_00_00_00.json",) for d in days], "n string")
    chosen = names.where(logs.in_cycle(F.col("n"), CYCLE, "sales")).count()
    assert chosen == 2


def test_dimension_file(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text('"dep","br","prod","m","c"\n"d1","b1","p,1",10.5,4\nd2,b2,p2,,5\n')
    got = [tuple(r) for r in dimensions.read_products(spark, str(path)).collect()]
    assert got == [("d1", "b1", "p,1", 10.5, 4.0), ("d2", "b2", "p2", None, 5.0)]


def test_cycle_file(spark, tmp_path):
    path = tmp_path / "processed_time_df.csv"
    path.write_text("start,end\n2017-01-02,2017-01-16\n")
    assert dimensions.read_cycle(spark, str(path)) == CYCLE
    path.write_text("start,end\n")
    with pytest.raises(ValueError):
        dimensions.read_cycle(spark, str(path))


EARLIER = Cycle(date(2016, 12, 19), date(2017, 1, 2))


def test_late_sales_add_to_their_week(spark):
    rows = [(date(2017, 1, 2), "1", "p", 3, 2.5, date(2017, 1, 2)), (date(2017, 1, 2), "1", "p", 1, None, date(2017, 1, 9))]
    df = spark.createDataFrame(
        rows, "week_start date, store_id string, product_id string, sales bigint, price double, cycle_start date"
    )
    assert [tuple(r) for r in sales.add_up(df).collect()] == [(date(2017, 1, 2), "1", "p", 4, 2.5)]


def test_bad_input_stops_the_job(spark, tmp_path):
    good = '{"SalesLogDateTime": "2017-01-02 00:00:00", "StoreID": "1", "Transactions": []}'
    for name, text in (("cut", good[:40]), ("good", good)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(text)
    assert logs.read_sales_logs(spark, str(tmp_path / "good")).count() == 1
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        logs.read_sales_logs(spark, str(tmp_path / "cut")).collect()
    times = spark.createDataFrame([("2017-01-02 10:00:00",), (None,), ("2017-01-0210:00:00",)], "t string")
    assert [r[0] for r in times.select(to_day(F.col("t"))).collect()] == [date(2017, 1, 2), None, date(2017, 1, 2)]
    with pytest.raises(Exception, match="unreadable time: noon"):
        spark.createDataFrame([("noon",)], "t string").select(to_day(F.col("t"))).collect()
    path = tmp_path / "products.csv"
    path.write_text("d,b,p,m,c\nd1,b1,p1,,2.5\n")
    assert dimensions.read_products(spark, str(path)).first()["msrp"] is None
    path.write_text("d,b,p,m,c\nd1,b1,p1,cheap,2.5\n")
    with pytest.raises(Exception, match="msrp is no number: cheap"):
        dimensions.read_products(spark, str(path)).collect()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        sparkContext = type("C", (), {"getCheckpointDir": lambda self: None})()

        def __init__(self, **settings):
            self.conf = type("R", (), {"get": lambda self, k, d=None: settings.get(k, d)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.folder(Session(**{"spark.master": "yarn"}), "x")
    given = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://shared/"}
    assert scratch.folder(Session(**given), "x").startswith("hdfs://shared/x-")


def test_staged_tables_are_released(spark):
    staged = scratch.stage(spark.range(10), "ten")
    path = scratch._staged[-1]
    assert staged.count() == 10
    scratch.release(spark)
    assert spark.read.parquet(path).count() == 0


def test_encoding_and_training_repeat(spark):
    rows = [(f"d{n % 2}", f"b{n % 3}", 1.0 + n, 2.0, 3.0, 1.0, 0.1, n % 5) for n in range(60)] + [("d1", "b0", 1.0, 2.0, 3.0, 1.0, 0.1, 1)]
    columns = [*demand.CATEGORICAL, *demand.NUMERICAL, demand.LABEL]
    df = spark.createDataFrame(rows, columns)
    found = {(r.field, r.category): (r.rows, r.number, r.slot) for r in demand.encode(df).collect()}
    assert found["department_id", "d1"] == (31, 0, 0) and found["department_id", "d0"] == (30, 1, 1)
    assert found["brand_id", "b0"] == (21, 0, 0) and found["brand_id", "b1"] == (20, 1, 1)
    trees = [demand.train(df.repartition(n), trees=4, depth=3).model.stages[-1].toDebugString for n in (2, 7)]
    assert trees[0].split("\n", 1)[1] == trees[1].split("\n", 1)[1]


def weekly_frame(spark, weeks):
    return spark.createDataFrame(
        [(date(2017, 1, d), "1", n) for d, n in weeks], "week_start date, store_id string, n int"
    )


def test_weeks_are_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "weeks")
    tables.write_weeks(weekly_frame(spark, [(2, 1), (9, 2)]), path, EARLIER)
    tables.write_weeks(weekly_frame(spark, [(2, 5), (9, 3), (9, 4)]), path, CYCLE)
    tables.write_weeks(weekly_frame(spark, [(9, 3), (9, 4)]), path, CYCLE)
    df = tables.read_weeks(spark, path)
    rows = [(2, 1), (9, 2), (9, 3), (9, 4)]
    assert sorted((r["week_start"].day, r["n"]) for r in df.collect()) == rows
    plan = latest(df, CYCLE)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_start" in plan
    assert latest(df, CYCLE).count() == 3


def test_catalog_tables(spark):
    tables.save_weeks_table(weekly_frame(spark, [(2, 1), (9, 2)]), "weeks_table", EARLIER)
    tables.save_weeks_table(weekly_frame(spark, [(2, 7), (9, 3)]), "weeks_table", CYCLE)
    tables.save_weeks_table(weekly_frame(spark, [(9, 3)]), "weeks_table", CYCLE)
    got = sorted((r["week_start"].day, r["n"]) for r in tables.read_table(spark, "weeks_table").collect())
    assert got == [(2, 1), (9, 2), (9, 3)]
    reports.log_step(spark, "timings", "a", 1.5, "2017-01-02")
    reports.log_step(spark, "timings", "b", 2.0, "2017-01-02")
    assert spark.table("timings").count() == 2


def test_price_export(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "1", date(2017, 1, 16), 2.5)],
        "product_id string, store_id string, week_start date, price double",
    )
    for _ in range(2):
        path = tables.export_prices(df, str(tmp_path), CYCLE)
    assert path.endswith("suggested_prices_2017_01_02")
    assert [r[0] for r in spark.read.text(path).collect()] == ["a,1,2017-01-16 00:00:00,2.5"]


def test_step_times_keep_timings_without_a_place(spark):
    df = spark.createDataFrame([("a", 1.0, "d1"), (None, 2.0, "d1"), ("a", 3.0, None), (None, 4.0, None)], reports.STEP_TIMES)
    rows = [("a", "d1", 1.0), (None, "d1", 2.0), ("a", None, 3.0), (None, None, 4.0)]
    assert sorted(map(tuple, reports.step_times(df).collect()), key=repr) == sorted(rows, key=repr)


def test_standardizing_makes_no_subquery(spark):
    df = spark.createDataFrame([("1", 1.0, 5.0), ("2", 3.0, 5.0)], "store_id string, avg_hhi double, avg_traffic double")
    plan = experiment.cluster_by_centers(df, ((0.0, 0.0), (1.0, 1.0)))._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in plan


def test_step_times_are_complete(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "d1"), ("a", 2.0, "d2"), ("b", 3.0, "d2")], reports.STEP_TIMES
    )
    got = {tuple(r) for r in reports.step_times(df).collect()}
    assert got == {("a", "d1", 1.0), ("a", "d2", 2.0), ("b", "d2", 3.0), ("b", "d1", 0.0)}


def test_mape_and_gain(spark):
    key = "week_start date, store_id string, product_id string"
    week = date(2017, 1, 2)
    chosen = spark.createDataFrame([(week, "1", "a", 6.0), (week, "1", "b", 4.0)], f"{key}, pred_demand double")
    sold = spark.createDataFrame(
        [
            (week, "1", "a", 4, 3.0, 1.0, "treatment"),
            (week, "1", "b", 4, 2.0, 1.0, "treatment"),
            (week, "2", "a", 2, 4.0, 1.0, "control"),
            (week, "3", "a", 1, None, 1.0, "other"),
        ],
        f"{key}, sales bigint, price double, cost double, group_val string",
    )
    assert reports.mape(chosen, sold).first()["mape"] == 0.25
    gain = reports.profit_gain(sold).first()
    assert (gain["profit_gain"], gain["volume_change"], gain["price_change"]) == (1.0, 3.0, -0.375)


def training_rows(spark):
    rows = []
    for i in range(400):
        price = 5.0 + i % 40 / 4
        rows.append((f"d{i % 2}", f"b{i % 3}", price, 1.0, 2.0, price / 10, 1 - price / 20, 60 - int(3 * price)))
    return spark.createDataFrame(
        rows,
        "department_id string, brand_id string, price double, avg_hhi double, avg_traffic double,"
        " rl_price double, discount double, sales int",
    )


def test_forest_and_registry(spark, tmp_path):
    root = str(tmp_path / "Models")
    rows = training_rows(spark)
    assert registry.should_train(spark, root, first_time=True)
    assert not registry.should_train(spark, root, first_time=False)
    small = demand.train(rows, trees=3, depth=2)
    registry.publish(small.model, spark, root)
    forest = demand.train(rows, trees=10, depth=5)
    newest = registry.publish(forest.model, spark, root)
    assert registry.should_train(spark, root, first_time=False)
    assert not registry.should_train(spark, root, first_time=True)
    assert registry.latest_path(spark, root) == newest
    loaded = demand.Forest(registry.load_latest(spark, root))
    fit = demand.evaluate(demand.score(loaded, rows)).first()
    assert fit["R2"] > 0.9 and fit["RMSE"] < 5
    unseen = rows.limit(3).withColumn("brand_id", F.lit("new brand"))
    assert demand.score(loaded, unseen).where("prediction > 0").count() == 3
    missing = rows.limit(3).withColumn("price", F.lit(None).cast("double"))
    assert demand.score(loaded, missing).count() == 0
    stamped = fit.asDict() | {"model_time": "2017-01-09"}
    registry.log_metrics(spark.createDataFrame([stamped]), "performance")
    assert spark.table("performance").first()["model_time"] == "2017-01-09"


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 3.0), (5, 4.0), (7, None)], "sales int, prediction double")
    fit = demand.evaluate(df).first()
    assert fit["RMSE"] == pytest.approx((2 / 3) ** 0.5) and fit["R2"] == pytest.approx(0.75)


def test_preview_and_weeks(spark):
    df = weekly_frame(spark, [(9, 2), (2, 1), (2, 5)])
    assert [r["n"] for r in reports.preview(df, 2, ["n"]).collect()] == [1, 2]
    assert [r[0].day for r in reports.weeks(df).collect()] == [2, 9]


def test_lines_from_moments(spark):
    """Moments of parts add up to the fit of all; one x or no pair has no line."""
    rows = [("a", s, float(x), 3.0 - 0.5 * x + (x % 3)) for s in "12" for x in range(1, 9)]
    rows += [("b", "1", 2.0, 5.0), ("b", "2", 2.0, 6.0), ("c", "1", None, 1.0), ("c", "1", 1.0, None)]
    df = spark.createDataFrame(rows, "k string, s string, x double, y double")
    stored = regression.moments(df, ["k", "s"], F.col("x"), F.col("y"))
    whole = {r.k: r for r in regression.lines(regression.add_up(stored, ["k"])).collect()}
    want = df.where("k = 'a'").agg(F.regr_slope("y", "x").alias("s"), F.regr_intercept("y", "x").alias("i")).first()
    assert set(whole) == {"a"} and whole["a"].observations == 16
    assert abs(whole["a"].slope - want.s) < 1e-9 and abs(whole["a"].intercept - want.i) < 1e-9
    assert regression.add_up(stored, []).first().observations == 18


def test_fitted_demand_prices_each_product_by_its_own_line(spark):
    lines = spark.createDataFrame([("a", 20.0, -1.0), ("b", 9.0, -0.5)], "product_id string, intercept double, slope double")
    week = date(2017, 1, 9)
    rows = [("1", p, "d", "b", 12.0, 3.0, 1.0, 2.0, week) for p in "abc"]
    df = spark.createDataFrame(rows, "store_id string, product_id string, department_id string, brand_id string, msrp double, cost double, avg_hhi double, avg_traffic double, week_start date")
    chosen = {r.product_id: (r.price, r.pred_demand) for r in optimize.recommend(df, demand.Fitted(base=4.0, lines=lines)).collect()}

    def best(base, slope):
        grid = [3.0 + j for j in range(10)]
        return max(((p, float(max(math.floor(base + slope * p + 0.5), 0))) for p in grid), key=lambda c: ((c[0] - 3.0) * c[1], -c[0]))

    assert chosen == {"a": best(20.0, -1.0), "b": best(9.0, -0.5), "c": best(4.0, 0.0)}


def test_a_write_that_fails_half_way_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "weeks")
    tables.write_weeks(weekly_frame(spark, [(2, 5), (9, 3)]), path, CYCLE)
    before = sorted(map(tuple, tables.read_weeks(spark, path).collect()))
    broken = weekly_frame(spark, [(2, 7), (9, 8)]).withColumn(
        "n", F.when(F.col("n") == 8, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n"))
    )
    with pytest.raises(Exception, match="lost"):
        tables.write_weeks(broken, path, CYCLE)
    assert sorted(map(tuple, tables.read_weeks(spark, path).collect())) == before
    assert spark.read.parquet(path).count() == 2
    tables.write_weeks(weekly_frame(spark, [(2, 7)]), path, CYCLE)
    assert [r.n for r in tables.read_weeks(spark, path).collect()] == [7]
    assert [r.n for r in spark.read.parquet(path).collect()] == [7]


def test_short_lines_of_a_dimension_are_errors(spark, tmp_path):
    for n, line in enumerate(("1,b,p,2.5", "1,b,p,2.5,1,9")):
        file = tmp_path / f"products{n}.csv"
        file.write_text(f"D,B,P,M,C\n1,b,q,2.0,1.0\n{line}\n")
        with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
            dimensions.read_products(spark, str(file)).select("product_id").collect()


def test_a_job_empties_its_own_tables_only(spark):
    outside = scratch.stage(spark.range(3), "outside")
    with scratch.job(spark):
        inside = scratch.stage(spark.range(4), "inside")
        assert inside.count() == 4
    assert outside.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        inside.collect()


def test_added_up_rows_come_from_one_row(spark):
    rows = [(date(2017, 1, 2), "1", "p", 1, 2.0, "2017-01-02"), (date(2017, 1, 2), "1", "p", 2, None, "2017-01-09")]
    df = spark.createDataFrame(rows, "week_start date, store_id string, product_id string, sales bigint, price double, date string")
    assert sales.add_up(df).first()[3:] == (3, 2.0, "2017-01-02")


def test_catalog_view_is_seen_by_other_sessions(spark, tmp_path):
    name = f"late_{uuid.uuid4().hex}"
    for rows, cycle in (([(2, 1), (9, 2)], EARLIER), ([(2, 5), (9, 3)], CYCLE)):
        weekly = weekly_frame(spark, rows).select("*", F.lit("p").alias("product_id"), F.col("n").alias("sales"))
        tables.save_weeks_table(weekly, name, cycle, str(tmp_path / name))
    tables.save_view(spark, f"{name}_view", sales.added_up_sql(name, spark.table(name).columns))
    seen = spark.newSession().table(f"{name}_view")
    want = sales.add_up(spark.table(name))
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, want.collect()))
    assert seen.count() == seen.select(*sales.KEY).distinct().count() < spark.table(name).count()


def test_only_files_of_the_cycle_are_opened(spark, tmp_path):
    cycle = Cycle(date(2020, 1, 6), date(2020, 1, 13))
    document = '{"SalesLogDateTime": "x",\n "StoreID": "%s",\n "Transactions": []}'
    for n, day in enumerate(("2020_01_06", "2020_01_07", "2020_01_13", "2020_01_14")):
        inside = tmp_path / f"sales_store{n}_{day}_00_00_00.json"
        inside.mkdir()
        (inside / "part-0.json").write_text(document % n if n in (1, 2) else "{ broken")
    read = logs.read_cycle(spark, str(tmp_path), cycle, "sales")
    assert sorted((r.StoreID, "_2020_01_" in r.source_file) for r in read.collect()) == [("1", True), ("2", True)]
    (tmp_path / "sales_store1_2020_01_07_00_00_00.json" / "part-0.json").write_text("{ broken")
    with pytest.raises(Exception, match="sales_store1_2020_01_07"):
        logs.read_cycle(spark, str(tmp_path), cycle, "sales").collect()


def test_files_are_written_by_tasks_under_their_names(spark, tmp_path):
    """One plain file a name, none hidden is read; before, a folder and a checksum were made for each."""
    rows = [(f"f{n % 7}" if n % 7 else None, n, f"line {n} é" if n != 8 else None) for n in range(3000)]
    df = spark.createDataFrame(rows, "file string, n int, value string").repartition(3, "file").sortWithinPartitions("file", "n")
    for path in (str(tmp_path / "plain"), f"file:{tmp_path}/uri", f"file://{tmp_path}/slashes"):
        logs.write_files(df.select("file", "value"), path)
        found = {p.name: p.read_text() for p in tmp_path.glob("*/files-*/*")}
        assert sorted(found) == [*[f"f{k}" for k in range(1, 7)], "file=__HIVE_DEFAULT_PARTITION__"]
        for name, text in found.items():
            own = [v or "" for f, n, v in rows if (f or "file=__HIVE_DEFAULT_PARTITION__") == name]
            assert text.split("\n") == [*own, ""]
        assert spark.read.option("recursiveFileLookup", True).text(path).count() == 3000
        assert not list(tmp_path.glob("*/files-*/.*"))
