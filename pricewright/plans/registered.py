"""The queries the engine registers, each over the whole star-schema tables.

Sums and means of doubles depend on the order of addition in their last bits; such results are
settled to a few digits. Dates come out as text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.functions.calendar import (
    TIMESTAMP_FORMAT,
    Cycle,
    latest,
    price_days,
    sales_days,
)
from pricewright.functions.measures import group_key
from pricewright.operators import (
    candidates,
    demand,
    experiment,
    features,
    optimize,
    regression,
    reports,
    sales,
)
from pricewright.sources import dimensions, logs, registry, scratch, star_schema, tables
from pricewright.sources.star_schema import CYCLE

CENTERS = ((-1.0, -1.0), (0.0, 0.0), (1.0, 1.0))
SEED = "1"
MODEL = demand.Linear(
    base=90.0, price=-0.08, avg_hhi=0.0004, avg_traffic=0.01, rl_price=-25.0, discount=40.0
)

Query = Callable[[SparkSession, str], DataFrame]


def settle(value: Column, digits: int = 6) -> Column:
    """Rounded so that no exact half decides: the borders lie at an odd place between two steps."""
    scale = 10.0**digits
    return F.floor(value * scale + 0.371) / scale


def _text(df: DataFrame) -> DataFrame:
    """Dates as text."""
    return df.select(
        *[F.col(n).cast("string").alias(n) if t == "date" else F.col(n) for n, t in df.dtypes]
    )


# Inputs made from the tables.


def store_groups(spark: SparkSession, folder: str) -> DataFrame:
    clustered = experiment.cluster_by_centers(star_schema.stores(spark, folder), CENTERS)
    return experiment.assign_groups(clustered, SEED)


def aggregated(spark: SparkSession, folder: str, cycle: Cycle = CYCLE) -> DataFrame:
    return sales.attach_dims(
        star_schema.priced_weeks(spark, folder, cycle),
        star_schema.products(spark, folder),
        experiment.for_join(store_groups(spark, folder)),
    )


def treated(spark: SparkSession, folder: str, cycle: Cycle = CYCLE) -> DataFrame:
    """Rows of ``aggregated`` of treatment stores, without the group. Units of other stores are left out before
    they are grouped. Attributes are stored first, so that Spark knows how small they are."""
    attributes = scratch.stage(star_schema.products(spark, folder), "attributes")
    stores = scratch.stage(experiment.for_join(store_groups(spark, folder)), "stores")
    chosen = stores.where("group_val = 'treatment'").select("store_id")
    weekly = star_schema.priced_weeks(spark, folder, cycle, chosen)
    return experiment.treated(sales.attach_dims(weekly, attributes, stores))


def offered(
    spark: SparkSession, folder: str, every_week: bool, cycle: Cycle = CYCLE
) -> DataFrame:
    """Products to price in treatment stores: of the latest week, or of every week in turn."""
    weekly = treated(spark, folder, cycle)
    if not every_week:
        weekly = latest(weekly, cycle)
    return candidates.products(weekly, cycle)


# Sources and sinks.


def dimension_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.folder(spark, "products")
    made = star_schema.products(spark, folder).select(*dimensions.PRODUCT_FIELDS)
    renamed = made.toDF("Department", "Brand", "Product", "Msrp", "Cost")
    renamed.write.option("header", True).option("quoteAll", True).csv(path)
    return dimensions.read_products(spark, path)


def cycle_days(spark: SparkSession, folder: str) -> DataFrame:
    """Units per sales log of the cycle that a control file, made from the ship dates, names."""
    sold = star_schema.sales(spark, folder)
    path = scratch.folder(spark, "cycle")
    ends = sold.agg(
        F.min("sale_day").alias("start"), F.date_add(F.max("sale_day"), 1).alias("end")
    )
    ends.write.option("header", True).csv(path)
    cycle = dimensions.read_cycle(spark, path, CYCLE.days)
    units = sold.groupBy(F.date_add("sale_day", 1).alias("log_date")).agg(
        F.count("*").alias("units")
    )
    changes = price_days(spark, cycle).select(
        F.col("price_date").alias("log_date"), F.lit(True).alias("price_day")
    )
    days = sales_days(spark, cycle).join(units, "log_date", "left")
    return _text(
        days.join(changes, "log_date", "left").select(
            "log_date",
            F.coalesce("units", F.lit(0)).alias("units"),
            F.coalesce("price_day", F.lit(False)).cast("int").alias("price_day"),
        )
    )


def log_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the sales and price files of stores and days, and which of them the cycle reads."""
    logged = (
        star_schema.sales(spark, folder)
        .select("store_id", F.date_add("sale_day", 1).alias("day"))
        .distinct()
    )
    day = F.date_format("day", "yyyy_MM_dd")

    def name(prefix: str) -> Column:
        return F.concat(F.lit(prefix), "store_id", F.lit("_"), day, F.lit("_00_00_00.json"))

    names = logged.select(name("sales_store").alias("sales_file"), name("pc_store").alias("price_file"))
    return names.select(
        "sales_file",
        "price_file",
        logs.in_cycle(F.col("sales_file"), CYCLE, "sales").cast("int").alias("read_sales"),
        logs.in_cycle(F.col("price_file"), CYCLE, "prices").cast("int").alias("read_prices"),
    )


def _sales_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as nested documents, one per order and store and day, with ``sale_day`` beside them.

    Transactions whose units were all discounted carry time text without the blank. Units are placed by their
    document, so both groupings find their rows in place.
    """
    price = F.col("paid") / 1e6
    transactions = (
        star_schema.sales(spark, folder)
        .repartition("store_id", "sale_day", "l_orderkey")
        .groupBy("store_id", "sale_day", "l_orderkey", "l_linenumber")
        .agg(
            F.collect_list(
                F.struct(price.alias("Price"), F.col("product_id").alias("ProductID"))
            ).alias("Products"),
            F.sum("paid").alias("total"),
            F.min("discounted").alias("compact"),
        )
    )
    stamp = F.date_format("sale_day", TIMESTAMP_FORMAT)
    one = F.struct(
        (F.col("total") / 1e6).alias("Subtotal"),
        F.lit(0.0).alias("Tax"),
        (F.col("total") / 1e6).alias("Total"),
        F.when(F.col("compact"), F.replace(stamp, F.lit(" "), F.lit("")))
        .otherwise(stamp)
        .alias("TransactionDateTime"),
        "Products",
    )
    log = F.date_format(F.date_add("sale_day", 1), TIMESTAMP_FORMAT)
    return (
        transactions.groupBy("store_id", "sale_day", "l_orderkey")
        .agg(F.collect_list(one).alias("Transactions"))
        .select("sale_day", log.alias("SalesLogDateTime"), F.col("store_id").alias("StoreID"), "Transactions")
    )


def flatten_nested_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales written as nested documents, one a line, and read back."""
    path = scratch.folder(spark, "sales-logs")
    _sales_documents(spark, folder).drop("sale_day").write.json(path)
    return _text(logs.flatten_sales(logs.read_sales_logs(spark, path, one_per_file=False)))


#: Three years of sales, for files that hold a year each.
THREE_YEARS = Cycle(date(1993, 1, 1), date(1996, 1, 1))


def read_cycle_logs(spark: SparkSession, folder: str) -> DataFrame:
    """All sales written as files of a store and year over many lines; a cycle's files read back.

    A file is one array: a row opens it, one follows for each document, and one shuts it, so no row holds
    a whole file.
    """
    path = scratch.folder(spark, "sales-files")
    after = F.make_date(F.year("sale_day") + 1, F.lit(1), F.lit(1))

    def name(store: str) -> Column:
        day = F.date_format(after, "yyyy_MM_dd")
        return F.concat(F.lit(logs.PREFIX["sales"]), store, F.lit("_"), day, F.lit(logs.SUFFIX)).alias("file")

    made = _sales_documents(spark, folder).withColumn("file", name("StoreID"))
    document = F.struct(*logs.SALES_LOG.names)
    lines = made.select("file", F.lit(1).alias("place"), document.alias("document"))
    files = star_schema.sales(spark, folder).select(name("store_id")).distinct()
    none = F.lit(None).cast(lines.schema["document"].dataType)
    ends = files.select("file", F.explode(F.array(F.lit(0), F.lit(2))).alias("place"), none.alias("document"))
    # A number of its own: the rows are few bytes and many files, which would be merged into a few tasks.
    count = candidates.shuffle_partitions(made)
    rows = lines.union(ends).repartition(count, "file").sortWithinPartitions("file", "place")
    text = F.concat(F.lit(","), F.to_json("document", {"pretty": "true"}))
    value = F.when(F.col("place") == 0, "[{}").when(F.col("place") == 2, "]").otherwise(text)
    logs.write_files(rows.select("file", value.alias("value")), path)
    read = logs.read_cycle(spark, path, THREE_YEARS, "sales")
    log_file = F.regexp_extract("source_file", f"({logs.PREFIX['sales']}[^/=]*)(?:/[^/]*)?$", 1)
    units = F.expr("aggregate(Transactions, 0L, (n, t) -> n + size(t.Products))")
    return (
        read.where("StoreID IS NOT NULL")
        .groupBy(log_file.alias("log_file"), F.col("StoreID").alias("store_id"))
        .agg(F.count("*").alias("documents"), F.sum(units).alias("units"))
    )


def flatten_price_changes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.folder(spark, "price-changes")
    update = F.struct(F.col("price").alias("Price"), F.col("product_id").alias("ProductID"))
    documents = (
        star_schema.price_changes(spark, folder)
        .groupBy(F.col("date").alias("PriceDate"), F.col("store_id").alias("StoreID"))
        .agg(F.collect_list(update).alias("PriceUpdates"))
    )
    documents.write.json(path)
    return _text(logs.flatten_prices(logs.read_price_changes(spark, path, one_per_file=False)))


def append_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly sales written twice under the same weeks, read once."""
    path = scratch.folder(spark, "weeks")
    weekly = sales.weekly_sales(star_schema.sales(spark, folder), CYCLE)
    for _ in range(2):
        tables.write_weeks(weekly, path, CYCLE)
    return _text(tables.read_weeks(spark, path).drop(tables.WRITTEN_BY))


def _two_cycles(spark: SparkSession, folder: str) -> list[tuple[DataFrame, Cycle]]:
    """Weekly sales as two cycles deliver them; first items sold in the month before the border are late."""
    border = CYCLE.start + timedelta(days=7 * CYCLE.days)
    sold = star_schema.sales(spark, folder)
    late = (F.col("l_linenumber") == 1) & (F.datediff(F.lit(border), "sale_day") <= 30)
    first = (F.col("sale_day") < F.lit(border)) & ~late
    cycles = Cycle(CYCLE.start, border, CYCLE.days), Cycle(border, CYCLE.end, CYCLE.days)
    return [
        (sales.weekly_sales(sold.where(part), cycle), cycle)
        for part, cycle in zip((first, ~first), cycles, strict=True)
    ]


def late_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Two cycles written one after another, each twice; late sales add to the weeks of the first."""
    path = scratch.folder(spark, "weeks")
    first, second = _two_cycles(spark, folder)
    for weekly, cycle in (first, second, second, first):
        tables.write_weeks(weekly, path, cycle)
    return _text(sales.add_up(tables.read_weeks(spark, path)))


def catalog_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a catalog table."""
    path = scratch.folder(spark, "weeks-table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    first, second = _two_cycles(spark, folder)
    for weekly, cycle in (first, second, second, first):
        tables.save_weeks_table(weekly, name, cycle, path)
    return _text(sales.add_up(tables.read_table(spark, name)))


def stored_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of stores that a file lists, built and stored once and then read."""
    at = scratch.folder(spark, "stores")
    made = star_schema.stores(spark, folder).select(*dimensions.STORE_FIELDS)
    made.write.option("header", True).csv(f"{at}/stores")
    listed = dimensions.read_stores(spark, f"{at}/stores")

    def build() -> DataFrame:
        return experiment.assign_groups(experiment.cluster_by_centers(listed, CENTERS), SEED)

    def never() -> DataFrame:
        raise AssertionError("stored groups are not built again")

    experiment.load_or_assign(spark, f"{at}/groups", build)
    groups = experiment.load_or_assign(spark, f"{at}/groups", never)
    return groups.select("store_id", "avg_hhi", "avg_traffic", "group_val")


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Training rows stored, stored again and read."""
    path = scratch.folder(spark, "training")
    rows = scratch.stage(features.price_features(aggregated(spark, folder)), "training-rows")
    for _ in range(2):
        tables.overwrite(rows, path)
    return _text(spark.read.parquet(path).select("week_start", "store_id", "product_id", "sales", "price"))


def step_log(spark: SparkSession, folder: str) -> DataFrame:
    """Run times appended to a catalog table in two parts: here the runs of a step and day count."""
    path = scratch.folder(spark, "steps")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    events = spark.read.parquet(f"{folder}/events.parquet")
    lines = events.groupBy(
        F.col("event_type").alias("step"), F.col("ts").cast("date").cast("string").alias("exec_date")
    ).agg(F.count("*").cast("double").alias("time"))
    early = F.col("exec_date") < F.lit(lines.agg(F.max("exec_date")).first()[0])
    for part in (lines.where(early), lines.where(~early)):
        reports.log_steps(part, name, path)
    return tables.read_table(spark, name)


def published_model(spark: SparkSession, folder: str) -> DataFrame:
    """Two small forests published one after the other: the gate, the newest one and its scores."""
    root = scratch.folder(spark, "models")
    rows = scratch.stage(features.price_features(aggregated(spark, folder)), "training")
    before = registry.should_train(spark, root, first_time=True)
    forests = [demand.train(rows, seed, trees=3, depth=4) for seed in (1, 2)]
    paths = [registry.publish(f.model, spark, root) for f in forests]
    name = root.rsplit("/", 1)[-1].replace("-", "_")
    for f in forests:
        fitted = demand.evaluate(demand.score(f, rows))
        logged = fitted.withColumn("model_time", F.lit("newest"))
        registry.log_metrics(logged, name, f"{root}-metrics")
    loaded = demand.Forest(registry.load_latest(spark, root))
    key = ["week_start", "store_id", "product_id"]
    own = demand.score(forests[1], rows).select(*key, "prediction")
    again = demand.score(loaded, rows).select(*key, F.col("prediction").alias("again"))
    equal = own.join(again, key).where(F.col("prediction") == F.col("again"))
    lines = tables.read_table(spark, name).agg(
        F.count("*").alias("metric_lines"), (F.min("R2") > 0).cast("int").alias("fits")
    )
    gates = (
        before,
        not registry.should_train(spark, root, first_time=True),
        registry.should_train(spark, root, first_time=False),
        registry.latest_path(spark, root) == paths[1],
    )
    names = ("trains_first", "then_not_first", "then_again", "newest_found")
    return equal.agg(F.count("*").alias("equal_scores")).join(lines).select(
        *[F.lit(int(g)).alias(n) for g, n in zip(gates, names, strict=True)],
        "equal_scores", "metric_lines", "fits",
    )


def export_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Recommended prices for the week after the cycle, exported and read."""
    root = scratch.folder(spark, "exports")
    path = tables.export_prices(_recommended(spark, folder, every_week=False), root, CYCLE)
    return spark.read.schema(
        "product_id string, store_id string, week_start string, price double"
    ).csv(path)


def sql_views(spark: SparkSession, folder: str) -> DataFrame:
    tables.register({"Aggregated_Sales_Data": aggregated(spark, folder)})
    return _text(
        spark.sql(
            """
            SELECT week_start, department_id, group_val,
                   count(*) AS products, sum(sales) AS units, count(price) AS priced
            FROM Aggregated_Sales_Data
            GROUP BY week_start, department_id, group_val
            """
        )
    )


def preview_sales(spark: SparkSession, folder: str) -> DataFrame:
    order = ["week_start", "store_id", "product_id"]
    return _text(reports.preview(aggregated(spark, folder), 10, order))


# Aggregation and the experiment.


def weekly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _text(sales.weekly_sales(star_schema.sales(spark, folder), CYCLE))


def joined_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The weekly sales table as the weekly job makes it, from sales, price changes and attributes."""
    made = sales.aggregate(
        star_schema.sales(spark, folder),
        star_schema.price_changes(spark, folder),
        star_schema.products(spark, folder),
        experiment.for_join(store_groups(spark, folder)),
        CYCLE,
    )
    return _text(made)


def sales_with_price(spark: SparkSession, folder: str) -> DataFrame:
    weekly = sales.weekly_sales(star_schema.sales(spark, folder), CYCLE)
    return _text(sales.attach_price(weekly, star_schema.price_changes(spark, folder)))


def aggregated_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _text(aggregated(spark, folder))


def latest_treated(spark: SparkSession, folder: str) -> DataFrame:
    return _text(offered(spark, folder, every_week=False))


def store_zscores(spark: SparkSession, folder: str) -> DataFrame:
    scored = features.standardize(star_schema.stores(spark, folder), experiment.ATTRIBUTES)
    return scored.select(
        "store_id", *[settle(F.col(c)).alias(c) for c in experiment.STANDARDIZED]
    )


def split_stores(spark: SparkSession, folder: str) -> DataFrame:
    return store_groups(spark, folder).select(
        "store_id", "cluster_val", "rand", "cum_dist", "group_val"
    )


def store_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Is the mean of a store's cluster the nearest one? Where k-means has ended, for every store."""
    found = scratch.stage(experiment.cluster_stores(star_schema.stores(spark, folder)), "clusters")
    x, y = (F.col(c) for c in experiment.STANDARDIZED)
    means = found.groupBy("cluster_val").agg(F.avg(x).alias("mx"), F.avg(y).alias("my"))
    # At most three rows.
    apart = [
        F.struct(
            ((x - m["mx"]) * (x - m["mx"]) + (y - m["my"]) * (y - m["my"])).alias("d"),
            F.lit(m["cluster_val"]).alias("cluster_val"),
        )
        for m in means.collect()
    ]
    nearest = F.array_min(F.array(*apart))["cluster_val"]
    return found.select("store_id", (nearest == F.col("cluster_val")).cast("int").alias("settled"))


def encoded_features(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers and one-hot slots of the categories that the forest learns from."""
    return demand.encode(features.price_features(aggregated(spark, folder)))


# Features and demand.


def price_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.price_features(aggregated(spark, folder))
    return _text(
        rows.select(
            "week_start",
            "store_id",
            "department_id",
            "product_id",
            group_key(features.GROUP).alias("competing_group_index"),
            "sales",
            "price",
            settle(F.col("rl_price")).alias("rl_price"),
            settle(F.col("discount")).alias("discount"),
        )
    )


def fit_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.price_features(aggregated(spark, folder))
    fit = demand.evaluate(demand.score(MODEL, rows))
    return fit.select(settle(F.col("RMSE")).alias("RMSE"), settle(F.col("R2")).alias("R2"))


def model_time(spark: SparkSession, folder: str) -> DataFrame:
    return registry.model_time(aggregated(spark, folder))


def forest_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of every row the forest can score, and whether the prediction lies in their range."""
    rows = scratch.stage(features.price_features(aggregated(spark, folder)), "training")
    scored = demand.score(demand.train(rows), rows)
    ends = rows.where("price IS NOT NULL").agg(F.min("sales"), F.max("sales")).first()
    inside = F.col("prediction").between(ends[0], ends[1]).cast("int")
    return _text(
        scored.select("week_start", "store_id", "product_id", "sales", inside.alias("in_range"))
    )


def forest_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    """One price for every offered product, by the forest."""
    weekly = scratch.stage(aggregated(spark, folder), "weekly")
    forest = demand.train(features.price_features(weekly))
    products = candidates.products(experiment.treated(latest(weekly, CYCLE)), CYCLE)
    products = scratch.stage(products, "products")
    chosen = scratch.stage(optimize.recommend(products, forest), "chosen")
    # Is the price a feasible one of the grid, and do the group's prices add up to its price sum?
    key = [*features.GROUP, "product_id", "price"]
    feasible = candidates.mark_valid(products).where("valid").select(*key, F.lit(True).alias("feasible"))
    totals = chosen.groupBy(*features.GROUP).agg(F.sum("price").alias("total"), F.count("*").alias("priced"))
    fits = (
        F.col("feasible")
        & (F.abs(F.col("total") - F.col("price_sum")) <= F.col("price_sum") * 1e-9)
        & (F.col("priced") == F.col("count"))
        & (F.col("pred_demand") >= 0)
    )
    met = chosen.join(feasible, key, "left").join(totals, list(features.GROUP))
    return _text(
        met.select(
            "week_start", "store_id", "department_id", "product_id",
            F.coalesce(fits, F.lit(False)).cast("int").alias("fits"),
        )
    )


# Candidates and optimisation.


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """Products to price in treatment stores, of every week in turn, stored."""
    return scratch.stage(offered(spark, folder, every_week=True), "products")


def _every_product(spark: SparkSession, folder: str) -> DataFrame:
    return candidates.products(aggregated(spark, folder), CYCLE)


def group_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return _text(candidates.group_ranges(_every_product(spark, folder)))


def group_count(spark: SparkSession, folder: str) -> DataFrame:
    return candidates.count_groups(_every_product(spark, folder))


def price_grid(spark: SparkSession, folder: str) -> DataFrame:
    return _text(candidates.price_grid(candidates.group_ranges(_every_product(spark, folder))))


def price_sum_grid(spark: SparkSession, folder: str) -> DataFrame:
    return _text(candidates.sum_grid(candidates.group_ranges(_every_product(spark, folder))))


def valid_prices(spark: SparkSession, folder: str) -> DataFrame:
    marked = candidates.mark_valid(scratch.stage(_every_product(spark, folder), "products"))
    return _text(
        marked.select(
            *features.GROUP,
            "product_id",
            "price_idx",
            "price",
            F.col("valid").cast("int").alias("valid"),
        )
    )


def scored_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of every week, in treatment stores, the ones that are priced."""
    products = _stored(spark, folder)
    grid = scratch.stage(candidates.on_grid(MODEL.prepare(products)), "grid")
    return _text(
        candidates.score(candidates.expand(products, grid=grid), MODEL).select(
            *features.GROUP,
            "product_id",
            "sum_idx",
            "price_idx",
            "price",
            "price_sum",
            "rl_price",
            "discount",
            "units",
            "obj",
        )
    )


def _bounds(spark: SparkSession, folder: str) -> DataFrame:
    return optimize.bounds(_stored(spark, folder), MODEL)


def lp_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _text(
        _bounds(spark, folder).select(*features.GROUP, "sum_idx", settle(F.col("lp")).alias("lp"))
    )


def lower_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _text(
        _bounds(spark, folder).select(*features.GROUP, "sum_idx", settle(F.col("lb")).alias("lb"))
    )


def ip_by_sum(spark: SparkSession, folder: str) -> DataFrame:
    solved = optimize.solve_sums(_stored(spark, folder), MODEL)
    return _text(solved.select(*features.GROUP, "sum_idx", "ip"))


def best_price_sum(spark: SparkSession, folder: str) -> DataFrame:
    best = optimize.best_sum(_stored(spark, folder), MODEL)
    return _text(best.select(*features.GROUP, "sum_idx", F.col("value").alias("ip"), "count"))


def _recommended(spark: SparkSession, folder: str, every_week: bool) -> DataFrame:
    products = scratch.stage(offered(spark, folder, every_week), "products")
    return optimize.recommend(products, MODEL)


def recommend_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Recommended prices for the week after the cycle."""
    return _text(_recommended(spark, folder, every_week=False))


def recommend_every_week(spark: SparkSession, folder: str) -> DataFrame:
    """The result table after a run for every week."""
    return _text(_recommended(spark, folder, every_week=True))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    stored = regression.moments(aggregated(spark, folder), ["product_id"], F.col("price"), F.col("sales").cast("double"))
    return regression.lines(stored).select(
        "product_id", "observations",
        settle(F.col("slope"), 9).alias("slope"), settle(F.col("intercept"), 4).alias("intercept"),
    )


def fitted_demand(spark: SparkSession, folder: str) -> DataFrame:
    """The line of weekly sales over price of each product, from moments."""
    return _lines(spark, folder)


def recommend_fitted(spark: SparkSession, folder: str) -> DataFrame:
    """Recommended prices for the week after the cycle, by the products' own lines of demand."""
    lines = scratch.stage(_lines(spark, folder), "lines")
    products = scratch.stage(offered(spark, folder, every_week=False), "products")
    chosen = optimize.recommend(products, demand.Fitted(base=1.0, lines=lines))
    return _text(chosen.select(*features.GROUP, "product_id", "price", "pred_demand"))


# Reports.


def elasticity_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Elasticity by department, by store and overall, all added up from one stored table of moments."""
    usable = aggregated(spark, folder).where("price > 0 AND sales > 0")
    finest = ["store_id", "department_id", "product_id"]
    stored = scratch.stage(regression.moments(usable, finest, F.ln("price"), F.ln("sales")), "moments")
    levels = []
    for level, by in (("department", ["department_id"]), ("store", ["store_id"]), ("all", [])):
        name = F.col(by[0]) if by else F.lit("all")
        levels.append(
            regression.lines(regression.add_up(stored, by)).select(
                F.lit(level).alias("level"), name.alias("name"), "observations", settle(F.col("slope")).alias("elasticity")
            )
        )
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


def elasticity(spark: SparkSession, folder: str) -> DataFrame:
    curves = reports.elasticity(aggregated(spark, folder), ["department_id", "product_id"])
    return curves.withColumn("elasticity", settle(F.col("elasticity")))


def elasticity_by_store(spark: SparkSession, folder: str) -> DataFrame:
    """Elasticity of a department in each store."""
    curves = reports.elasticity(aggregated(spark, folder), ["store_id", "department_id"])
    return curves.withColumn("elasticity", settle(F.col("elasticity")))


def recommended_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks for which prices are recommended."""
    return _text(reports.weeks(_recommended(spark, folder, every_week=False)))


def sales_by_price(spark: SparkSession, folder: str) -> DataFrame:
    points = reports.sales_by_price(aggregated(spark, folder), ["department_id", "product_id"])
    return points.withColumn("avg_sales", settle(F.col("avg_sales")))


def mape(spark: SparkSession, folder: str) -> DataFrame:
    # Prices are found for treatment stores, so sales of no other store are met.
    weekly = scratch.stage(treated(spark, folder), "weekly")
    products = scratch.stage(candidates.products(weekly, CYCLE), "products")
    found = optimize.recommend(products, MODEL).select("week_start", "store_id", "product_id", "pred_demand")
    chosen = scratch.stage(found, "chosen")
    error = reports.mape(chosen, weekly)
    return _text(error.withColumn("mape", settle(F.col("mape"))))


def profit_gain(spark: SparkSession, folder: str) -> DataFrame:
    gains = reports.profit_gain(aggregated(spark, folder))
    measures = [c for c in gains.columns if c != "week_start"]
    return _text(
        gains.select("week_start", *[settle(F.col(c), 4).alias(c) for c in measures])
    )


def result_weeks(spark: SparkSession, folder: str) -> DataFrame:
    return _text(reports.weeks(aggregated(spark, folder)))


def step_times(spark: SparkSession, folder: str) -> DataFrame:
    """Run times: an event is a step run, its value the seconds."""
    timings = spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_type").alias("step"),
        F.col("value").alias("time"),
        F.col("ts").cast("date").cast("string").alias("exec_date"),
    )
    return reports.step_times(timings)


QUERIES: dict[str, Query] = {
    "dimension_round_trip": dimension_round_trip,
    "cycle_days": cycle_days,
    "log_files": log_files,
    "read_cycle_logs": read_cycle_logs,
    "flatten_nested_sales": flatten_nested_sales,
    "flatten_price_changes": flatten_price_changes,
    "append_twice": append_twice,
    "late_sales": late_sales,
    "catalog_weeks": catalog_weeks,
    "stored_groups": stored_groups,
    "training_rows": training_rows,
    "step_log": step_log,
    "published_model": published_model,
    "encoded_features": encoded_features,
    "elasticity_by_store": elasticity_by_store,
    "recommended_weeks": recommended_weeks,
    "export_prices": export_prices,
    "sql_views": sql_views,
    "preview_sales": preview_sales,
    "weekly_sales": weekly_sales,
    "sales_with_price": sales_with_price,
    "aggregated_sales": aggregated_sales,
    "joined_sales": joined_sales,
    "latest_treated": latest_treated,
    "store_zscores": store_zscores,
    "store_groups": split_stores,
    "store_clusters": store_clusters,
    "price_features": price_features,
    "fit_metrics": fit_metrics,
    "model_time": model_time,
    "group_ranges": group_ranges,
    "group_count": group_count,
    "price_grid": price_grid,
    "price_sum_grid": price_sum_grid,
    "valid_prices": valid_prices,
    "scored_candidates": scored_candidates,
    "lp_bounds": lp_bounds,
    "lower_bounds": lower_bounds,
    "ip_by_sum": ip_by_sum,
    "best_price_sum": best_price_sum,
    "recommend_prices": recommend_prices,
    "recommend_every_week": recommend_every_week,
    "fitted_demand": fitted_demand,
    "recommend_fitted": recommend_fitted,
    "elasticity_levels": elasticity_levels,
    "forest_scores": forest_scores,
    "forest_recommendations": forest_recommendations,
    "elasticity": elasticity,
    "sales_by_price": sales_by_price,
    "mape": mape,
    "profit_gain": profit_gain,
    "result_weeks": result_weeks,
    "step_times": step_times,
}
