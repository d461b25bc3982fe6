"""Candidate prices of competing groups.

A group's n products share a grid of ``size`` prices from its lowest cost to its highest msrp; price
sums have a grid of the same spacing with (size-1)n+1 points. Candidates are product x price x price
sum, because demand depends on a price relative to the group's price sum.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.functions.calendar import Cycle, shift_weeks
from pricewright.functions.measures import discount, profit, relative_price, to_units
from pricewright.functions.price_index import (
    feasible_prices,
    grid_indexes,
    grid_price,
    grid_price_sum,
)
from pricewright.operators.demand import Demand
from pricewright.operators.features import GROUP

# Candidate prices per product.
PRICES = 10
# Candidate rows that one slice of a group may make. A slice is the unit that is not split further.
SLICE_ROWS = 1 << 20

PRODUCT = (
    "product_id",
    "department_id",
    "brand_id",
    "msrp",
    "cost",
    "avg_hhi",
    "avg_traffic",
)


def products(sales: DataFrame, cycle: Cycle, weeks_ahead: int = 0) -> DataFrame:
    """Distinct products to price, dated to the week they are priced for."""
    target = shift_weeks(F.col("week_start"), weeks_ahead + 1, cycle)
    return sales.select("store_id", *PRODUCT, target.alias("week_start")).distinct()


def group_ranges(df: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Lowest cost, highest msrp and number of products per group."""
    return df.groupBy(*group).agg(
        F.min("cost").alias("min_cost"), F.max("msrp").alias("max_msrp"), F.count("*").alias("count")
    )


def count_groups(df: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    return df.agg(F.count_distinct(*[F.col(c) for c in group]).alias("groups"))


def price_grid(ranges: DataFrame, size: int = PRICES) -> DataFrame:
    """A row per group and grid price. A group whose range is one point has one price."""
    low, high = F.col("min_cost"), F.col("max_msrp")
    return ranges.withColumn("price_idx", F.explode(grid_indexes(low, high, size))).withColumn(
        "price", grid_price(F.col("price_idx"), low, high, size)
    )


def sum_grid(ranges: DataFrame, size: int = PRICES) -> DataFrame:
    """A row per group and grid price sum."""
    last = F.when(
        F.col("min_cost") < F.col("max_msrp"), (F.col("count") * (size - 1)).cast("int")
    ).otherwise(0)
    return ranges.withColumn("sum_idx", F.explode(F.sequence(F.lit(0), last))).withColumn(
        "price_sum", price_sum(F.col("sum_idx"), size)
    )


def price_sum(index: Column, size: int) -> Column:
    """Price sum number ``index`` of a row's group."""
    return grid_price_sum(index, F.col("min_cost"), F.col("max_msrp"), F.col("count"), size)


def with_prices(df: DataFrame, size: int) -> DataFrame:
    """Price, price sum and the features that depend on them, from the two indexes."""
    low, high = F.col("min_cost"), F.col("max_msrp")
    return (
        df.withColumn("price", grid_price(F.col("price_idx"), low, high, size))
        .withColumn("price_sum", price_sum(F.col("sum_idx"), size))
        .withColumn(
            "rl_price", relative_price(F.col("price"), F.col("count"), F.col("price_sum"))
        )
        .withColumn("discount", discount(F.col("msrp"), F.col("price")))
    )


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def on_grid(
    df: DataFrame,
    group: Sequence[str] = GROUP,
    size: int = PRICES,
    allowed: Callable[[Column], Column] | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Product rows with the group's range, their feasible price indexes and the feasible index sums, and
    the ``extra`` aggregates of the group.

    Fails if a product is in a group twice. Aggregates joined back and not windows. Rows are placed by their
    group once, and all that is aggregated and joined here finds them in place: a group is as many rows as it
    has products, and later steps meet all of them in a slice.
    """
    names = [c for c in df.columns if c not in group and c != "product_id"]
    # Rows without a product are rows of their own. As one column the others are shuffled once for all that
    # reads some of them.
    own = F.when(F.col("product_id").isNull(), F.monotonically_increasing_id())
    each = (
        df.select(*group, "product_id", own.alias("_own"), F.struct(*names).alias("_row"))
        .repartition(*group)
        .groupBy(*group, "product_id", "_own")
        .agg(F.first("_row").alias("_row"), F.count("*").alias("_times"))
        .select(*group, "product_id", "_row.*", "_times")
    )
    ranges = each.groupBy(*group).agg(
        F.min("cost").alias("min_cost"),
        F.max("msrp").alias("max_msrp"),
        F.count("*").alias("count"),
        F.max(F.when(F.col("_times") > 1, F.col("product_id"))).alias("_twice"),
    )
    message = F.concat(F.lit("product twice in a competing group: "), F.col("_twice"))
    once = F.when(F.col("_twice").isNotNull(), F.raise_error(message).cast("bigint"))
    known = ranges.withColumn("count", F.coalesce(once, F.col("count"))).drop("_twice")
    prices = feasible_prices(
        F.col("min_cost"), F.col("max_msrp"), F.col("cost"), F.col("msrp"), size, allowed
    )
    listed = each.drop("_times").join(known, list(group)).withColumn("feasible", prices)
    ends = listed.groupBy(*group).agg(
        F.sum(F.array_min("feasible.price_idx")).cast("int").alias("min_sum"),
        F.sum(F.array_max("feasible.price_idx")).cast("int").alias("max_sum"),
        *[value.alias(name) for name, value in (extra or {}).items()],
    )
    columns = [*df.columns, "min_cost", "max_msrp", "count", "feasible", "min_sum", "max_sum", *(extra or {})]
    return listed.join(ends, list(group)).select(*columns)


def mark_valid(
    df: DataFrame,
    group: Sequence[str] = GROUP,
    size: int = PRICES,
    allowed: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Every grid price of every product, with a flag for the feasible ones."""
    low, high = F.col("min_cost"), F.col("max_msrp")
    return (
        on_grid(df, group, size, allowed)
        .withColumn("price_idx", F.explode(grid_indexes(low, high, size)))
        .withColumn("valid", F.array_contains("feasible.price_idx", F.col("price_idx")))
        .withColumn("price", grid_price(F.col("price_idx"), low, high, size))
        .drop("feasible", "min_sum", "max_sum")
    )


def at_sums(
    grid: DataFrame, group: Sequence[str], size: int, count: int, only: DataFrame | None = None, single: bool = False
) -> DataFrame:
    """The rows of ``on_grid``, once for each price sum that some choice of prices can reach.

    Product rows are shuffled by group and slice. A slice is a run of price sums that makes about
    ``SLICE_ROWS`` candidates, so an ordinary group is one slice, and a huge group is spread over many
    tasks. Later steps that group by these columns and more find the rows in place. With ``only``, the
    sums that its rows name, each placed by itself; with ``single``, where it names one sum of a group at
    most, rows are placed by group and shuffled once.

    The shuffle has an explicit partition number: product rows are few bytes, and left to adaptive
    execution they would be merged into a handful of tasks that then make all candidates.
    """
    if only is not None:
        named = only.select(*group, "sum_idx").withColumn("slice", F.col("sum_idx"))
        if single:
            return grid.repartition(count, *group).join(named.repartition(count, *group), list(group))
        return grid.join(named, list(group)).repartition(count, *group, "slice")
    sliced = in_slices(grid, group, size, count)
    return sliced.withColumn("sum_idx", F.explode(F.sequence("from_sum", "to_sum"))).drop("from_sum", "to_sum")


def in_slices(grid: DataFrame, group: Sequence[str], size: int, count: int) -> DataFrame:
    """The rows of ``on_grid`` in each slice of their group, with its price sums ``from_sum`` to ``to_sum``."""
    width = F.greatest(F.lit(1), F.floor(F.lit(SLICE_ROWS) / (F.col("count") * size))).cast("int")
    first, last = F.col("slice") * F.col("width"), (F.col("slice") + 1) * F.col("width") - 1
    return (
        grid.withColumn("width", width)
        .withColumn("slice", F.explode(F.expr("sequence(min_sum div width, max_sum div width)")))
        .withColumn("slice", F.col("slice").cast("int"))
        .repartition(count, *group, "slice")
        .withColumn("from_sum", F.greatest(F.col("min_sum"), first))
        .withColumn("to_sum", F.least(F.col("max_sum"), last))
        .drop("width")
    )


def rest_sums() -> tuple[Column, Column]:
    """Least and greatest index sum of the other products of a group."""
    return (
        F.col("min_sum") - F.array_min("feasible.price_idx"),
        F.col("max_sum") - F.array_max("feasible.price_idx"),
    )


def indexes_only(grid: DataFrame) -> DataFrame:
    """Rows of ``on_grid`` as they are shuffled: ``feasible`` as indexes alone, which prices follow from, and
    the ends of the others' index sums."""
    low, high = rest_sums()
    known = grid.withColumn("_rest_low", low).withColumn("_rest_high", high)
    return known.withColumn("feasible", F.col("feasible.price_idx"))


def sums(
    df: DataFrame,
    group: Sequence[str] = GROUP,
    size: int = PRICES,
    allowed: Callable[[Column], Column] | None = None,
    partitions: int | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """A row per product and price sum that some choice of prices can reach, with its ``feasible``
    prices (``price_idx``, ``price``, ``discount``, ``rl_price``, and ``reachable``: can the others
    complete it to the sum)."""
    rows = at_sums(
        on_grid(df, group, size, allowed), group, size, partitions or shuffle_partitions(df), only
    )
    # What depends on the price sum or on the price alone is computed before rows multiply.
    rest_low, rest_high = rest_sums()
    prices = F.transform(
        "feasible",
        lambda p: F.struct(
            p["price_idx"].alias("price_idx"),
            p["price"].alias("price"),
            discount(F.col("msrp"), p["price"]).alias("discount"),
            relative_price(p["price"], F.col("count"), F.col("price_sum")).alias("rl_price"),
            (F.col("sum_idx") - p["price_idx"]).between(rest_low, rest_high).alias("reachable"),
        ),
    )
    return (
        rows.withColumn("price_sum", price_sum(F.col("sum_idx"), size))
        .withColumn("feasible", prices)
        .drop("min_sum", "max_sum")
    )


def expand(
    df: DataFrame,
    group: Sequence[str] = GROUP,
    size: int = PRICES,
    allowed: Callable[[Column], Column] | None = None,
    reachable: bool = False,
    partitions: int | None = None,
    only: DataFrame | None = None,
    grid: DataFrame | None = None,
) -> DataFrame:
    """Candidate rows: feasible prices only, at price sums that some choice of prices can reach.

    With ``reachable``, also only prices that the other products can complete to the price sum.
    Candidates are never shuffled. ``grid`` are the rows of ``on_grid`` where they are stored already.
    """
    grid = on_grid(df, group, size, allowed) if grid is None else grid
    rows = at_sums(indexes_only(grid), group, size, partitions or shuffle_partitions(df), only)
    # Plain columns of candidate rows are generated code; lambdas over the prices of a row are not.
    kept = [c for c in rows.columns if c not in ("feasible", "min_sum", "max_sum", "_rest_low", "_rest_high")]
    summed = rows.select(
        *kept,
        price_sum(F.col("sum_idx"), size).alias("price_sum"),
        (F.col("sum_idx") - F.col("_rest_high")).alias("_least"),
        (F.col("sum_idx") - F.col("_rest_low")).alias("_most"),
        "feasible",
    )
    kept.append("price_sum")
    priced = summed.select(*kept, "_least", "_most", F.explode("feasible").alias("price_idx"))
    if reachable:
        priced = priced.where(F.col("price_idx").between(F.col("_least"), F.col("_most")))
    low, high = F.col("min_cost"), F.col("max_msrp")
    priced = priced.withColumn("price", grid_price(F.col("price_idx"), low, high, size))
    relative = relative_price(F.col("price"), F.col("count"), F.col("price_sum"))
    return priced.select(
        *kept, "price_idx", "price", discount(F.col("msrp"), F.col("price")).alias("discount"), relative.alias("rl_price")
    )


def score(candidates: DataFrame, model: Demand) -> DataFrame:
    """Add demand in whole units and profit. Rows the model cannot score drop out."""
    scored = model.score(candidates).withColumn("units", to_units(F.col("prediction")))
    return (
        scored.where(F.col("units").isNotNull())
        .withColumn("obj", profit(F.col("price"), F.col("cost"), F.col("units")))
        .drop("prediction")
    )
