"""Features of the demand model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.functions.measures import discount, relative_price

# A competing group: the products of one department in one store and week.
GROUP = ("week_start", "store_id", "department_id")


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_std``: distance from the mean in sample standard deviations.

    0 where there is no deviation to divide by. Mean and deviation of each column are fetched as numbers,
    one small job: as a subquery they would be copied into every expression made of them.
    """
    found = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_dev") for c in columns],
    ).first()

    def known(name: str) -> Column:
        return F.lit(found[name]).cast("double")

    return df.select(
        *df.columns,
        *[
            F.when(
                F.col(c).isNotNull(),
                F.coalesce(
                    F.try_divide(F.col(c) - known(f"{c}_mean"), known(f"{c}_dev")), F.lit(0.0)
                ),
            ).alias(f"{c}_std")
            for c in columns
        ],
    )


def with_group_price(sales: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Add the price sum and the row count of each row's competing group.

    Rows without a price count but add nothing. An aggregate joined back, and not a window: partial
    sums make the aggregate small and the join splits a group that holds very many rows, whereas a
    window would put it into one task.
    """
    totals = sales.groupBy(*group).agg(
        F.sum("price").alias("price_sum"), F.count("*").alias("count")
    )
    return sales.join(totals, list(group))


def price_features(sales: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Training rows: sales with relative price and discount."""
    price = F.col("price")
    return (
        with_group_price(sales, group)
        .withColumn("rl_price", relative_price(price, F.col("count"), F.col("price_sum")))
        .withColumn("discount", discount(F.col("msrp"), price))
        .drop("price_sum", "count")
    )
