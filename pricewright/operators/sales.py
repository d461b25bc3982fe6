"""Weekly sales per store and product with price and attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.functions.calendar import Cycle, week_start
from pricewright.sources.tables import WRITTEN_BY

KEY = ("week_start", "store_id", "product_id")


def weekly_sales(sold: DataFrame, cycle: Cycle) -> DataFrame:
    """Units per week, store and product. A unit is a row; partial counts go into the shuffle."""
    return sold.groupBy(
        week_start(F.col("sale_day"), cycle).alias("week_start"), "store_id", "product_id"
    ).agg(F.count("*").alias("sales"))


def one_price_each(prices: DataFrame) -> DataFrame:
    """Price changes, failing if a week, store and product has more than one.

    The check groups by the join keys, so its shuffle is the one the join needs anyway.
    """
    checked = prices.groupBy(*KEY).agg(
        F.count("*").alias("entries"), F.min("date").alias("date"), F.min("price").alias("price")
    )
    message = F.concat(
        F.lit("more than one price change for "),
        F.concat_ws(", ", F.col("week_start").cast("string"), "store_id", "product_id"),
    )
    price = F.when(F.col("entries") == 1, F.col("price")).otherwise(
        F.raise_error(message).cast("double")
    )
    return checked.select(*KEY, "date", price.alias("price"))


def attach_price(sales: DataFrame, prices: DataFrame) -> DataFrame:
    """The week's price change, null for products without one."""
    return sales.join(one_price_each(prices), list(KEY), "left")


def attach_dims(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Product and store attributes; rows of unknown products or stores drop out.

    No broadcast is forced: Spark broadcasts a dimension it measures as small and otherwise shuffles,
    where adaptive execution splits the partitions of a product or store with very many rows.
    """
    return sales.join(products, "product_id").join(stores, "store_id")


def add_up(rows: DataFrame) -> DataFrame:
    """One row a week, store and product from the rows that several cycles wrote.

    A late sale arrives without the price of its week, so all else is of one row whose price is known.
    """
    others = in_row_order(rows.columns)
    if not others:
        return rows.groupBy(*KEY).agg(F.sum("sales").alias("sales"))
    summed = rows.groupBy(*KEY).agg(F.sum("sales").alias("sales"), F.max(F.struct(*others)).alias("_row"))
    return summed.select(*KEY, "sales", "_row.*")


def in_row_order(columns: Sequence[str]) -> list[str]:
    """Columns besides key and sales, the price first: the greatest row has a price if any has."""
    others = [c for c in columns if c not in (*KEY, "sales", WRITTEN_BY)]
    return sorted(others, key=lambda c: c != "price")


def added_up_sql(table: str, columns: Sequence[str]) -> str:
    """``add_up`` of a catalog table as a statement, for a view that outlives the session."""
    others, key = in_row_order(columns), ", ".join(KEY)
    row = f", max(struct({', '.join(others)})) AS _row" if others else ""
    inner = f"SELECT {key}, sum(sales) AS sales{row} FROM {table} GROUP BY {key}"
    return f"SELECT {key}, sales{', _row.*' if others else ''} FROM ({inner})"


def aggregate(
    sold: DataFrame, prices: DataFrame, products: DataFrame, stores: DataFrame, cycle: Cycle
) -> DataFrame:
    """The weekly sales table."""
    return attach_dims(attach_price(weekly_sales(sold, cycle), prices), products, stores)
