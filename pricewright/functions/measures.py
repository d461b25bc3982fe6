"""Scalar measures of prices, demand and profit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def discount(msrp: Column, price: Column) -> Column:
    """Share of the list price that is given away; null where the list price is 0."""
    return F.try_divide(msrp - price, msrp)


def relative_price(price: Column, count: Column, price_sum: Column) -> Column:
    """Price over the mean price of the competing group; null where the group's price sum is 0."""
    return F.try_divide(price * count, price_sum)


def to_units(prediction: Column) -> Column:
    """Predicted demand in whole units: halves round up, nothing is below 0, null stays null.

    Written with ``floor`` because ``round`` on doubles goes through a decimal object per row.
    """
    whole = F.floor(prediction)
    up = (prediction - whole >= 0.5).cast("bigint")
    return F.when(prediction.isNotNull(), F.greatest(whole + up, F.lit(0)).cast("double"))


def profit(price: Column, cost: Column, units: Column) -> Column:
    return (price - cost) * units


def group_key(columns: Sequence[str]) -> Column:
    """Readable name of a competing group. Joins use the columns themselves."""
    return F.concat_ws("_", *[F.col(c).cast("string") for c in columns])
