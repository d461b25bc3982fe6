"""Sales cycles, week buckets anchored on the cycle start, and text timestamps."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the input format.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_TIMESTAMP_FORMAT = "yyyy-MM-ddHH:mm:ss"


@dataclass(frozen=True)
class Cycle:
    """A sales cycle ``[start, end)`` split into weeks of ``days`` days counted from ``start``."""

    start: date
    end: date
    days: int = 7

    @property
    def latest(self) -> date:
        """First day of the last week of the cycle."""
        return self.end - timedelta(days=self.days)


def to_day(text: Column) -> Column:
    """Date of a text timestamp; also reads the form whose blank was stripped.

    Null text gives null; text of neither form is an error, as a sale without a day would be lost.
    """
    # Only the form with a blank can have one. A text is not tried in the other form, as a refusal is dear.
    stamp = F.when(
        F.contains(text, F.lit(" ")), F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
    ).otherwise(F.try_to_timestamp(text, F.lit(COMPACT_TIMESTAMP_FORMAT)))
    refused = F.raise_error(F.concat(F.lit("unreadable time: "), text)).cast("date")
    return F.when(text.isNull() | stamp.isNotNull(), F.to_date(stamp)).otherwise(refused)


def week_start(day: Column, cycle: Cycle) -> Column:
    """First day of the week that holds ``day``.

    ``floor`` and not integer division: a day before the anchor belongs to an earlier week.
    """
    anchor = F.lit(cycle.start)
    weeks = F.floor(F.datediff(day, anchor) / F.lit(cycle.days))
    return F.date_add(anchor, (weeks * cycle.days).cast("int"))


def shift_weeks(day: Column, weeks: int, cycle: Cycle) -> Column:
    return F.date_add(day, weeks * cycle.days)


def sales_days(spark: SparkSession, cycle: Cycle) -> DataFrame:
    """Dates of the sales logs of a cycle: a log dated d+1 holds the sales of day d."""
    first, last = cycle.start + timedelta(days=1), cycle.end
    return _days(spark, first, last, 1, "log_date")


def price_days(spark: SparkSession, cycle: Cycle) -> DataFrame:
    """Dates on which prices may change: the first day of every whole week of the cycle."""
    weeks = (cycle.end - cycle.start).days // cycle.days
    last = cycle.start + timedelta(days=cycle.days * (weeks - 1))
    return _days(spark, cycle.start, last, cycle.days, "price_date")


def _days(spark: SparkSession, first: date, last: date, step: int, name: str) -> DataFrame:
    count = max((last - first).days // step + 1, 0)
    return spark.range(count).select(
        F.date_add(F.lit(first), (F.col("id") * step).cast("int")).alias(name)
    )


def latest(sales: DataFrame, cycle: Cycle) -> DataFrame:
    """Rows of the last week; a literal predicate, so a week-partitioned table prunes to one directory."""
    return sales.where(F.col("week_start") == F.lit(cycle.latest))
