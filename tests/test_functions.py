from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pricewright.functions import calendar, measures
from pricewright.functions.calendar import Cycle

WEEK = Cycle(date(2017, 1, 2), date(2017, 1, 23))


def test_week_buckets_are_anchored_on_the_cycle_start(spark):
    days = ["2017-01-01", "2017-01-02", "2017-01-08", "2017-01-09"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = df.select(calendar.week_start(F.to_date("d"), WEEK).cast("string")).collect()
    assert [r[0] for r in got] == ["2016-12-26", "2017-01-02", "2017-01-02", "2017-01-09"]


def test_text_times_with_and_without_blank(spark):
    df = spark.createDataFrame(
        [("2017-01-02 10:11:12",), ("2017-01-0210:11:12",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(calendar.to_day(F.col("t"))).collect()]
    assert got == [date(2017, 1, 2), date(2017, 1, 2), None]


def test_days_of_a_cycle(spark):
    logs = [r[0] for r in calendar.sales_days(spark, WEEK).orderBy("log_date").collect()]
    assert (logs[0], logs[-1], len(logs)) == (date(2017, 1, 3), date(2017, 1, 23), 21)
    prices = [r[0] for r in calendar.price_days(spark, WEEK).orderBy("price_date").collect()]
    assert prices == [date(2017, 1, 2), date(2017, 1, 9), date(2017, 1, 16)]
    ragged = Cycle(date(2017, 1, 2), date(2017, 1, 12))
    assert calendar.price_days(spark, ragged).count() == 1
    assert WEEK.latest == date(2017, 1, 16)


def test_horizon_shift(spark):
    df = spark.createDataFrame([(date(2017, 1, 16),)], "w date")
    assert df.select(calendar.shift_weeks(F.col("w"), 2, WEEK)).first()[0] == date(2017, 1, 30)


def test_demand_rounds_halves_up_and_is_never_negative(spark):
    values = [2.5, -0.5, 0.49, 0.49999999999999994, 3.0, -7.2, None]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r[0] for r in df.select(measures.to_units(F.col("p"))).collect()]
    assert got == [3.0, 0.0, 0.0, 0.0, 3.0, 0.0, None]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "zero double, one double")
    got = df.select(
        measures.discount(F.col("zero"), F.col("one")),
        measures.relative_price(F.col("one"), F.lit(2), F.col("zero")),
        measures.discount(F.lit(4.0), F.col("one")),
    ).first()
    assert tuple(got) == (None, None, 0.75)
