"""The weekly jobs on the command line."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession

from pricewright.operators import candidates, features
from pricewright.plans import jobs


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="python -m pricewright")
    out.add_argument("job", choices=("aggregate", "train-first", "retrain", "recommend"))
    out.add_argument("raw")
    out.add_argument("parameters")
    out.add_argument("results")
    out.add_argument("--days", type=int, default=7, help="days of a week")
    out.add_argument("--shared", help="folder that all machines share, for intermediate tables")
    out.add_argument("--weeks-ahead", type=int, default=0)
    out.add_argument("--prices", type=int, default=candidates.PRICES, help="grid prices a product")
    out.add_argument("--group", nargs="+", default=list(features.GROUP), help="columns of a competing group")
    out.add_argument(
        "--allowed", nargs=2, type=float, action="append", metavar=("LOW", "HIGH"),
        help="range of prices; may be given several times",
    )
    return out


def rule(ranges: list[list[float]] | None) -> Callable[[Column], Column] | None:
    """A price is allowed if it lies in one of the ranges."""
    if not ranges:
        return None
    return lambda price: reduce(or_, [price.between(low, high) for low, high in ranges])


def main(args: list[str] | None = None) -> None:
    given = parser().parse_args(args)
    at = jobs.Locations(given.raw, given.parameters, given.results)
    builder = SparkSession.builder.appName(f"pricewright-{given.job}")
    if given.shared:
        builder = builder.config("spark.checkpoint.dir", given.shared)
    spark = builder.getOrCreate()
    if given.job == "aggregate":
        jobs.aggregate(spark, at, jobs.read_cycle(spark, at, given.days))
    elif given.job in ("train-first", "retrain"):
        jobs.train(spark, at, first_time=given.job == "train-first")
    else:
        settings = jobs.Pricing(given.weeks_ahead, given.prices, tuple(given.group), rule(given.allowed))
        jobs.recommend(spark, at, jobs.read_cycle(spark, at, given.days), settings)


if __name__ == "__main__":
    main()
