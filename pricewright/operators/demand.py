"""Demand models: a random forest, and a linear form with given coefficients.

Both offer ``prepare``, which does once per product what does not depend on the candidate price, and
``score``, which adds a ``prediction`` to candidate rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.sources import scratch

# Model inputs, in the order of the feature vector.
CATEGORICAL = ("department_id", "brand_id")
NUMERICAL = ("price", "avg_hhi", "avg_traffic", "rl_price", "discount")
LABEL = "sales"
# Memory for the histograms of one pass; more memory, more tree nodes split per pass over the rows.
HISTOGRAM_MEMORY_MB = 1024
_INDEXED = [f"{c}_number" for c in CATEGORICAL]
_ENCODED = [f"{c}_slots" for c in CATEGORICAL]


class Demand(Protocol):
    def prepare(self, products: DataFrame) -> DataFrame: ...

    def score(self, candidates: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class Linear:
    """Demand as a weighted sum of the numerical features; one column expression."""

    base: float
    price: float = 0.0
    avg_hhi: float = 0.0
    avg_traffic: float = 0.0
    rl_price: float = 0.0
    discount: float = 0.0

    def prepare(self, products: DataFrame) -> DataFrame:
        return products

    #: Columns of product rows that demand is made of, besides what depends on the price.
    inputs = ("avg_hhi", "avg_traffic")

    def demand(self, value: Callable[[str], Column]) -> Column:
        """Demand from the values of the features: columns, or arrays of numbers."""
        total = self.base
        for name in NUMERICAL:
            total = total + getattr(self, name) * value(name)
        return total

    def arithmetic(self) -> Linear:
        """The model as tasks need it, where ``inputs`` are at hand."""
        return self

    def score(self, candidates: DataFrame) -> DataFrame:
        return candidates.withColumn("prediction", self.demand(F.col))


@dataclass(frozen=True)
class Fitted(Linear):
    """A line of demand over price for each product: ``lines`` has ``product_id``, ``intercept``, ``slope``.

    A product without a line sells ``base`` at any price.
    """

    lines: DataFrame | None = None

    inputs = ("line_base", "line_slope")

    def prepare(self, products: DataFrame) -> DataFrame:
        known = self.lines.select("product_id", "intercept", "slope")
        joined = products.join(known, "product_id", "left")
        return joined.select(
            *products.columns,
            F.coalesce("intercept", F.lit(self.base)).alias("line_base"),
            F.coalesce("slope", F.lit(0.0)).alias("line_slope"),
        )

    def arithmetic(self) -> Linear:
        return replace(self, lines=None)

    def demand(self, value: Callable[[str], Column]) -> Column:
        return value("line_base") + value("line_slope") * value("price")


@dataclass(frozen=True)
class Forest:
    """A fitted pipeline: index, encode, assemble, forest."""

    model: PipelineModel

    def prepare(self, products: DataFrame) -> DataFrame:
        for stage in self.model.stages[:2]:
            products = stage.transform(products)
        return products

    def score(self, candidates: DataFrame) -> DataFrame:
        for stage in self.model.stages[2:]:
            candidates = stage.transform(candidates)
        return candidates.drop("features", *_INDEXED, *_ENCODED)


def pipeline(seed: int = 1, trees: int = 100, depth: int = 10, bins: int = 32) -> Pipeline:
    """Unseen categories are all-zero vectors; rows with a missing feature take no part."""
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORICAL), outputCols=_INDEXED, handleInvalid="keep"),
            OneHotEncoder(inputCols=_INDEXED, outputCols=_ENCODED, dropLast=True),
            VectorAssembler(
                inputCols=[*NUMERICAL, *_ENCODED], outputCol="features", handleInvalid="skip"
            ),
            RandomForestRegressor(
                labelCol=LABEL,
                featuresCol="features",
                predictionCol="prediction",
                numTrees=trees,
                maxDepth=depth,
                maxBins=bins,
                maxMemoryInMB=HISTOGRAM_MEMORY_MB,
                impurity="variance",
                featureSubsetStrategy="auto",
                seed=seed,
            ),
        ]
    )


def train(training_rows: DataFrame, seed: int = 1, **settings: int) -> Forest:
    """Fit the forest. Spark trains it level by level over the distributed rows.

    The narrow training rows are spread evenly first: they may come in few files, and every level
    passes over them again. Dealt and sorted by all their values they are the same rows in the same
    order in every run, so that the trees, which draw rows by their place, are the same too.
    """
    parts = int(training_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = training_rows.select(
        *CATEGORICAL, *NUMERICAL, F.col(LABEL).cast("double").alias(LABEL)
    )
    placed = wanted.repartition(parts, *wanted.columns).sortWithinPartitions(*wanted.columns)
    return Forest(pipeline(seed, **settings).fit(placed))


def encode(df: DataFrame) -> DataFrame:
    """Each category with its number, most frequent first and then by name, and its one-hot slot.

    The categories are stored first, as each of them is read several times.
    """
    df = scratch.stage(df.select(*CATEGORICAL), "categories")
    indexer, encoder = pipeline().getStages()[:2]
    seen = [
        df.groupBy(c).agg(F.count("*").alias("rows")).select(F.lit(c).alias("field"), F.col(c).alias("category"), "rows")
        for c in CATEGORICAL
    ]
    numbered = indexer.fit(df).transform(df)
    encoded = encoder.fit(numbered).transform(numbered)
    out = None
    for c, number, slots, rows in zip(CATEGORICAL, _INDEXED, _ENCODED, seen, strict=True):
        each = encoded.groupBy(F.col(c).alias("category")).agg(
            F.first(number).cast("int").alias("number"),
            F.first(F.array_position(vector_to_array(slots), 1.0) - 1).cast("int").alias("slot"),
        )
        part = rows.join(each, "category").select("field", "category", "rows", "number", "slot")
        out = part if out is None else out.unionByName(part)
    return out


def score(model: Demand, df: DataFrame) -> DataFrame:
    return model.score(model.prepare(df))


def evaluate(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """RMSE and R2 = 1 - SSE/SST in one pass, over rows with a prediction."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    squared = F.avg((y - p) * (y - p))
    return df.where(p.isNotNull() & y.isNotNull()).agg(
        F.sqrt(squared).alias("RMSE"), (1 - F.try_divide(squared, F.var_pop(y))).alias("R2")
    )
