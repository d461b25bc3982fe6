"""Treatment and control stores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricewright.operators.features import standardize
from pricewright.sources import tables

ATTRIBUTES = ("avg_hhi", "avg_traffic")
STANDARDIZED = ("avg_hhi_std", "avg_traffic_std")
_BUCKET_DIGITS = 3


def cluster_stores(stores: DataFrame, k: int | None = None, seed: int = 1) -> DataFrame:
    """k-means on the standardised attributes; one cluster for up to two stores, else three.

    Training is a Spark job of its own.
    """
    if k is None:
        k = 3 if stores.limit(3).count() > 2 else 1
    measured = standardize(stores, ATTRIBUTES)
    if k == 1:
        return measured.withColumn("cluster_val", F.lit(0))
    points = VectorAssembler(inputCols=list(STANDARDIZED), outputCol="point").transform(measured)
    means = KMeans(k=k, maxIter=200, seed=seed, featuresCol="point", predictionCol="cluster_val")
    return means.fit(points).transform(points).drop("point")


def cluster_by_centers(stores: DataFrame, centers: Sequence[tuple[float, float]]) -> DataFrame:
    """The cluster of the nearest given center, the first of equally near ones."""
    hhi, traffic = (F.col(c) for c in STANDARDIZED)
    distances = [
        F.struct(
            (
                (hhi - F.lit(x)) * (hhi - F.lit(x)) + (traffic - F.lit(y)) * (traffic - F.lit(y))
            ).alias("distance"),
            F.lit(i).alias("cluster"),
        )
        for i, (x, y) in enumerate(centers)
    ]
    nearest = F.array_min(F.array(*distances))["cluster"]
    return standardize(stores, ATTRIBUTES).withColumn("cluster_val", nearest)


def assign_groups(clustered: DataFrame, seed: str = "1") -> DataFrame:
    """Split every cluster of two or more stores at random, half (rounded down) into treatment.

    Stores are ordered by a hash of id and seed, so a repeated run gives the same split. ``cum_dist``
    is the share of the cluster's stores up to this one. There are only a few clusters, so they are
    not ranked as whole window partitions: the leading hash digits cut each into equal buckets, a
    store's rank is its rank in the bucket plus the stores in the buckets before, and only bucket
    counts, at most 4096 per cluster, meet in one place.
    """
    bucketed = clustered.withColumn(
        "rand", F.md5(F.concat(F.col("store_id"), F.lit("_"), F.lit(seed)).cast("binary"))
    ).withColumn("bucket", F.substring("rand", 1, _BUCKET_DIGITS))
    in_cluster = W.partitionBy("cluster_val")
    counts = bucketed.groupBy("cluster_val", "bucket").agg(F.count("*").alias("stores"))
    offsets = counts.select(
        "cluster_val",
        "bucket",
        (F.sum("stores").over(in_cluster.orderBy("bucket")) - F.col("stores")).alias("before"),
        F.sum("stores").over(in_cluster).alias("cluster_size"),
    )
    in_bucket = W.partitionBy("cluster_val", "bucket").orderBy("rand", "store_id")
    rank = F.col("before") + F.row_number().over(in_bucket)
    return (
        bucketed.join(offsets, ["cluster_val", "bucket"])
        .withColumn("cum_dist", rank / F.col("cluster_size"))
        .withColumn(
            "group_val",
            F.when(F.col("cluster_size") < 2, "other")
            .when(F.col("cum_dist") > 0.5, "control")
            .otherwise("treatment"),
        )
        .drop("bucket", "before", "cluster_size")
    )


def load_or_assign(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Stored groups if there are any, else groups that are built and stored now.

    Only a missing table leads to a new split: a failing read must not re-randomise an experiment.
    """
    if not tables.exists(spark, path):
        tables.overwrite(build(), path)
    return spark.read.parquet(path)


def for_join(groups: DataFrame) -> DataFrame:
    return groups.select("store_id", *ATTRIBUTES, "group_val")


def treated(sales: DataFrame) -> DataFrame:
    """Rows of treatment stores, without the group."""
    return sales.where(F.col("group_val") == "treatment").drop("group_val")
