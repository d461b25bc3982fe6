"""Trained models and the log that names them."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.sources import tables

POINTER = "model_name"
_POINTER_SCHEMA = "name string, path string, published_at timestamp"


def _pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/{POINTER}"


def has_model(spark: SparkSession, root: str) -> bool:
    return tables.exists(spark, _pointer_path(root))


def should_train(spark: SparkSession, root: str, first_time: bool) -> bool:
    """The first training runs only without a model, retraining only with one."""
    return has_model(spark, root) != first_time


def publish(model: PipelineModel, spark: SparkSession, root: str) -> str:
    """Save a model in a new folder, then add its name to the pointer log.

    The log only grows, so a run that dies half-way leaves the previous model in force.
    """
    now = datetime.now(timezone.utc)
    path = f"{root.rstrip('/')}/forest_{now.strftime('%Y_%m_%d_%H_%M_%S')}_{uuid.uuid4().hex[:8]}"
    model.write().save(path)
    line = spark.createDataFrame([(POINTER, path, now)], _POINTER_SCHEMA)
    tables.append(line, _pointer_path(root))
    return path


def latest_path(spark: SparkSession, root: str) -> str:
    lines = spark.read.schema(_POINTER_SCHEMA).parquet(_pointer_path(root))
    newest = (
        lines.where(F.col("name") == POINTER)
        .agg(F.max_by("path", "published_at").alias("path"))
        .first()
    )
    if newest is None or newest["path"] is None:
        raise LookupError(f"no model is published under {root}")
    return newest["path"]


def load_latest(spark: SparkSession, root: str) -> PipelineModel:
    return PipelineModel.load(latest_path(spark, root))


def model_time(sales: DataFrame) -> DataFrame:
    """Newest week the model saw, as text."""
    return sales.agg(F.max("week_start").cast("string").alias("model_time"))


def log_metrics(metrics: DataFrame, table: str, path: str | None = None) -> None:
    """Append one line of (model_time, RMSE, R2)."""
    tables.save_table(metrics.select("model_time", "RMSE", "R2"), table, path=path)
