"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Spark removes what a statement shuffled at its end. Without, it stays until the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Tables staged outside a job, and the list of the job that runs here, if one does.
_staged: list[str] = []
_of_job: ContextVar[list[str] | None] = ContextVar("staged tables of the running job", default=None)


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only where neither the setting nor a checkpoint directory exists and the master is local, as in
    tests, a temporary folder is made and set. On a cluster it would be another folder on each machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    For results that several later steps read: they share one computation, and a lost executor costs
    a re-read and not a recomputation. What was shuffled for it is removed when the table is written.
    """
    path = folder(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    mine = _of_job.get()
    (_staged if mine is None else mine).append(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.staged_at = path
    return made


def discard(staged: DataFrame) -> None:
    """Empty a table that ``stage`` returned and that nothing reads any more."""
    _empty(staged.sparkSession, [staged.staged_at])


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Empty the tables staged outside a job so far. For the end of a process's work."""
    _empty(spark, _staged)


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is emptied at the end; results of others in this process stay readable."""
    mine: list[str] = []
    token = _of_job.set(mine)
    try:
        yield
    finally:
        _of_job.reset(token)
        _empty(spark, mine)


def _empty(spark: SparkSession, paths: list[str]) -> None:
    nothing = spark.createDataFrame([], "empty int")
    while paths:
        nothing.write.mode("overwrite").parquet(paths.pop())
