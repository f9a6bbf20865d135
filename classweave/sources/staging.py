"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from classweave.sources.files import delete_path, hadoop_path

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, or else the one given to `setCheckpointDir`.

    Where neither is set and the master is local, as in tests, a temporary
    folder stands in until the driver ends, and becomes the checkpoint folder
    too: boosting cuts its lineage only if there is one. On a cluster a
    machine-local folder would be wrong, so one must be named there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    app = context.applicationId
    if app in _LOCAL_FOLDERS:
        return _LOCAL_FOLDERS[app]
    given = context.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="classweave-")
    files, path = hadoop_path(spark, _LOCAL_FOLDERS[app])
    files.deleteOnExit(path)
    context.setCheckpointDir(_LOCAL_FOLDERS[app])
    return _LOCAL_FOLDERS[app]


def fresh_path(spark: SparkSession, name: str = "table") -> str:
    """A path in the shared folder that nothing else uses, deleted when the driver ends.

    All paths of an application lie in one folder of its own.
    """
    folder = f"{shared_folder(spark)}/classweave-{spark.sparkContext.applicationId}"
    files, path = hadoop_path(spark, folder)
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/{name}-{uuid4().hex}"


@contextmanager
def staged(df: DataFrame, sort_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """Write `df` once, read it back many times, and delete it at the end of the block.

    The written table cuts the lineage, survives lost executors, and keeps
    Parquet's column pruning. With `sort_by` every task writes its own rows in
    that order, without a shuffle: a filter on those columns then skips row
    groups and pages by their statistics.
    """
    spark = df.sparkSession
    path = fresh_path(spark)
    laid_out = df.sortWithinPartitions(*sort_by) if sort_by else df
    try:
        laid_out.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)
