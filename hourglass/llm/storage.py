"""Written tables in the cluster's shared checkpoint folder: a lineage cut that survives lost executors."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from hourglass.session import checkpoint_dir


def shared_folder(spark: SparkSession, name: str = "llm") -> str:
    """A new folder below ``spark.checkpoint.dir``; every call gets its own."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    path = shared_folder(df.sparkSession, name)
    for scope in _SCOPES:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Paths written inside the open scopes.
_SCOPES: list[list[str]] = []


def decided(spark: SparkSession, name: str, plan) -> DataFrame:
    """The rows of ``plan()``, written; the tables that were written to get them are dropped.

    For decisions (ids, keys, spans) that are small against what they were found with.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        out = plan()
        path = shared_folder(spark, name)
        out.write.parquet(path)
    finally:
        _SCOPES.pop()
        for p in paths:
            drop(spark, p)
    return spark.read.schema(out.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Drop a table of :func:`written` that nothing lazy reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        drop(table.sparkSession, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a written table, in whatever store the shared folder is."""
    with contextlib.suppress(Exception):  # a table that stays costs space, not results
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
