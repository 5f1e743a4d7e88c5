"""Shared scratch locations and lineage cuts."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where nothing is configured (local tests) a fresh temporary folder is made
    and set as the session's checkpoint folder.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martwright-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_collectors: list[list[str]] = []


@contextlib.contextmanager
def collected() -> Iterator[list[str]]:
    """The paths that :func:`cut_lineage` writes inside the block, for :func:`drop` when they are done with."""
    paths: list[str] = []
    _collectors.append(paths)
    try:
        yield paths
    finally:
        _collectors.remove(paths)


def drop(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete intermediate files that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and go on from the written files.

    Later stages then neither repeat its work nor lose it with an executor, and
    the optimizer knows its true size when it chooses joins. ``compression`` is
    the codec of the files, for long texts; the session's if not given.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path, compression=compression)
    for paths in _collectors:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of one task where its memory grows with them.
TASK_ROWS = 500_000


def spread(stored: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows of a stored ``df`` dealt by ``columns`` to tasks of about ``TASK_ROWS`` rows.

    Scans and adaptive execution size tasks by compressed bytes: where a row takes only a few of them,
    a task gets tens of millions of rows, and an aggregate in it as many groups. Here the number of
    tasks follows the rows, which are counted from the files.
    """
    return stored.repartition(-(-stored.count() // TASK_ROWS) or 1, *columns)
