"""Writers: delimited export, partitioned lake folders, relational and message sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_delimited(rows: DataFrame, path: str, sep: str = "|", null_marker: str = "\\N") -> None:
    """Headerless export with a NULL marker, for bulk loaders."""
    (
        rows.write.mode("overwrite")
        .option("sep", sep)
        .option("nullValue", null_marker)
        # An empty string stays distinguishable from NULL.
        .option("emptyValue", '""')
        .csv(path)
    )


def write_lake(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Partitioned Parquet; only partitions that occur in ``rows`` are replaced."""
    (
        rows.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_run(rows: DataFrame, path: str, date: str) -> None:
    """Result of one run below ``<path>/date=<date>``; a repeated run replaces it."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/date={date}")


def as_messages(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each row as one JSON text in ``value``."""
    return rows.select(F.to_json(F.struct(*(columns or rows.columns))).alias("value"))


def write_rows(rows: DataFrame, options: Mapping[str, str], mode: str = "append") -> None:
    """Write through connector options (``jdbc``, ``kafka``, file formats)."""
    options = dict(options)
    sink = options.pop("format", "parquet")
    rows.write.format(sink).mode(mode).options(**options).save()


def write_messages(rows: DataFrame, options: Mapping[str, str], batch: str) -> None:
    """Messages of one micro-batch.

    A broker gets them appended (at least once). A file sink keeps one folder
    per batch and replaces it, so a replayed batch leaves no duplicates.
    """
    options = dict(options)
    sink = options.pop("format", "kafka")
    if sink == "kafka":
        rows.write.format(sink).options(**options).save()
    else:
        path = options.pop("path")
        rows.write.mode("overwrite").format(sink).options(**options).save(f"{path}/batch={batch}")


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """First rows of a landed file."""
    return rows.limit(n)
