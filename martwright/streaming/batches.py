"""Micro-batch building blocks: batch identity and tables that tolerate replays.

Every row a micro-batch adds lies in a partition named after that batch, and a
batch is compared with the rows of *other* batches only. What depends on the
moment of the run or on tables that change meanwhile is written to a journal in
the checkpoint before any sink sees it, and a retry takes it from there. Running
a batch again therefore leaves the same rows, whatever the clock says. Batches
carry the identity of their checkpoint: a new one starts its epochs from zero
without touching what an older one has written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.pick import earliest_by
from martwright.operators.tables import Table

BATCH = "batch"
MERGED = "merged"



def batch_name(stream: str, epoch_id: int) -> str:
    """Name of a micro-batch; ``stream`` names the checkpoint the epochs belong to."""
    return f"{stream}-{epoch_id:012d}"


def batch_table(spark: SparkSession, path: str, schema: T.StructType) -> Table:
    fields = [*schema.fields, T.StructField(BATCH, T.StringType())]
    return Table(spark, path, T.StructType(fields), [BATCH])


def _children(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


class Journal:
    """What the first attempt at each batch decided, kept in the query's checkpoint.

    An entry counts once Spark's ``_SUCCESS`` marker is there; an attempt that dies before is made anew.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, stream: str):
        self.spark = spark
        self.path = f"{checkpoint.rstrip('/')}/journal"
        self.stream = f"{stream}-{self._identity()}"

    def _identity(self) -> str:
        known = [c for c in _children(self.spark, self.path) if c.startswith("id=")]
        if not known:
            known = [f"id={uuid.uuid4().hex[:12]}"]
            marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{known[0]}")
            marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(marker)
        return min(known)[3:]

    def batch(self, epoch_id: int) -> str:
        return batch_name(self.stream, epoch_id)

    def once(self, batch: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The rows that ``make`` gave at the first attempt at ``batch``."""
        entry = f"{self.path}/{batch}"
        if "_SUCCESS" not in _children(self.spark, entry):
            make().write.mode("overwrite").parquet(entry)
        return self.spark.read.parquet(entry)


def insert_new(
    table: Table,
    rows: DataFrame,
    keys: Sequence[str],
    batch: str,
    order: Sequence[str | Column] | None = None,
) -> None:
    """Insert-or-ignore by ``keys``; rows without a complete key are skipped."""
    replace_batch(table, new_rows(table, rows, keys, batch, order), batch)


def new_rows(
    table: Table,
    rows: DataFrame,
    keys: Sequence[str],
    batch: str,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The first row of each complete key that no other batch has stored."""
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    firsts = earliest_by(rows, keys, order or [c for c in rows.columns if c not in keys])
    if table.exists:
        others = table.read().where(F.col(BATCH) != batch).select(*keys)
        firsts = firsts.join(_matching(others, firsts, keys), list(keys), "left_anti")
    return firsts


def _matching(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys that occur in the batch.

    Give this function rows from written files, so that Spark knows their size
    and broadcasts them where it can instead of shuffling the table.
    """
    return stored.join(incoming.select(*keys), list(keys), "left_semi")


def rows_of(table: Table, batch: str) -> DataFrame:
    """What a batch added."""
    return table.read().where(F.col(BATCH) == batch).drop(BATCH)


def replace_batch(table: Table, rows: DataFrame, batch: str) -> None:
    """Store the rows of a batch, replacing an earlier attempt.

    All of them belong to one partition, so that no shuffle need gather them.
    """
    table.overwrite_slices(rows.withColumn(BATCH, F.lit(batch)), gather=False)


def compact(table: Table, keys: Sequence[str]) -> None:
    """Gather the partitions of finished batches in one, as a new version.

    The newest batch of each stream may still be retried, so it keeps its partition. Rows are laid
    out in the order of ``keys``: every row group then covers a narrow range of them, which look-ups
    of single keys skip by its bounds.
    """
    stored = table.read()
    newest = stored.select(BATCH).distinct().groupBy(F.regexp_replace(BATCH, "-[0-9]+$", "")).agg(F.max(BATCH).alias("_newest"))
    marked = stored.join(newest.select("_newest"), F.col(BATCH) == F.col("_newest"), "left")
    rows = marked.withColumn(BATCH, F.coalesce("_newest", F.lit(MERGED))).drop("_newest")
    table.replace(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))


def run_stream(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
):
    """Start a ``foreachBatch`` query; by default it takes what is there and stops.

    ``trigger={"processingTime": "25 seconds"}`` together with
    ``maxOffsetsPerTrigger`` (or ``maxFilesPerTrigger``) on the source bounds
    the batches of a continuous run.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return (writer.queryName(name) if name else writer).start()


def poll(query, stop: Callable[[], bool], pause: float = 1.0) -> None:
    """Let a continuous query run until ``stop()`` and end it between two batches.

    ``stop`` is asked every ``pause`` seconds. The batch that is under way then is finished first. If the
    next one has started by the time the query ends, it is run again by the next start from the
    checkpoint, with the same rows.
    """
    while query.isActive and not stop():
        query.awaitTermination(pause)
    done = _last_batch(query)
    while query.isActive and query.status["isTriggerActive"] and _last_batch(query) == done:
        query.awaitTermination(pause / 10)
    query.stop()
    # A query that has failed raises here.
    query.awaitTermination()


def _last_batch(query) -> int:
    last = query.lastProgress
    return last["batchId"] if last else -1


def finished_batches(query) -> int:
    """Batches with rows that a query has committed since it started."""
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)
