"""Load semantics for Parquet tables: refresh, slice overwrite, insert-if-new, upsert.

A table is a folder of complete versions, ``<path>/v=000001`` and so on. The
current one is the newest that carries Spark's ``_SUCCESS`` marker, so a job
that dies half-way leaves the previous version in force. Rewrites go to a new
version; appends and partition overwrites stay inside the current one.

Joins against the target are shaped so that the (large) target is scanned but
not shuffled whenever the incoming batch is small enough for Spark to broadcast
it; that choice is left to the optimizer's size statistics.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.pick import earliest_by, latest_by
from martwright.operators.surrogate import next_id, with_surrogate
from martwright.operators.workspace import cut_lineage



def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which NULL keys are equal to each other."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(named, on, how)


class Table:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | str,
        partition_by: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.partition_by = list(partition_by)

    # -- reading -----------------------------------------------------------

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("v=") and fs.exists(marker):
                found.append(int(name[2:]))
        return sorted(found)

    def location(self, version: int) -> str:
        return f"{self.path}/v={version:06d}"

    @property
    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        """Rows of the current version; no rows before the first load."""
        done = self.versions()
        if not done:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            return self.spark.range(0).select(*nothing)
        frame = self.spark.read.schema(self.schema).parquet(self.location(done[-1]))
        return frame.select(*self.schema.names)

    # -- writing -----------------------------------------------------------

    def _conform(self, rows: DataFrame, without: str | None = None) -> DataFrame:
        return rows.select(
            *[
                F.col(f.name).cast(f.dataType).alias(f.name)
                for f in self.schema.fields
                if f.name != without
            ]
        )

    def _numbered(self, rows: DataFrame, keys: Sequence[str], id_col: str | None) -> DataFrame:
        """New rows with the next surrogate ids, if the table has such a column."""
        if id_col is None:
            return rows
        start = next_id(self.read(), id_col) if self.exists else 0
        # Numbering reads the rows twice, for the bucket sizes and for the ranks.
        return with_surrogate(cut_lineage(rows), id_col, keys, start)

    def _gathered(self, rows: DataFrame) -> DataFrame:
        """Rows of one partition value brought together before the write.

        Otherwise every task would open a file in every partition. ``rebalance``
        lets AQE split a value that is too large for one task.
        """
        if not self.partition_by:
            return rows
        return rows.hint("rebalance", *[F.col(c) for c in self.partition_by])

    def _write(self, rows: DataFrame, location: str, mode: str, dynamic: bool = False) -> None:
        writer = self._conform(rows).write.mode(mode)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(location)

    def refresh(self, rows: DataFrame) -> None:
        """Replace the whole content (truncate and insert) as a new version."""
        self.replace(self._gathered(rows))

    def replace(self, rows: DataFrame) -> None:
        """Like :meth:`refresh`, with the rows laid out as they come."""
        done = self.versions()
        self._write(rows, self.location(done[-1] + 1 if done else 1), "overwrite")

    def append(self, rows: DataFrame) -> None:
        done = self.versions()
        self._write(self._gathered(rows), self.location(done[-1] if done else 1), "append")

    def overwrite_slices(self, rows: DataFrame, gather: bool = True) -> None:
        """Replace exactly the partitions that occur in ``rows``; re-running is harmless.

        Rows that are known to lie in few partitions may be written as they come, without ``gather``.
        """
        if not self.partition_by:
            raise ValueError("overwrite_slices needs a partitioned table")
        self._replace_slices(self._gathered(rows) if gather else rows)

    def _replace_slices(self, rows: DataFrame) -> None:
        done = self.versions()
        if not done:
            # A dynamic overwrite leaves no _SUCCESS marker; the first load must.
            self.replace(rows)
        else:
            self._write(rows, self.location(done[-1]), "overwrite", dynamic=True)

    def _existing_keys(self, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Keys of ``incoming`` that the table already holds."""
        wanted = incoming.select(*keys)
        return self.read().select(*keys).join(wanted, list(keys), "left_semi")

    def insert_if_new(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str | Column] | None = None,
        id_col: str | None = None,
    ) -> None:
        """Insert rows whose key is absent; existing rows stay as they are.

        Several incoming rows of one key are reduced to the smallest by
        ``order`` (all columns when not given). With ``id_col`` the inserted
        rows get the next surrogate ids. As with NOT IN, a row whose key has a
        NULL is not inserted: no later load could tell that it is there.
        """
        rows = self._conform(rows, id_col).dropna(subset=list(keys))
        firsts = earliest_by(rows, keys, order or [c for c in rows.columns if c not in keys])
        if not self.exists:
            self.refresh(self._numbered(firsts, keys, id_col))
            return
        firsts = cut_lineage(firsts)
        fresh = firsts.join(self._existing_keys(firsts, keys), list(keys), "left_anti")
        self.append(self._numbered(fresh, keys, id_col))

    def upsert(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str | Column] | None = None,
        update: Mapping[str, Column] | None = None,
        unique: bool = False,
        id_col: str | None = None,
    ) -> None:
        """MERGE: update the rows whose key exists, insert the others.

        ``update`` maps a column to an expression over ``t`` (target) and ``s``
        (source); without it every non-key column takes the source value.
        Several incoming rows of one key are reduced to the greatest by
        ``order``, unless the caller knows them to be ``unique``. With
        ``id_col`` updated rows keep their surrogate id and inserted rows get
        the next ones. NULL keys are equal to each other, so that a load which
        is repeated changes nothing; a load without rows writes nothing.
        """
        source = self._conform(rows, id_col)
        if not unique:
            source = latest_by(
                source, keys, order or [c for c in source.columns if c not in keys]
            )
        if not self.exists:
            self.refresh(self._numbered(source, keys, id_col))
            return
        source = cut_lineage(source)
        if source.isEmpty():
            return
        target = self.read()
        confined = bool(self.partition_by) and set(self.partition_by) <= set(keys)
        if confined:
            target = self._touched(target, source)
        setters = update or {
            c: F.col(f"s.{c}") for c in source.columns if c not in keys
        }
        hit = F.col("s._hit").isNotNull()
        on = functools.reduce(
            lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
        )
        kept = (
            target.alias("t")
            .join(source.withColumn("_hit", F.lit(True)).alias("s"), on, "left")
            .select(
                *[
                    F.when(hit, setters[c]).otherwise(F.col(f"t.{c}")).alias(c)
                    if c in setters
                    else F.col(f"t.{c}")
                    for c in self.schema.names
                ]
            )
        )
        known = null_safe_join(target.select(*keys), source.select(*keys), keys, "left_semi")
        fresh = null_safe_join(source, known, keys, "left_anti")
        added = self._numbered(fresh, keys, id_col).select(*self.schema.names)
        # Kept rows come from files of one partition each; only additions need gathering.
        merged = kept.unionByName(self._gathered(added))
        if confined:
            self._replace_slices(merged)
        else:
            self.replace(merged)

    def _touched(self, target: DataFrame, source: DataFrame) -> DataFrame:
        """The rows of ``target`` in the partitions that ``source`` has rows for."""
        parts = source.select(*self.partition_by).distinct()
        return null_safe_join(target, parts, self.partition_by, "left_semi")

    def clear_slice(self, **values) -> None:
        """Remove one partition: a slice that has been extracted again and is now empty."""
        done = self.versions()
        if not done:
            return
        folders = "/".join(f"{c}={values[c]}" for c in self.partition_by)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location(done[-1])}/{folders}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions."""
        jvm = self.spark._jvm
        for version in self.versions()[:-keep]:
            old = jvm.org.apache.hadoop.fs.Path(self.location(version))
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
