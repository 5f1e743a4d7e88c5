"""Sharding by extendible hashing: a directory of hash-prefix bits in which only full buckets split.

A shard is a prefix of the bits of md5(key). The whole corpus starts as the shard of the empty
prefix; a shard of more than ``max_bytes`` and more than one row splits on its next bit. Bytes are
summed once per prefix of a depth a little finer than the shards will need; sums of shorter prefixes
follow from those. Prefixes that are still too full at that depth are looked at again, deeper.

Defined results: null and empty texts have no bytes; a single document over the limit is a shard of
its own; rows that share all hash bits (repeated keys, null keys) cannot be split by hashing and are
chained in pages (``page`` > 0), each within the limit; an empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage

BITS = 60
FINER = 4


def _prefix(depth: int) -> Column:
    return F.substring("_bits", 1, depth)


def _directory(pending: DataFrame, depth: int, max_bytes: int) -> DataFrame:
    """Rows (_cell, depth): the depth of the shard that holds a cell of ``depth`` bits, null if deeper."""
    cells = cut_lineage(
        pending.groupBy(_prefix(depth).alias("_cell")).agg(
            F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"), F.max("_size").alias("_most")
        )
    )
    levels = cells.select(
        "_cell", "_bytes", "_rows", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("_depth")
    ).withColumn("_at", F.substr("_cell", F.lit(1), F.col("_depth")))
    sums = levels.groupBy("_depth", "_at").agg(F.sum("_bytes").alias("_b"), F.sum("_rows").alias("_r"))
    fit = sums.where((F.col("_b") <= max_bytes) | (F.col("_r") == 1))
    found = levels.join(fit, ["_depth", "_at"]).groupBy("_cell").agg(F.min("_depth").alias("depth"))
    return cells.select("_cell", "_most").join(found, "_cell", "left")


def shards(
    docs: DataFrame, max_bytes: int, key: str = "doc_id", size: Column | None = None
) -> DataFrame:
    """``docs`` with n_bytes, shard (its bits), depth and page. ``size``: default the bytes of ``text``."""
    size = F.octet_length(F.coalesce("text", F.lit(""))) if size is None else size
    digits = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    pending = docs.withColumn("_size", F.coalesce(size.cast("long"), F.lit(0))).withColumn(
        "_bits", F.lpad(F.conv(F.substring(digits, 1, BITS // 4), 16, 2), BITS, "0")
    )
    total = pending.agg(F.sum("_size")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total / max_bytes)))) + FINER)
    done = None
    while True:
        directory = cut_lineage(_directory(pending, depth, max_bytes))
        last = depth == BITS
        known = directory if last else directory.where("depth IS NOT NULL")
        placed = (
            pending.withColumn("_cell", _prefix(depth))
            .join(known, "_cell")
            .withColumn("_full", F.col("depth").isNull())
            .withColumn("depth", F.coalesce("depth", F.lit(BITS)))
        )
        if last:
            # What no bit can part: pages of start offsets, so narrow that a page keeps the limit.
            width = F.greatest(F.lit(max_bytes) - F.col("_most"), F.lit(1))
            order = Window.partitionBy("_cell").orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
            run = F.coalesce(F.sum("_size").over(order), F.lit(0))
            placed = placed.withColumn("page", F.when(F.col("_full"), F.floor(run / width)).otherwise(F.lit(0)).cast("long"))
        else:
            placed = placed.withColumn("page", F.lit(0).cast("long"))
        placed = placed.withColumn("shard", F.substr("_bits", F.lit(1), F.col("depth").cast("int")))
        placed = placed.drop("_cell", "_most", "_full")
        done = placed if done is None else done.unionByName(placed)
        if last or not directory.where("depth IS NULL").limit(1).count():
            break
        open_cells = directory.where("depth IS NULL").select("_cell")
        pending = pending.withColumn("_cell", _prefix(depth)).join(open_cells, "_cell", "left_semi").drop("_cell")
        depth = min(BITS, depth + 8)
    return done.withColumn("n_bytes", F.col("_size")).withColumn("depth", F.col("depth").cast("int")).drop("_size", "_bits")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard and page; rows of a shard are brought together first."""
    (
        sharded.withColumn("shard", F.concat(F.lit("b"), F.col("shard")))
        .repartition("shard", "page")
        .write.partitionBy("shard", "page")
        .parquet(path)
    )
