"""Runs of equal values in time order (islands and gaps), split by time slice.

A window over all rows of a key would put a key's whole history into one task.
Here runs are found inside (key, time slice) first and then stitched together
over one summary row per slice, so the last step grows with the length of the
time line and not with the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    slice_of: Column,
) -> DataFrame:
    """Runs of ``value`` per key in the order of ``order``.

    ``slice_of`` must not decrease along ``order``. Returns one row per piece of
    a run inside a slice: keys, ``value``, ``island_id`` (1, 2, … per key),
    ``_slice``, ``n_rows``, ``first_at`` and ``last_at`` (the first order
    column). Pieces of the same island share its id; group by it to finish.
    """
    keys = list(keys)
    # Rows without key or time have no place on a time line. Said here, before
    # the shuffle, it keeps both uses of the shuffle alike, so Spark does it once.
    rows = df.withColumn("_slice", slice_of)
    for column in (*keys, "_slice"):
        rows = rows.where(F.col(column).isNotNull())
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    change = (~F.col(value).eqNullSafe(F.lag(value).over(inside))).cast("int")
    first = F.row_number().over(inside) == 1
    pieces = (
        rows.withColumn("_starts", F.when(first, 1).otherwise(change))
        .withColumn(
            "_piece", F.sum("_starts").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(*keys, "_slice", "_piece", value)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(order[0]).alias("first_at"),
            F.max(order[0]).alias("last_at"),
        )
    )
    along = Window.partitionBy(*keys).orderBy("_slice")
    joins_previous = F.col("_head").eqNullSafe(F.lag("_tail").over(along)) & F.lag(
        F.lit(True)
    ).over(along)
    offsets = (
        pieces.groupBy(*keys, "_slice")
        .agg(
            F.max("_piece").alias("_pieces"),
            F.min_by(value, "_piece").alias("_head"),
            F.max_by(value, "_piece").alias("_tail"),
        )
        .withColumn("_merge", F.when(joins_previous, 1).otherwise(0))
        .withColumn("_net", F.col("_pieces") - F.col("_merge"))
        .withColumn(
            "_before",
            F.sum("_net").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_pieces"),
        )
        .select(*keys, "_slice", "_before")
    )
    return (
        pieces.join(offsets, [*keys, "_slice"])
        .withColumn("island_id", (F.col("_before") + F.col("_piece")).cast("bigint"))
        .select(*keys, value, "island_id", "_slice", "n_rows", "first_at", "last_at")
    )
