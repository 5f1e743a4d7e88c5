"""One representative row per key, without holding a key's rows in one task.

``max_by`` / ``min_by`` aggregate partially before the shuffle, so a key that
owns a large share of the rows sends one candidate per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.workspace import TASK_ROWS, cut_lineage, spread


def _order(order: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])


def _pick(df: DataFrame, keys: Sequence[str], chosen: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(chosen.alias("_picked"))
        .select(*[c if c in keys else F.col("_picked").getField(c).alias(c) for c in df.columns])
    )


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the greatest ``order`` per key (make it unique for a stable result)."""
    rest = [c for c in df.columns if c not in keys]
    return _pick(df, keys, F.max_by(F.struct(*rest), _order(order)) if rest else None)


def earliest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the smallest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    return _pick(df, keys, F.min_by(F.struct(*rest), _order(order)) if rest else None)


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates`` with a fixed choice: the smallest row by its own columns."""
    return earliest_by(df, keys, [c for c in df.columns if c not in keys])


def distinct_rows(stored: DataFrame) -> DataFrame:
    """``DISTINCT`` of stored rows, most of which are different already; the result is stored too.

    Only a digest of each row is shuffled. Rows whose digest occurs once are different from all others;
    the rest, equal or not, are compared whole. Where they are many, all rows are.
    """
    digest = F.xxhash64(*stored.columns)
    counted = stored.select(digest.alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    again = cut_lineage(counted.where("_n > 1"))
    rows = again.agg(F.sum("_n")).first()[0]
    if not rows:
        return stored
    if rows > 0.1 * stored.count():
        return cut_lineage(stored.distinct())
    marked = stored.withColumn("_digest", digest)
    once = marked.join(again, "_digest", "left_anti").select(*stored.columns)
    compared = marked.join(again, "_digest", "left_semi").select(*stored.columns).distinct()
    return cut_lineage(once.unionByName(compared))


def leaders(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """All rows that share the greatest ``measure`` of their key (rank 1 with ties)."""
    ranked = Window.partitionBy(*keys).orderBy(F.col(measure).desc_nulls_last())
    return (
        df.withColumn("_rank", F.dense_rank().over(ranked)).where("_rank = 1").drop("_rank")
    )


def global_dense_rank(df: DataFrame, measure: str, alias: str, kind: str = "int") -> DataFrame:
    """``dense_rank() OVER (ORDER BY measure DESC)`` without sorting all rows in one task.

    The distinct values of ``measure`` are dealt to tasks by ranges and written with the number of
    their range. A value's rank is its place in its range, moved on by the values of the ranges
    above it; one row per range is all that a single task ever orders. NULL ranks last. The ranks
    are joined back. ``df`` is read several times: give it stored if it is the result of much work.

    The rows are spread before their values are made distinct, so that a task meets a bounded number
    of values even if nearly every row has its own; the ranges follow the number of values.
    """
    falling = F.col("_value").desc_nulls_last()
    # A small number from the whole row, to spread the rows of one value by.
    row = F.pmod(F.hash(*df.columns), F.lit(1 << 16))
    narrow = df.select(F.col(measure).alias("_value"), row.alias("_row"))
    values = cut_lineage(spread(narrow, "_row").select("_value").distinct())
    ranges = -(-values.count() // TASK_ROWS) or 1
    dealt = cut_lineage(
        values.repartitionByRange(ranges, falling).withColumn("_range", F.spark_partition_id())
    )
    above = Window.orderBy(falling).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_range")
        .agg(F.max("_value").alias("_value"), F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(falling))
    ranks = (
        dealt.withColumn("_place", place)
        .join(offsets, "_range")
        .select("_value", (F.col("_above") + F.col("_place")).cast(kind).alias(alias))
    )
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_value")), "left").drop("_value")


def sql_not_in(rows: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``column NOT IN (SELECT other_column …)`` with SQL's NULL rules, as a plain anti-join.

    A NULL among the values leaves no rows; a NULL on the left stays out unless
    there are no values at all. Spark's own null-aware anti-join has to
    broadcast the values; here they only meet the rows in an equi-join, and one
    row of counts decides the NULL cases.
    """
    values = other.select(F.col(other_column).alias("_value"))
    facts = values.agg(
        F.count(F.lit(1)).alias("_values"),
        (F.count(F.lit(1)) - F.count("_value")).alias("_nulls"),
    ).first()
    if facts["_nulls"]:
        return rows.limit(0)
    if not facts["_values"]:
        return rows
    known = values.distinct()
    return rows.where(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("_value"), "left_anti"
    )
