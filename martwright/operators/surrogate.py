"""Dense surrogate keys for new rows without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the digest that name a bucket: 3 digits are 4096 buckets.
BUCKET_DIGITS = 3


def with_surrogate(
    rows: DataFrame,
    id_col: str,
    natural_key: Sequence[str],
    start: int = 0,
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Number ``rows`` ``start + 1, start + 2, …`` in the order of a digest of their key.

    ``natural_key`` must be unique. Rows are spread over digest buckets, ranked
    inside each bucket, and shifted by the size of the buckets before it; only
    the bucket counts (a few thousand rows) are ever ordered in one task. The
    numbering depends on the rows alone, so a recomputed task assigns the same ids.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural_key]
    digest = F.sha1(F.concat_ws("|", *parts))
    bucket = F.substring(digest, 1, bucket_digits)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(bucket.alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_digest", *natural_key)
    # Rows travel without their digest, which does not compress: it is made again where they arrive.
    dealt = rows.repartition(bucket).withColumns({"_digest": digest, "_bucket": bucket})
    return (
        dealt.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .select(
            *rows.columns,
            (F.lit(start) + F.col("_offset") + F.col("_rn")).cast("bigint").alias(id_col),
        )
    )


def next_id(table: DataFrame, id_col: str) -> int:
    """Greatest id in use, 0 for an empty table."""
    return table.agg(F.max(id_col)).first()[0] or 0
