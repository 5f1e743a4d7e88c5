"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks partition numbers, splits skewed join partitions and
# turns joins into broadcasts by measured sizes. The initial number of shuffle
# partitions only has to be large enough; small ones are merged.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def build(app_name: str, shuffle_partitions: int = 20000, **settings: str) -> SparkSession:
    """Session for a cluster job; ``spark-submit`` options win over these defaults.

    ``shuffle_partitions`` is the starting number for adaptive execution. At
    128 MB each, 20 000 of them hold a shuffle of 2.5 TB without spilling much;
    raise it for larger ones.
    """
    builder = SparkSession.builder.appName(app_name)
    wanted = {
        **SETTINGS,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_partitions),
        **settings,
    }
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
