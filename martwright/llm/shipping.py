"""Lets Python workers import this package where it is not installed for them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Adds the repository to the workers' PYTHONPATH.

    That serves local sessions and clusters that hold the repository at the same place; elsewhere
    the package is handed to spark-submit with ``--py-files``, and this changes nothing.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))
