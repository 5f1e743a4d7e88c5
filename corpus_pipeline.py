"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below the
shared folder, and the next stage reads it. All but the last keep the columns of ``documents``. The files
that a stage makes on its way are deleted when the next stage starts, unless that one still reads them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import mixing, near_copies, packing, quality, secret_scan, shipping
from martwright.operators.workspace import collected, cut_lineage, drop

_left_behind: list[str] = []


def stage(run: Callable[[SparkSession, DataFrame, str], DataFrame]):
    @functools.wraps(run)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _left_behind else []
        if not any(path.rsplit("/", 1)[-1] in file for path in _left_behind for file in read):
            drop(spark, _left_behind)
            _left_behind.clear()
        with collected() as made:
            result = run(spark, docs, sf_dir)
        _left_behind.extend(made)
        return result

    return staged


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fences of their language and source."""
    return quality.judge(docs).where("kept").select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose five-word shingles are at least 0.8 alike."""
    shipping.importable(spark)
    return near_copies.one_of_each(docs)


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of every secret; n_chars follows the new text."""
    clean = secret_scan.redact(secret_scan.scan(docs))
    changed = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(*docs.columns)


@stage
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: files and rows follow (slot, place)."""
    return mixing.mix(docs).orderBy("slot", "place").select(*docs.columns)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences, which are numbered in the order of the mix."""
    shipping.importable(spark)
    # Files do not keep an order of rows, so slot and place are computed again, from sizes alone.
    sized = docs.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    )
    cut = packing.pieces(sized, along=("_row", "source", "_bytes")).withColumnRenamed("key", "doc_id")
    cut = cut_lineage(cut)
    order = mixing.mix(cut.where("piece = 0"), size=F.col("_bytes")).select("_row", "slot", "place")
    ordered = cut.join(order, "_row").drop("source", "_bytes")
    # Inside a district bins take documents as they fit; small ones keep close to the mix.
    found = packing.pack(ordered, district=500, along=("slot", "place", "_row", "piece"))
    return found.drop("slot", "place", "_row")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", secrets),
    ("source mix", mixed_sources),
    ("packing", packed),
]

#: Fingerprints, token ids and packings have no SQL counterpart; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
