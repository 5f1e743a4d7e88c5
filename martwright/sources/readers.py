"""Readers: day windows of a lake, delimited files with rejects, documents, extracts, topics."""

from __future__ import annotations

import csv
import datetime as dt
import functools
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import decimal_comma
from martwright.operators.pick import dedupe
from martwright.operators.tables import Table
from martwright.operators.workspace import cut_lineage

CORRUPT = "_corrupt"
#: Layout of a table of rejected rows.
REJECTS = "path STRING, rejected STRING"


def days_back(date: str, depth: int) -> list[str]:
    """The ``depth`` days that end with ``date``, newest first."""
    last = dt.date.fromisoformat(date)
    return [(last - dt.timedelta(days=i)).isoformat() for i in range(depth)]


def read_days(spark: SparkSession, path: str, date: str, depth: int) -> DataFrame:
    """Rows of the last ``depth`` days of a ``date=`` partitioned folder.

    A predicate on the partition column: only those folders are listed and
    read, and a day without data is simply empty.
    """
    days = [F.lit(d).cast("date") for d in days_back(date, depth)]
    return spark.read.parquet(path).where(F.col("date").isin(days))


def read_day_folders(spark: SparkSession, path: str, date: str, depth: int) -> DataFrame:
    """The same window through explicit folders; a missing day is an error."""
    folders = [f"{path.rstrip('/')}/date={d}" for d in days_back(date, depth)]
    return spark.read.option("basePath", path).parquet(*folders)


class RejectLimitError(ValueError):
    """A bulk load has more rejected rows than allowed."""


def layouts(spark: SparkSession, path: str, sep: str = ",", quote: str = '"') -> dict[tuple[str, ...], list[str]]:
    """The header lines that occur below ``path``, each with its files; names in lower case.

    A file's first line that is not blank is its header. One line per file comes to the driver, which
    lists the files for every read as well.
    """
    first = (
        spark.read.text(path)
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .where("file_block_start = 0 AND trim(value) != ''")
        .withColumn("at", F.monotonically_increasing_id())
        .groupBy("file_path")
        .agg(F.min_by("value", "at").alias("line"))
    )
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file_path").collect():
        fields = next(csv.reader([row["line"].lstrip("\ufeff")], delimiter=sep, quotechar=quote))
        names = tuple(name.strip().lower() for name in fields)
        found.setdefault(names, []).append(unquote(row["file_path"]))
    return found


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
    null_value: str = "",
    reject_max: int | None = None,
    multi_line: bool = False,
    rejects: Table | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` rows of delimited files.

    With ``header`` each file's columns go by the names in its first line, in any order and case:
    columns that a file lacks are NULL, others than those of ``schema`` are left out. Without it they
    go by position. Rows that do not fit are rejected with their text. With ``reject_max`` the load
    fails when more rows than that are rejected; ``rejects``, a table of layout ``REJECTS``, keeps them
    before that. The parsed rows are written once to the shared folder, so counting the rejects does
    not parse the files again. A quote inside quoted text is doubled; ``multi_line`` is for quoted
    texts that hold line breaks.
    """
    corrupt = T.StructField(CORRUPT, T.StringType())
    reader = (
        spark.read.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("header", header)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote)
        .option("multiLine", multi_line)
        .option("nullValue", null_value)
        .option("enforceSchema", True)
        # A row is judged by all columns of its file, also by those that are left out.
        .option("columnPruning", False)
    )
    if header:
        parts = [
            _named(reader, files, names, schema, corrupt)
            for names, files in layouts(spark, path, sep, quote).items()
        ]
    else:
        parts = [reader.schema(T.StructType([*schema.fields, corrupt])).csv(path)]
    if not parts:
        parts = [spark.createDataFrame([], T.StructType([*schema.fields, corrupt]))]
    parsed = cut_lineage(functools.reduce(DataFrame.unionByName, parts))
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    rejected = parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("rejected"))
    if rejects is not None:
        rejects.append(rejected.withColumn("path", F.lit(path)))
    if reject_max is not None:
        bad = rejected.count()
        if bad > reject_max:
            raise RejectLimitError(f"{bad} rejected rows in {path}, {reject_max} allowed")
    return good, rejected


def _named(reader, files: list[str], names: tuple[str, ...], schema: T.StructType, corrupt: T.StructField) -> DataFrame:
    """Files of one header as columns of ``schema``, with the text of rows that do not fit."""
    known = {f.name.lower(): f for f in schema.fields}
    if len(set(names)) < len(names):
        raise ValueError(f"{files[0]}: the header names a column twice: {', '.join(names)}")
    if not known.keys() & set(names):
        raise ValueError(f"{files[0]}: the header names no column of the table: {', '.join(names)}")
    # Columns that are left out keep a name that no wanted column has.
    fields = [
        T.StructField(known[n].name, known[n].dataType) if n in known else T.StructField(f"_other{i}", T.StringType())
        for i, n in enumerate(names)
    ]
    rows = reader.schema(T.StructType([*fields, corrupt])).csv(files)
    columns = [
        (F.col(f.name) if f.name.lower() in names else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*columns, CORRUPT)


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """City list: ``;`` separated with header, coordinates with a decimal comma."""
    return clean_cities(spark.read.option("header", True).option("sep", ";").csv(path))


def clean_cities(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        "city",
        decimal_comma(F.col("lat")).alias("city_lat"),
        decimal_comma(F.col("lng")).alias("city_lng"),
    )


def prepare_increment(
    rows: DataFrame,
    key: str = "uniq_id",
    drop: Sequence[str] = ("id",),
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Increment ready for staging: helper id dropped, one row per key, missing columns filled."""
    kept = dedupe(rows.drop(*drop), [key])
    for name, value in (defaults or {}).items():
        if name not in kept.columns:
            kept = kept.withColumn(name, F.lit(value))
    return kept


def load_increment(
    spark: SparkSession,
    path: str,
    staging: Table,
    key: str = "uniq_id",
    defaults: Mapping[str, object] | None = None,
    reject_max: int | None = None,
    rejects: Table | None = None,
) -> None:
    """Files of an increment into its staging table; rows whose key is there already stay as they are.

    Columns go by the names in the files. ``defaults`` fill columns that no file has; a row whose file
    lacks one that others have gets the default, too. A repeated load changes nothing.
    """
    rows, _ = read_delimited(spark, path, staging.schema, reject_max=reject_max, rejects=rejects)
    rows = rows.fillna(dict(defaults or {}))
    staging.insert_if_new(rows, [key])


def read_documents(spark: SparkSession, path: str, id_col: str, schema: T.StructType) -> DataFrame:
    """JSON lines as documents: natural id and the whole body as text."""
    lines = spark.read.text(path)
    body = F.from_json("value", schema)
    return lines.select(
        body[id_col].cast("string").alias("object_id"), F.col("value").alias("object_value")
    )


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Table behind connector options: ``format`` plus whatever that format takes.

    For ``jdbc`` pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that large tables are read by several tasks.
    """
    options = dict(options)
    source = options.pop("format", "parquet")
    return spark.read.format(source).options(**options).load()


def read_messages(
    spark: SparkSession, options: Mapping[str, str], schema: T.StructType, holding: str | None = None
):
    """Stream of JSON messages as columns of ``schema``; ``holding`` as in :func:`parse_messages`.

    ``format`` is ``kafka`` or ``text`` (one message per line of landed files);
    both give a ``value`` column, parsed the same way. Messages that are not
    JSON objects come out as rows of NULLs, as ``from_json`` defines.
    """
    options = dict(options)
    source = options.pop("format", "kafka")
    stream = spark.readStream.format(source)
    if source == "text":
        stream = stream.schema("value STRING")
    return parse_messages(stream.options(**options).load(), schema, holding)


def parse_messages(raw: DataFrame, schema: T.StructType, holding: str | None = None) -> DataFrame:
    """Columns of ``schema`` from JSON texts in ``value``.

    Texts that cannot hold the value ``holding``, a plain word, are left out unparsed: they have neither
    the word nor an escape, by which JSON may spell it otherwise.
    """
    text = F.col("value").cast("string")
    if holding:
        raw = raw.where(text.contains(holding) | text.contains("\\u"))
    body = F.from_json(text, schema)
    return raw.select(body.alias("_m")).select("_m.*")
