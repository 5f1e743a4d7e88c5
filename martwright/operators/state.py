"""Workflow state: high-water marks and the load audit log."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import schemas
from martwright.operators.tables import Table

#: The mark of what has never been loaded.
FIRST_MARK = "1900-01-01 00:00:00"


def _one_row(spark: SparkSession, schema: T.StructType, values: tuple) -> DataFrame:
    """A row of literals, made without a Python worker."""
    columns = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, values)]
    return spark.range(1).select(*columns)


class WorkflowState:
    """Settings per workflow key, stored as JSON text like a document."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = Table(spark, path, schemas.SCHEMAS["srv_wf_settings"])

    def get(self, key: str) -> dict[str, Any]:
        found = self.table.read().where(F.col("workflow_key") == key).select("workflow_settings")
        row = found.first()
        return json.loads(row[0]) if row else {}

    def put(self, key: str, settings: dict[str, Any]) -> None:
        row = _one_row(
            self.spark, self.table.schema, (key, json.dumps(settings, sort_keys=True))
        )
        self.table.upsert(row, ["workflow_key"])
        self.table.vacuum()

    def high_water(self, key: str, default: str = FIRST_MARK) -> str:
        """Mark of the last load, or ``default`` before the first."""
        return self.get(key).get("last_loaded_ts", default)

    def advance(self, key: str, mark: str | None, num_loaded: int | None = None) -> None:
        """Move the mark forward (never back); call it after the load has committed."""
        settings = self.get(key)
        if mark is not None and mark > settings.get("last_loaded_ts", ""):
            settings["last_loaded_ts"] = mark
        if num_loaded is not None:
            settings["num_loaded"] = num_loaded
        self.put(key, settings)

    def marks(self, key: str) -> dict[str, str]:
        """Marks by source of a workflow that loads from several; sources without one are missing."""
        return self.get(key).get("marks", {})

    def advance_marks(self, key: str, marks: dict[str, str]) -> None:
        """Move the marks of several sources forward (never back), in one write."""
        settings = self.get(key)
        known = settings.get("marks", {})
        later = {name: mark for name, mark in marks.items() if mark > known.get(name, "")}
        if later:
            self.put(key, {**settings, "marks": {**known, **later}})


def days_before(now: dt.datetime, days: int = 7) -> str:
    """Default mark of a workflow that has never run."""
    return (now - dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")


def greatest_mark(rows: DataFrame, *columns: str) -> str | None:
    """Greatest timestamp over the given columns, as text; NULLs are skipped."""
    marks = [F.max(F.col(c).cast("timestamp_ntz")) for c in columns]
    top = F.greatest(*marks) if len(marks) > 1 else marks[0]
    return rows.agg(top.cast("string")).first()[0]


def audited(
    spark: SparkSession,
    log_path: str,
    schema_name: str,
    table_name: str,
    load_date: dt.datetime,
    action: Callable[[], int | None],
    clock: Callable[[], dt.datetime] = dt.datetime.now,
) -> int | None:
    """Run ``action`` and append one SUCCESS or ERROR row to the log; errors are re-raised."""
    log = Table(spark, log_path, schemas.SCHEMAS["load_log"])

    def note(rows_loaded: int | None, status: str, message: str | None) -> None:
        row = (schema_name, table_name, load_date, clock(), rows_loaded, status, message)
        log.append(_one_row(spark, log.schema, row))

    try:
        loaded = action()
    except Exception as error:
        note(0, "ERROR", str(error))
        raise
    note(loaded, "SUCCESS", None)
    return loaded
