"""Order stream -> order vault and enriched messages; enriched stream -> counters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import schemas
from martwright.operators.tables import Table
from martwright.operators.workspace import cut_lineage
from martwright.plans.order_vault import (
    CLOSED,
    VAULT,
    closed_orders,
    count_orders,
    counter_lines,
    enriched_messages,
    vault_rows,
)
from martwright.sources.readers import read_messages
from martwright.sources.writers import as_messages, write_messages
from martwright.streaming.batches import (
    Journal,
    batch_name,
    batch_table,
    insert_new,
    replace_batch,
    rows_of,
    run_stream,
)

# Fixed value: what the vault's audit column calls this source.
LOAD_SOURCE = "stg-service"
_AUDIT = [T.StructField("load_dt", T.TimestampNTZType()), T.StructField("load_src", T.StringType())]


# -- landing ----------------------------------------------------------------


def landing_table(spark: SparkSession, path: str) -> Table:
    """Raw orders keyed by ``object_id``."""
    return batch_table(
        spark, path, T.StructType.fromDDL("object_id BIGINT, object_type STRING, payload STRING")
    )


def start_landing(
    spark: SparkSession,
    source: Mapping[str, str],
    landing: Table,
    checkpoint: str,
    stream: str = "landing",
    trigger: Mapping[str, object] | None = None,
):
    """Land order messages once per ``object_id``, payload kept as JSON text."""
    schema = T.StructType.fromDDL("object_id BIGINT, object_type STRING, payload STRING")
    messages = read_messages(spark, source, schema)
    journal = Journal(spark, checkpoint, stream)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        insert_new(landing, cut_lineage(batch, "zstd"), ["object_id"], journal.batch(epoch_id))

    return run_stream(messages, handle, checkpoint, trigger)


# -- vault ------------------------------------------------------------------


def vault_tables(
    spark: SparkSession, root: str, names: Iterable[str] = tuple(VAULT)
) -> dict[str, Table]:
    return {
        name: batch_table(
            spark, f"{root}/{name}", T.StructType([*schemas.SCHEMAS[name].fields, *_AUDIT])
        )
        for name in names
    }


def vault_handler(
    tables: Mapping[str, Table], enriched: Mapping[str, str], stream: str
) -> Callable[[DataFrame, int], None]:
    """Handler of one micro-batch of order messages."""

    def handle(batch: DataFrame, epoch_id: int) -> None:
        orders = cut_lineage(closed_orders(batch), "zstd")
        if orders.isEmpty():
            return
        name = batch_name(stream, epoch_id)
        rows_by_table = vault_rows(orders)
        for table, target in tables.items():
            rows = rows_by_table[table]
            stamped = rows.withColumn(
                "load_dt", F.current_timestamp().cast("timestamp_ntz")
            ).withColumn("load_src", F.lit(LOAD_SOURCE))
            key = VAULT[table]
            content = [c for c in rows.columns if c != key]
            insert_new(target, stamped, [key], name, content)
        write_messages(as_messages(enriched_messages(orders)), enriched, name)

    return handle


def start_vault(
    spark: SparkSession,
    source: Mapping[str, str],
    tables: Mapping[str, Table],
    enriched: Mapping[str, str],
    checkpoint: str,
    stream: str = "orders",
    trigger: Mapping[str, object] | None = None,
):
    # Only closed orders go to the vault: messages that cannot be one need no parsing.
    messages = read_messages(spark, source, schemas.SCHEMAS["order_message"], CLOSED)
    name = Journal(spark, checkpoint, stream).stream
    return run_stream(messages, vault_handler(tables, enriched, name), checkpoint, trigger)


# -- counters ---------------------------------------------------------------


def counter_tables(spark: SparkSession, root: str) -> dict[str, Table]:
    """Counter increments per batch, and the orders already counted."""
    last = T.StructField("last_object_id", T.LongType())
    tables = {
        subject: batch_table(
            spark,
            f"{root}/user_{subject}_counters",
            T.StructType([*schemas.SCHEMAS[f"user_{subject}_counters"].fields, last]),
        )
        for subject in ("product", "category")
    }
    tables["counted"] = batch_table(
        spark, f"{root}/counted_orders", T.StructType.fromDDL("object_id BIGINT")
    )
    return tables


def counter_handler(
    tables: Mapping[str, Table], stream: str, semantics: str = "reference"
) -> Callable[[DataFrame, int], None]:
    """Handler of one micro-batch of enriched messages.

    An order is counted once: repeated messages, in this batch or from an
    earlier one, are dropped by ``object_id``. A batch stores its increments
    only; the running counters are their sum.
    """

    def handle(batch: DataFrame, epoch_id: int) -> None:
        orders = cut_lineage(batch.dropDuplicates(["object_id"]), "zstd")
        if orders.isEmpty():
            return
        name = batch_name(stream, epoch_id)
        insert_new(tables["counted"], orders.select("object_id"), ["object_id"], name)
        fresh = orders.join(rows_of(tables["counted"], name), "object_id", "left_semi")
        lines = counter_lines(fresh)
        for subject in ("product", "category"):
            replace_batch(tables[subject], count_orders(lines, subject, semantics), name)

    return handle


def start_counters(
    spark: SparkSession,
    source: Mapping[str, str],
    tables: Mapping[str, Table],
    checkpoint: str,
    stream: str = "counters",
    semantics: str = "reference",
    trigger: Mapping[str, object] | None = None,
):
    messages = read_messages(spark, source, schemas.SCHEMAS["enriched_message"])
    name = Journal(spark, checkpoint, stream).stream
    return run_stream(messages, counter_handler(tables, name, semantics), checkpoint, trigger)


def read_counters(tables: Mapping[str, Table], subject: str) -> DataFrame:
    """Running counters: the sum of all increments, with the latest name."""
    key, name = f"{subject}_id", f"{subject}_name"
    return (
        tables[subject]
        .read()
        .groupBy("user_id", key)
        .agg(
            F.max_by(name, "last_object_id").alias(name),
            F.sum("order_cnt").alias("order_cnt"),
        )
    )
