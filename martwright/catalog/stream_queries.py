"""Streaming queries: landed message files drained to the end, every file also replayed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import schemas
from martwright.catalog.registry import query
from martwright.catalog.views import view
from martwright.operators.workspace import scratch
from martwright.plans.notifications import NOTIFICATION_KEY
from martwright.plans.order_vault import HUBS, LINKS, SATELLITES
from martwright.sources.readers import parse_messages
from martwright.sources.writers import as_messages
from martwright.streaming import campaigns, orders
from martwright.streaming.batches import BATCH, Journal, compact, finished_batches, poll

# Fixed "now" of the campaign test, epoch seconds.
NOW = 1700003000


def _land(messages, path):
    """Two folders with the same messages: the second is a replay."""
    messages.write.text(f"{path}/part=1", compression="gzip")
    messages.sparkSession.read.text(f"{path}/part=1").write.text(f"{path}/part=2", compression="gzip")
    return {"format": "text", "path": f"{path}/part=*", "maxFilesPerTrigger": "1000"}


# -- campaigns --------------------------------------------------------------


def _run_campaigns(spark, sf_dir):
    """Two checkpoints of one stream see everything; the first one's batch is retried after its clock moved on."""
    root = scratch(spark, "campaigns")
    source = _land(as_messages(view(spark, sf_dir, "v_campaigns")), f"{root}/in")
    feedback = campaigns.feedback_table(spark, f"{root}/feedback")
    push = {"format": "text", "path": f"{root}/push"}
    subscribers = lambda: view(spark, sf_dir, "v_subscribers")
    for run in ("a", "b"):
        campaigns.start_campaigns(
            spark, source, subscribers, feedback, push,
            checkpoint=f"{root}/checkpoint-{run}", now=lambda: F.lit(NOW),
        ).awaitTermination()
        if run == "a":
            compact(feedback, NOTIFICATION_KEY)
            late = campaigns.campaign_handler(
                lambda: subscribers().limit(0), feedback, push,
                Journal(spark, f"{root}/checkpoint-a", "campaigns"), lambda: F.lit(NOW + 10**6),
            )
            late(parse_messages(spark.read.text(f"{root}/in/part=1"), schemas.SCHEMAS["campaign_message"]), 0)
    return feedback, push


_NOTIFY = f"""
SELECT c.*, s.client_id, CAST({NOW} AS BIGINT) AS trigger_datetime_created
FROM {{v_campaigns}} c JOIN {{v_subscribers}} s ON s.restaurant_id = c.restaurant_id
WHERE {NOW} BETWEEN c.adv_campaign_datetime_start AND c.adv_campaign_datetime_end"""


@query("campaign_notifications", f"SELECT n.*, CAST(NULL AS VARCHAR) AS feedback FROM ({_NOTIFY}) n")
def campaign_notifications(spark, sf_dir):
    feedback, _ = _run_campaigns(spark, sf_dir)
    return feedback.read().drop(BATCH)


@query("campaign_push_messages", _NOTIFY)
def campaign_push_messages(spark, sf_dir):
    """What went to the push topic, parsed back."""
    _, push = _run_campaigns(spark, sf_dir)
    fields = [f for f in schemas.SCHEMAS["subscribers_feedback"].fields if f.name != "feedback"]
    body = F.from_json("value", T.StructType(fields))
    return spark.read.text(push["path"]).select(body.alias("m")).select("m.*")


# -- order vault ------------------------------------------------------------


def order_messages(spark, sf_dir):
    """One JSON message per order, as the order service emits them."""
    head = view(spark, sf_dir, "v_order_head")
    # An order's lines make one message, which the broker's size limit bounds.
    line = F.struct(
        F.col("product_id").alias("id"), F.col("product_name").alias("name"), "price",
        "quantity", F.col("category_name").alias("category"),
    )
    lines = view(spark, sf_dir, "v_order_line").groupBy("object_id").agg(
        F.array_sort(F.collect_list(line)).alias("products")
    )
    payload = F.struct(
        F.col("object_id").alias("id"),
        F.substring(F.col("order_dt").cast("string"), 1, 19).alias("date"),
        "cost",
        F.col("cost").alias("payment"),
        "status",
        F.struct(F.col("restaurant_id").alias("id"), F.col("restaurant_name").alias("name")).alias(
            "restaurant"
        ),
        F.struct(F.col("user_id").alias("id"), F.col("user_name").alias("name")).alias("user"),
        "products",
    )
    rows = head.join(lines, "object_id")
    return as_messages(
        rows.select("object_id", F.lit("order").alias("object_type"), payload.alias("payload"))
    )


def _run_vault(spark, sf_dir, names):
    root = scratch(spark, "orders")
    source = _land(order_messages(spark, sf_dir), f"{root}/in")
    tables = orders.vault_tables(spark, f"{root}/vault", names)
    enriched = {"format": "text", "path": f"{root}/enriched", "compression": "gzip"}
    orders.start_vault(
        spark, source, tables, enriched, checkpoint=f"{root}/checkpoint"
    ).awaitTermination()
    return root, tables


def _uuid(*parts: str) -> str:
    """SQL for the version-5 UUID of concatenated texts."""
    text = " || ".join(parts)
    h = f"sha1(unhex('6ba7b8149dad11d180b400c04fd430c8') || encode({text}))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


_CLOSED = f"""
head AS (SELECT h.*, {_uuid("CAST(object_id AS VARCHAR)")} AS o, {_uuid("user_id")} AS u,
    {_uuid("restaurant_id")} AS r FROM {{v_order_head}} h
  WHERE status = 'CLOSED' AND object_id IN (SELECT object_id FROM {{v_order_line}})),
line AS (SELECT l.*, h.o, h.u, h.r, {_uuid("product_id")} AS p, {_uuid("category_name")} AS c
  FROM {{v_order_line}} l JOIN head h ON h.object_id = l.object_id)"""


def _pick(table, rows):
    """Key and the rest of a vault table as text, under the table's name."""
    rest = [c for c in rows.columns if c not in ("load_dt", "load_src", BATCH)]
    return rows.select(
        F.lit(table).alias("vault_table"),
        F.col(rest[0]).alias("hash_key"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in rest[1:]]).alias("content"),
    )


def _union(tables):
    frames = [_pick(name, table.read()) for name, table in tables.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query(
    "order_vault_hubs",
    f"""WITH {_CLOSED}
SELECT DISTINCT 'h_user' AS vault_table, u AS hash_key, user_id AS content FROM head
UNION ALL SELECT DISTINCT 'h_restaurant', r, restaurant_id FROM head
UNION ALL SELECT 'h_order', o, CAST(object_id AS VARCHAR) || '|'
  || strftime(order_dt, '%Y-%m-%d %H:%M:%S') FROM head
UNION ALL SELECT DISTINCT 'h_product', p, product_id FROM line
UNION ALL SELECT DISTINCT 'h_category', c, category_name FROM line""",
)
def order_vault_hubs(spark, sf_dir):
    return _union(_run_vault(spark, sf_dir, HUBS)[1])


@query(
    "order_vault_links",
    f"""WITH {_CLOSED}
SELECT 'l_order_user' AS vault_table, {_uuid("o", "u")} AS hash_key, o || '|' || u AS content
  FROM head
UNION ALL SELECT DISTINCT 'l_order_product', {_uuid("o", "p")}, o || '|' || p FROM line
UNION ALL SELECT DISTINCT 'l_product_restaurant', {_uuid("p", "r")}, p || '|' || r FROM line
UNION ALL SELECT DISTINCT 'l_product_category', {_uuid("p", "c")}, p || '|' || c FROM line""",
)
def order_vault_links(spark, sf_dir):
    return _union(_run_vault(spark, sf_dir, LINKS)[1])


_COST = "CAST(CAST(cost AS DOUBLE) AS VARCHAR)"
_COST5 = "CAST(CAST(cost AS DECIMAL(19,5)) AS VARCHAR)"


@query(
    "order_vault_satellites",
    f"""WITH {_CLOSED}
SELECT DISTINCT 's_user_names' AS vault_table, {_uuid("u", "user_name", "user_name")} AS hash_key,
  u || '|' || user_name || '|' || user_name AS content FROM head
UNION ALL SELECT DISTINCT 's_restaurant_names', {_uuid("r", "restaurant_name")},
  r || '|' || restaurant_name FROM head
UNION ALL SELECT 's_order_cost', {_uuid("o", _COST, _COST)},
  o || '|' || {_COST5} || '|' || {_COST5} FROM head
UNION ALL SELECT 's_order_status', {_uuid("o", "status")}, o || '|' || status FROM head
UNION ALL SELECT DISTINCT 's_product_names', {_uuid("p", "product_name")},
  p || '|' || product_name FROM line""",
)
def order_vault_satellites(spark, sf_dir):
    return _union(_run_vault(spark, sf_dir, SATELLITES)[1])


@query(
    "order_enriched_messages",
    f"""WITH {_CLOSED}
SELECT object_id, u AS user_id, p AS product_id, product_name, c AS category_id, category_name
FROM line UNION ALL
SELECT object_id, u, p, product_name, c, category_name FROM line""",
)
def order_enriched_messages(spark, sf_dir):
    """Product lines of the re-emitted messages; the replayed half is emitted as well."""
    from martwright.plans.order_vault import counter_lines

    root, _ = _run_vault(spark, sf_dir, [])
    raw = spark.read.text(f"{root}/enriched")
    messages = parse_messages(raw, schemas.SCHEMAS["enriched_message"])
    return counter_lines(messages).select(
        "object_id", "user_id", "product_id", "product_name", "category_id", "category_name"
    )


@query("order_landing", "SELECT object_id, 'order' AS object_type, status FROM {v_order_head} "
       "WHERE object_id IN (SELECT object_id FROM {v_order_line})")
def order_landing(spark, sf_dir):
    """Raw orders landed once per id although every message comes twice."""
    root = scratch(spark, "landing")
    source = _land(order_messages(spark, sf_dir), f"{root}/in")
    landing = orders.landing_table(spark, f"{root}/landed")
    orders.start_landing(spark, source, landing, f"{root}/checkpoint").awaitTermination()
    return landing.read().select(
        "object_id", "object_type", F.get_json_object("payload", "$.status").alias("status")
    )


@query("order_landing_polled", "SELECT object_id, 'order' AS object_type, status FROM {v_order_head} "
       "WHERE object_id IN (SELECT object_id FROM {v_order_line})")
def order_landing_polled(spark, sf_dir):
    """The same, polled four files at a time, stopped after the first batch and continued from the checkpoint."""
    root = scratch(spark, "polled")
    source = {**_land(order_messages(spark, sf_dir), f"{root}/in"), "maxFilesPerTrigger": "4"}
    landing = orders.landing_table(spark, f"{root}/landed")
    polled = orders.start_landing(
        spark, source, landing, f"{root}/checkpoint", trigger={"processingTime": "1 second"}
    )
    poll(polled, lambda: finished_batches(polled) >= 1, pause=0.2)
    orders.start_landing(spark, source, landing, f"{root}/checkpoint").awaitTermination()
    return landing.read().select(
        "object_id", "object_type", F.get_json_object("payload", "$.status").alias("status")
    )


# -- counters ---------------------------------------------------------------


def _run_counters(spark, sf_dir, subject, semantics):
    root, _ = _run_vault(spark, sf_dir, [])
    tables = orders.counter_tables(spark, f"{root}/cdm")
    source = {"format": "text", "path": f"{root}/enriched/*"}
    for run in ("a", "b"):
        orders.start_counters(
            spark, source, tables, f"{root}/counters-{run}", stream=run, semantics=semantics
        ).awaitTermination()
    return orders.read_counters(tables, subject)


def _counter_sql(subject, key, name, counted):
    return f"""WITH {_CLOSED}
SELECT u AS user_id, {key} AS {subject}_id, max_by({name}, object_id) AS {name},
  {counted} AS order_cnt FROM line GROUP BY u, {key}"""


@query("user_product_counters", _counter_sql("product", "p", "product_name", "COUNT(*)"))
def user_product_counters(spark, sf_dir):
    return _run_counters(spark, sf_dir, "product", "reference")


@query("user_category_counters", _counter_sql("category", "c", "category_name", "COUNT(*)"))
def user_category_counters(spark, sf_dir):
    return _run_counters(spark, sf_dir, "category", "reference")


@query(
    "user_category_counters_corrected",
    _counter_sql("category", "c", "category_name", "COUNT(DISTINCT object_id)"),
)
def user_category_counters_corrected(spark, sf_dir):
    return _run_counters(spark, sf_dir, "category", "corrected")
