"""Bulk loads, exports and the remaining load operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.catalog.registry import query
from martwright.catalog.views import table, view
from martwright.functions import decimal_comma, hash_key, parse_timestamp, uuid5
from martwright.operators.pick import sql_not_in
from martwright.operators.surrogate import with_surrogate
from martwright.operators.tables import Table
from martwright.operators.workspace import scratch
from martwright.sources.readers import read_delimited
from martwright.sources.writers import preview, write_delimited

_ORDER_CSV = "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING, o_orderdate TIMESTAMP_NTZ"


def _bulk(spark, sf_dir):
    """Orders as comma separated files; urgent ones have a key that is no number."""
    lines = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("x"))
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias("o_orderkey"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_custkey")).alias("o_custkey"),
        "o_orderpriority",
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
    )
    path = scratch(spark, "bulk")
    lines.write.option("header", True).csv(path)
    return read_delimited(spark, path, T.StructType.fromDDL(_ORDER_CSV))


@query(
    "csv_bulk_load",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_custkey END AS o_custkey,
  o_orderpriority, o_orderdate FROM {orders} WHERE o_orderpriority <> '1-URGENT'""",
)
def csv_bulk_load(spark, sf_dir):
    return _bulk(spark, sf_dir)[0]


@query(
    "csv_rejects",
    """SELECT 'x,' || CAST(o_custkey AS VARCHAR) || ',1-URGENT,'
  || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS rejected
FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
)
def csv_rejects(spark, sf_dir):
    return _bulk(spark, sf_dir)[1]


@query(
    "csv_roundtrip_null_marker",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
  CASE WHEN event_type <> 'click' THEN event_type END AS event_type FROM {events}""",
)
def csv_roundtrip_null_marker(spark, sf_dir):
    """Export with the NULL marker, read back with it."""
    path = scratch(spark, "export")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type"),
    )
    write_delimited(rows, path)
    good, _ = read_delimited(
        spark, path, rows.schema, sep="|", header=False, null_value="\\N", reject_max=0
    )
    return good


@query("csv_decimal_comma", "SELECT c_custkey, c_name, c_acctbal FROM {customer}")
def csv_decimal_comma(spark, sf_dir):
    """Semicolon separated text with decimal commas, as the city list is written."""
    path = scratch(spark, "comma")
    table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.regexp_replace(F.col("c_acctbal").cast("string"), r"\.", ",").alias("c_acctbal"),
    ).write.option("sep", ";").option("header", True).csv(path)
    raw = spark.read.option("sep", ";").option("header", True).csv(path)
    return raw.select(
        F.col("c_custkey").cast("bigint"), "c_name",
        decimal_comma(F.col("c_acctbal")).alias("c_acctbal"),
    )


@query("landed_file_preview")
def landed_file_preview(spark, sf_dir):
    """First ten rows; which ones is up to the file, so there is no SQL counterpart."""
    return preview(table(spark, sf_dir, "events"))


@query(
    "surrogate_keys",
    """SELECT c_custkey, c_name,
  100 + ROW_NUMBER() OVER (ORDER BY sha1(CAST(c_custkey AS VARCHAR))) AS id FROM {customer}""",
)
def surrogate_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return with_surrogate(rows, "id", ["c_custkey"], start=100)


@query(
    "accumulating_upsert",
    """SELECT o_custkey, COUNT(*) AS order_cnt, MAX(o_orderdate) AS last_order FROM {orders}
GROUP BY o_custkey""",
)
def accumulating_upsert(spark, sf_dir):
    """Counts of two increments added up, the newest date kept."""
    counters = Table(
        spark, scratch(spark, "counters"),
        "o_custkey BIGINT, order_cnt BIGINT, last_order TIMESTAMP_NTZ",
    )
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    update = {
        "order_cnt": F.col("t.order_cnt") + F.col("s.order_cnt"),
        "last_order": F.greatest("t.last_order", "s.last_order"),
    }
    for part in (orders.where(early), orders.where(~early)):
        increment = part.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("order_cnt"), F.max("o_orderdate").alias("last_order")
        )
        counters.upsert(increment, ["o_custkey"], update=update)
    return counters.read()


@query(
    "insert_or_ignore",
    """WITH r AS (SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey
  ORDER BY o_orderkey) AS n FROM {orders})
SELECT o_custkey, o_orderkey FROM r WHERE n = 1""",
)
def insert_or_ignore(spark, sf_dir):
    """First order of each customer, inserted twice."""
    firsts = Table(spark, scratch(spark, "firsts"), "o_custkey BIGINT, o_orderkey BIGINT")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    firsts.insert_if_new(rows, ["o_custkey"])
    firsts.insert_if_new(rows.withColumn("o_orderkey", F.lit(-1)), ["o_custkey"])
    return firsts.read()


@query(
    "not_in_absent",
    """SELECT c_custkey, c_name FROM {customer} WHERE c_custkey NOT IN (
  SELECT o_custkey FROM {orders} WHERE o_orderpriority = '1-URGENT')""",
)
def not_in_absent(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return sql_not_in(customers, "c_custkey", urgent, "o_custkey")


@query(
    "not_in_with_null",
    """SELECT c_custkey, c_name FROM {customer} WHERE c_custkey NOT IN (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END FROM {orders})""",
)
def not_in_with_null(spark, sf_dir):
    """A NULL on the right side leaves nothing over."""
    urgent = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("o_custkey")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return sql_not_in(customers, "c_custkey", urgent, "o_custkey")


@query(
    "scalar_functions",
    """SELECT o_orderkey, CAST(EXTRACT(YEAR FROM o_orderdate) * 100
    + CEIL(EXTRACT(DOY FROM o_orderdate) / 7.0) AS INT) AS year_week,
  strftime(o_orderdate, '%Y-%m') AS year_month,
  o_orderdate + INTERVAL 250 MILLISECOND AS parsed,
  (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Adelaide' AS local_time,
  TRUE AS key_is_stable FROM {orders}""",
)
def scalar_functions(spark, sf_dir):
    """Week, month, timestamp parsing, local time and keys over all orders."""
    from martwright.functions import local_time, year_month, year_week

    when = F.col("o_orderdate")
    text = F.concat(F.substring(when.cast("string"), 1, 19), F.lit(".250"))
    key = hash_key(F.col("o_orderkey"), F.col("o_custkey"))
    uuid = uuid5(F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        year_week(when.cast("date")).alias("year_week"),
        year_month(when.cast("date")).alias("year_month"),
        parse_timestamp(text).alias("parsed"),
        local_time(when, F.lit("Australia/Adelaide")).alias("local_time"),
        (key.isNotNull() & (F.length(uuid) == 36)).alias("key_is_stable"),
    )


@query(
    "city_distances",
    """SELECT e.event_id, ROUND(2 * 6371 * asin(sqrt(
    pow(sin(radians(c.city_lat - e.lat) / 2), 2) + cos(radians(e.lat)) * cos(radians(c.city_lat))
    * pow(sin(radians(c.city_lng - e.lon) / 2), 2))), 3) AS km
FROM {v_social} e JOIN {v_cities} c ON c.city = 'Sydney'
WHERE e.lat IS NOT NULL AND e.lon IS NOT NULL""",
)
def city_distances(spark, sf_dir):
    """Distance of every located event from one fixed point."""
    from martwright.functions import haversine

    sydney = F.lit(-33.865), F.lit(151.2094)
    events = view(spark, sf_dir, "v_social").where("lat IS NOT NULL AND lon IS NOT NULL")
    return events.select(
        "event_id", F.round(haversine(F.col("lat"), F.col("lon"), *sydney), 3).alias("km")
    )
