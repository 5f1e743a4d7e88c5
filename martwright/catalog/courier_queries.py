"""Courier settlement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright import schemas
from martwright.catalog.registry import query, rounded_ratio
from martwright.catalog.views import view
from martwright.operators.quality import check_constraints
from martwright.operators.tables import Table
from martwright.operators.workspace import cut_lineage, scratch
from martwright.plans import couriers as plan


def _star(spark, sf_dir):
    rows = view(spark, sf_dir, "v_deliveries")
    facts = rows.select("courier_id", "delivery_id", "rate", "delivery_sum", "tip_sum")
    deliveries = rows.select(
        F.col("delivery_id").alias("id"), "delivery_ts", F.col("delivery_id").alias("order_id")
    )
    people = view(spark, sf_dir, "v_deliveries").select(
        F.col("courier_id").alias("id"), F.col("courier_name").alias("name")
    )
    return facts, deliveries, people.distinct()


_TIER = """CASE WHEN SUM(rate) < 4 * COUNT(rate) THEN {0}
  WHEN SUM(rate) * 10 < 45 * COUNT(rate) THEN {1}
  WHEN SUM(rate) * 10 < 49 * COUNT(rate) THEN {2} ELSE {3} END"""

_MONTHS = f"""
  SELECT courier_id, courier_name,
    CAST(EXTRACT(YEAR FROM delivery_ts) AS INT) AS settlement_year,
    CAST(EXTRACT(MONTH FROM delivery_ts) AS INT) AS settlement_month,
    COUNT(*) AS orders_count,
    CAST(SUM(delivery_sum) AS DECIMAL(18,2)) AS orders_total_sum,
    {rounded_ratio("SUM(rate)", "COUNT(rate)")} AS rate_avg,
    CAST(SUM(tip_sum) AS DECIMAL(18,2)) AS courier_tips_sum,
    {_TIER.format(5, 7, 8, 10)} AS percent_rate,
    {_TIER.format(100, 150, 175, 200)} AS min_payment,
    {_TIER.format(*[
        f"SUM(GREATEST(delivery_sum * {p}, {m}))"
        for p, m in (("0.05", 100), ("0.07", 150), ("0.08", 175), ("0.10", 200))
    ])} AS paid_with_minimum
  FROM {{v_deliveries}} GROUP BY courier_id, courier_name,
    EXTRACT(YEAR FROM delivery_ts), EXTRACT(MONTH FROM delivery_ts)"""

_REPORT = """
WITH m AS ({months}), e AS (SELECT *, {earned} AS earned FROM m)
SELECT courier_id, courier_name, settlement_year, settlement_month, orders_count,
  orders_total_sum, rate_avg,
  CAST(orders_total_sum * 0.25 AS DECIMAL(18,2)) AS order_processing_fee,
  CAST(earned AS DECIMAL(18,2)) AS courier_order_sum, courier_tips_sum,
  CAST((earned + courier_tips_sum) * 0.95 AS DECIMAL(18,2)) AS courier_reward_sum
FROM e"""

_PLAIN = _REPORT.format(
    months=_MONTHS, earned="orders_total_sum * CAST(percent_rate * 0.01 AS DECIMAL(3,2))"
)
_LEAST = _REPORT.format(months=_MONTHS, earned="CAST(paid_with_minimum AS DECIMAL(22,4))")


@query("courier_report", _PLAIN)
def courier_report(spark, sf_dir):
    return plan.courier_report(*_star(spark, sf_dir))


@query("courier_report_min_payment", _LEAST)
def courier_report_min_payment(spark, sf_dir):
    return plan.courier_report(*_star(spark, sf_dir), min_payment=True)


# The tier table after a raise: the lowest tier is split, two others pay more.
_TIER_ROWS = """(VALUES (-1.0, 3.5, 0.05, 100), (3.5, 4.0, 0.06, 120), (4.0, 4.5, 0.09, 165),
  (4.5, 4.9, 0.08, 175), (4.9, 10.0, 0.12, 230)) t(low, above, share, least)"""

_TIERED = _REPORT.format(
    months=f"""SELECT b.*, paid FROM ({_MONTHS}) b JOIN (
    SELECT courier_id, EXTRACT(YEAR FROM delivery_ts) AS y, EXTRACT(MONTH FROM delivery_ts) AS m,
      SUM(GREATEST(delivery_sum * CAST(share AS DECIMAL(3,2)), least)) AS paid
    FROM {{v_deliveries}}, {_TIER_ROWS} GROUP BY courier_id, y, m, low, above
    HAVING SUM(rate) >= low * COUNT(rate) AND SUM(rate) < above * COUNT(rate)) p
  ON p.courier_id = b.courier_id AND y = settlement_year AND p.m = settlement_month""",
    earned="CAST(paid AS DECIMAL(22,4))",
)


@query("courier_report_tier_table", _TIERED)
def courier_report_tier_table(spark, sf_dir):
    """Least payments by the stored tier table, after its rows have been changed by upserts."""
    tiers = Table(
        spark, scratch(spark, "courier_rating"), schemas.SCHEMAS["dm_courier_rating"]
    )
    tiers.refresh(plan.rating_tiers(spark))
    raised = spark.sql(
        """SELECT * FROM VALUES (0.00, 3.49, 5, 100), (3.50, 3.99, 6, 120), (4.00, 4.49, 9, 165),
        (4.90, 5.00, 12, 230) AS t(min_rating, max_rating, percent_rate, min_payment)"""
    )
    tiers.upsert(raised, ["min_rating"])
    return plan.courier_report(*_star(spark, sf_dir), min_payment=True, tiers=tiers.read())


@query(
    "courier_report_refresh",
    "SELECT courier_id, settlement_year, settlement_month, orders_count, orders_total_sum "
    f"FROM ({_MONTHS}) m",
)
def courier_report_refresh(spark, sf_dir):
    """Full refresh, run twice; the second run replaces the first."""
    mart = Table(spark, scratch(spark, "courier_report"), schemas.SCHEMAS["dm_courier_report"])
    report = plan.courier_report(*_star(spark, sf_dir))
    mart.refresh(report)
    mart.refresh(report)
    return mart.read().select(
        "courier_id", "settlement_year", "settlement_month", "orders_count", "orders_total_sum"
    )


@query(
    "constraint_report",
    f"""
WITH r AS ({_PLAIN}),
rules(rule, violations) AS (
  {" UNION ALL ".join(
      f"SELECT '{c}_not_null', COUNT(*) FROM r WHERE {c} IS NULL"
      for c in schemas.column_names("dm_courier_report")
  )}
  UNION ALL SELECT 'settlement_month_check', COUNT(*) FROM r
    WHERE settlement_month NOT BETWEEN 1 AND 12
  UNION ALL SELECT 'settlement_year_check', COUNT(*) FROM r
    WHERE settlement_year NOT BETWEEN 2020 AND 2100
  UNION ALL SELECT 'rate_avg_check', COUNT(*) FROM r WHERE rate_avg NOT BETWEEN 1 AND 5
  {" ".join(
      f"UNION ALL SELECT '{c}_check', COUNT(*) FROM r WHERE {c} < 0"
      for c in (
          "orders_count", "orders_total_sum", "order_processing_fee", "courier_order_sum",
          "courier_tips_sum", "courier_reward_sum",
      )
  )}
  UNION ALL SELECT 'courier_month_unique', COUNT(*) FROM (SELECT 1 FROM r
    GROUP BY courier_id, settlement_year, settlement_month HAVING COUNT(*) > 1) d
)
SELECT rule, 'FAIL' AS severity, violations FROM rules""",
)
def constraint_report(spark, sf_dir):
    return check_constraints(plan.courier_report(*_star(spark, sf_dir)), plan.report_rules())


# -- load from documents ----------------------------------------------------


def _documents(spark, sf_dir):
    """Courier and delivery documents as the source would hand them over."""
    rows = view(spark, sf_dir, "v_deliveries")
    people = rows.select(
        F.col("courier_id").cast("string").alias("_id"), F.col("courier_name").alias("name")
    ).distinct()
    deliveries = rows.select(
        F.col("delivery_id").cast("string").alias("delivery_id"),
        F.concat(F.lit("o"), F.col("delivery_id").cast("string")).alias("order_id"),
        F.col("delivery_ts").cast("string").alias("order_ts"),
        F.col("courier_id").cast("string").alias("courier_id"),
        "address",
        F.col("delivery_ts").cast("string").alias("delivery_ts"),
        "rate",
        "tip_sum",
    )
    return (
        cut_lineage(plan.stage_documents(people, "_id")),
        cut_lineage(plan.stage_documents(deliveries, "delivery_id")),
    )


@query(
    "document_staging",
    """
SELECT CAST(delivery_id AS VARCHAR) AS object_id, address, CAST(rate AS VARCHAR) AS rate
FROM {v_deliveries}""",
)
def document_staging(spark, sf_dir):
    """Documents staged twice by id; the last write of an id wins."""
    _, deliveries = _documents(spark, sf_dir)
    path = scratch(spark, "stg_deliveries")
    staged = Table(spark, path, schemas.SCHEMAS["deliverysystem_deliveries"])
    stale = deliveries.withColumn("object_value", F.lit('{"address": "old"}'))
    staged.upsert(stale, ["object_id"])
    staged.upsert(deliveries, ["object_id"])
    return staged.read().select(
        "object_id",
        F.get_json_object("object_value", "$.address").alias("address"),
        F.get_json_object("object_value", "$.rate").alias("rate"),
    )


@query(
    "courier_dds_json",
    """
SELECT CAST(d.delivery_id AS VARCHAR) AS delivery_key, CAST(d.courier_id AS VARCHAR) AS courier_key,
  d.courier_name, d.address AS delivery_address, d.delivery_ts, CAST(d.rate AS INT) AS rate,
  d.delivery_sum, d.tip_sum
FROM {v_deliveries} d""",
)
def courier_dds_json(spark, sf_dir):
    """Documents to dimensions and facts, the whole load run twice."""
    people_docs, delivery_docs = _documents(spark, sf_dir)
    root = scratch(spark, "courier_dds")
    tables = {
        name: Table(spark, f"{root}/{name}", schemas.SCHEMAS[name])
        for name in (
            "dm_couriers", "dm_delivery_addresses", "dm_deliveries", "fct_courier_deliveries",
        )
    }
    # Made once: both loads read the same orders.
    orders = cut_lineage(
        view(spark, sf_dir, "v_deliveries").select(
            F.col("delivery_id").alias("id"),
            F.concat(F.lit("o"), F.col("delivery_id").cast("string")).alias("order_key"),
        )
    )
    sales = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_sum"),
    )
    for _ in range(2):
        # Addresses, deliveries and facts read the parsed documents.
        parsed = cut_lineage(plan.parsed_deliveries(delivery_docs))
        plan.load_couriers(people_docs, tables["dm_couriers"])
        plan.load_addresses(parsed, tables["dm_delivery_addresses"])
        plan.load_deliveries(
            parsed,
            orders,
            tables["dm_delivery_addresses"].read(),
            tables["dm_couriers"].read(),
            tables["dm_deliveries"],
        )
        facts = plan.courier_facts(parsed, tables["dm_deliveries"].read(), sales)
        plan.load_facts(facts, tables["fct_courier_deliveries"])
    deliveries = tables["dm_deliveries"].read().select(
        F.col("id").alias("delivery_id"),
        F.col("delivery_id").alias("delivery_key"),
        "delivery_ts",
        "address_id",
    )
    people = tables["dm_couriers"].read().select(
        F.col("id").alias("courier_id"),
        F.col("object_id").alias("courier_key"),
        F.col("name").alias("courier_name"),
    )
    addresses = tables["dm_delivery_addresses"].read().withColumnRenamed("id", "address_id")
    return (
        tables["fct_courier_deliveries"]
        .read()
        .join(deliveries, "delivery_id")
        .join(people, "courier_id")
        .join(addresses, "address_id")
        .select(
            "delivery_key", "courier_key", "courier_name", "delivery_address", "delivery_ts",
            "rate", "delivery_sum", "tip_sum",
        )
    )
