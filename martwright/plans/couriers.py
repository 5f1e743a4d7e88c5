"""Courier settlement: staged JSON documents to facts, and the monthly report."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright import schemas
from martwright.functions import parse_timestamp, ratio
from martwright.operators.pick import latest_by
from martwright.operators.tables import Table

# Fixed values: (lowest rating, highest rating, percent of the order, least payment).
RATING_TIERS = (
    ("0.00", "3.99", 5, 100),
    ("4.00", "4.49", 7, 150),
    ("4.50", "4.89", 8, 175),
    ("4.90", "5.00", 10, 200),
)
PROCESSING_FEE = "0.25"
REWARD_SHARE = "0.95"

_DELIVERY_JSON = (
    "delivery_id STRING, order_id STRING, order_ts STRING, courier_id STRING, address STRING, "
    "delivery_ts STRING, rate STRING, tip_sum STRING"
)


def rating_tiers(spark) -> DataFrame:
    rows = [(Decimal(a), Decimal(b), p, m) for a, b, p, m in RATING_TIERS]
    return spark.createDataFrame(rows, schemas.SCHEMAS["dm_courier_rating"])


def tiers_in_order(tiers: DataFrame | None = None) -> list[tuple[Decimal, Decimal, int, int]]:
    """Rows of a tier table from the lowest rating upwards; the fixed ones if none is given.

    Ratings have three digits and tiers may not overlap, so there are at most a thousand of them:
    few enough to be part of a plan. A table with a NULL, with a tier that ends before it begins or
    with two that overlap is refused, as one without rows is.
    """
    if tiers is None:
        return [(Decimal(low), Decimal(high), share, least) for low, high, share, least in RATING_TIERS]
    names = schemas.SCHEMAS["dm_courier_rating"].names
    known = schemas.conform(tiers, "dm_courier_rating").select(*names)
    rows = [tuple(row) for row in known.orderBy("min_rating", "max_rating").limit(1001).collect()]
    if not rows or any(None in row for row in rows):
        raise ValueError("a tier table has rows, and no NULL in them")
    for (low, high, *_), following in zip(rows, [*rows[1:], None]):
        if high < low or (following and following[0] <= high):
            raise ValueError(f"tier {low} to {high} is empty or overlaps the next one")
    return rows


def stage_documents(rows: DataFrame, id_col: str) -> DataFrame:
    """Natural id and the whole row as a JSON document."""
    return rows.select(
        F.col(id_col).cast("string").alias("object_id"),
        F.to_json(F.struct("*")).alias("object_value"),
    )


# -- warehouse load ---------------------------------------------------------


def load_couriers(documents: DataFrame, couriers: Table) -> None:
    named = documents.select(
        "object_id", F.get_json_object("object_value", "$.name").alias("name")
    )
    named = latest_by(named, ["object_id"], ["name"])
    couriers.upsert(named, ["object_id"], unique=True, id_col="id")


def parsed_deliveries(documents: DataFrame) -> DataFrame:
    """Delivery documents as columns; the JSON is parsed once."""
    body = F.from_json("object_value", _DELIVERY_JSON)
    return documents.withColumn("d", body).select("object_id", "d.*")


def load_addresses(deliveries: DataFrame, addresses: Table) -> None:
    seen = deliveries.select(F.col("address").alias("delivery_address"))
    addresses.insert_if_new(
        seen.where("delivery_address IS NOT NULL"), ["delivery_address"], id_col="id"
    )


def load_deliveries(
    deliveries: DataFrame,
    orders: DataFrame,
    addresses: DataFrame,
    couriers: DataFrame,
    target: Table,
) -> None:
    """``orders`` has ``id`` and ``order_key``; unmatched documents are left out."""
    rows = (
        deliveries.withColumnRenamed("order_id", "order_key")
        .withColumnRenamed("courier_id", "courier_key")
        .withColumnRenamed("address", "delivery_address")
        .join(orders.select(F.col("id").alias("order_id"), "order_key"), "order_key")
        .join(
            addresses.select(F.col("id").alias("address_id"), "delivery_address"),
            "delivery_address",
        )
        .join(
            couriers.select(F.col("id").alias("courier_id"), F.col("object_id").alias("courier_key")),
            "courier_key",
        )
        .select(
            F.col("object_id").alias("delivery_id"),
            parse_timestamp(F.col("delivery_ts")).alias("delivery_ts"),
            "order_id",
            parse_timestamp(F.col("order_ts")).alias("order_ts"),
            "address_id",
            "courier_id",
        )
    )
    rows = latest_by(rows, ["delivery_id"], ["delivery_ts", "order_ts", "order_id"])
    target.upsert(rows, ["delivery_id"], unique=True, id_col="id")


def courier_facts(
    deliveries: DataFrame, dm_deliveries: DataFrame, product_sales: DataFrame
) -> DataFrame:
    """One row per delivery; order totals are summed before the join."""
    totals = product_sales.groupBy("order_id").agg(F.sum("total_sum").alias("delivery_sum"))
    told = deliveries.select(
        "delivery_id",
        F.col("rate").try_cast("int").alias("rate"),
        F.col("tip_sum").try_cast("decimal(14,2)").alias("tip_sum"),
    )
    return (
        dm_deliveries.select("delivery_id", "courier_id", "id", "order_id")
        .join(told, "delivery_id")
        .join(totals, "order_id")
        .select("courier_id", F.col("id").alias("delivery_id"), "rate", "delivery_sum", "tip_sum")
    )


def load_facts(facts: DataFrame, target: Table) -> None:
    target.upsert(facts, ["delivery_id"])


# -- report -----------------------------------------------------------------


def _by_tier(
    rate_sum: Column, rate_count: Column, tiers: Sequence[tuple], values: list[Column]
) -> Column:
    """Value of the tier that the mean rating falls in, compared without division.

    A mean between two tiers belongs to the lower one, one below all of them to the lowest.
    """
    bounds = [low for low, *_ in tiers[1:]]
    chosen = values[-1]
    for bound, value in reversed(list(zip(bounds, values))):
        chosen = F.when(rate_sum < rate_count * F.lit(bound), value).otherwise(chosen)
    return F.when(rate_count > 0, chosen).otherwise(values[-1])


def courier_report(
    facts: DataFrame,
    deliveries: DataFrame,
    couriers: DataFrame,
    min_payment: bool = False,
    tiers: DataFrame | None = None,
) -> DataFrame:
    """Monthly settlement per courier.

    With ``min_payment`` every order pays at least the least payment of the
    courier's tier. The tier is known only after the month is summed up, so
    each tier's pay is summed on the way and the right one is picked at the
    end: still a single aggregation. Courier names are joined to the totals,
    not to the deliveries. ``tiers`` are the rows of ``dm_courier_rating`` as they are now.
    """
    dated = facts.join(
        deliveries.select(F.col("id").alias("delivery_id"), "delivery_ts", "order_id"),
        "delivery_id",
    )
    steps = tiers_in_order(tiers)
    shares = [F.lit(Decimal(share).scaleb(-2)).cast("decimal(3,2)") for _, _, share, _ in steps]
    least = [F.lit(least) for *_, least in steps]
    amount = F.col("delivery_sum").cast("decimal(18,2)")
    pay = [
        F.sum(F.greatest(amount * shares[i], least[i])).alias(f"_pay{i}")
        for i in range(len(steps))
    ]
    month = dated.groupBy(
        "courier_id",
        F.year("delivery_ts").alias("settlement_year"),
        F.month("delivery_ts").alias("settlement_month"),
    ).agg(
        F.count("order_id").alias("orders_count"),
        F.sum(amount).cast("decimal(18,2)").alias("orders_total_sum"),
        F.sum("rate").alias("_rate_sum"),
        F.count("rate").alias("_rate_count"),
        F.sum(F.col("tip_sum").cast("decimal(14,2)"))
        .cast("decimal(18,2)")
        .alias("courier_tips_sum"),
        *(pay if min_payment else []),
    )
    rates = F.col("_rate_sum"), F.col("_rate_count")
    if min_payment:
        earned = _by_tier(
            *rates, steps, [F.col(f"_pay{i}").cast("decimal(22,4)") for i in range(len(steps))]
        )
    else:
        earned = F.col("orders_total_sum") * _by_tier(*rates, steps, shares)
    total, tips = F.col("orders_total_sum"), F.col("courier_tips_sum")
    report = (
        month.join(
            couriers.select(F.col("id").alias("courier_id"), F.col("name").alias("courier_name")),
            "courier_id",
        )
        .withColumn("courier_order_sum", earned)
        .withColumns(
            {
                "rate_avg": ratio(*rates),
                "order_processing_fee": total * F.lit(Decimal(PROCESSING_FEE)),
                "courier_reward_sum": (F.col("courier_order_sum") + tips)
                * F.lit(Decimal(REWARD_SHARE)),
            }
        )
    )
    return schemas.conform(report, "dm_courier_report")


def report_rules() -> list:
    """Constraints of the settlement table."""
    from martwright.operators.quality import Rule, in_range, not_null

    sums = [
        "orders_count",
        "orders_total_sum",
        "order_processing_fee",
        "courier_order_sum",
        "courier_tips_sum",
        "courier_reward_sum",
    ]
    return [
        *not_null(*schemas.SCHEMAS["dm_courier_report"].names),
        in_range("settlement_month", 1, 12),
        in_range("settlement_year", 2020, 2100),
        in_range("rate_avg", 1, 5),
        *[in_range(c, 0) for c in sums],
        Rule("courier_month_unique", unique=("courier_id", "settlement_year", "settlement_month")),
    ]
