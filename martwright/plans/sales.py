"""Sales star from order-log increments, and the weekly retention mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright import schemas
from martwright.functions import year_week
from martwright.operators.tables import Table


def calendar(spark, first: str, last: str) -> DataFrame:
    """Calendar dimension: ``date_id`` as yyyyMMdd and the date."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(
            "date_actual"
        )
    )
    return days.select(
        F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_id"), "date_actual"
    )


def load_dimensions(staged: DataFrame, d_city: Table, d_customer: Table, d_item: Table) -> None:
    """Insert members that the dimensions do not have yet."""
    d_city.insert_if_new(staged.select("city_id", "city_name").distinct(), ["city_id"])
    customers = staged.groupBy("customer_id", "first_name", "last_name").agg(
        F.max("city_id").alias("city_id")
    )
    d_customer.insert_if_new(customers, ["customer_id"])
    d_item.insert_if_new(staged.select("item_id", "item_name").distinct(), ["item_id"])


def sales_rows(staged: DataFrame, d_calendar: DataFrame) -> DataFrame:
    """Fact rows with refunds as negative amounts; a day that the calendar lacks has no ``date_id``."""
    amount = F.when(F.col("status") == "refunded", -F.col("payment_amount")).otherwise(
        F.col("payment_amount")
    )
    day = d_calendar.select("date_id", F.col("date_actual").alias("_day"))
    dated = staged.withColumn("_day", F.col("date_time").cast("date")).join(day, "_day", "left")
    return schemas.conform(dated.withColumn("payment_amount", amount), "f_sales")


def covering(d_calendar: DataFrame, staged: DataFrame) -> DataFrame:
    """``date_id`` and ``date_actual`` of the calendar and of the staged days that it lacks.

    Without an id of its own an unknown day would share the NULL slice with all others, and loading
    one of them would delete the rest. Ids are the day's digits, as in the calendar.
    """
    known = d_calendar.select("date_id", "date_actual")
    days = staged.select(F.col("date_time").cast("date").alias("date_actual")).distinct().dropna()
    missing = days.join(known, "date_actual", "left_anti")
    digits = F.date_format("date_actual", "yyyyMMdd").cast(known.schema["date_id"].dataType)
    return known.unionByName(missing.select(digits.alias("date_id"), "date_actual"))


def load_sales(staged: DataFrame, d_calendar: DataFrame, f_sales: Table, day: str | None = None):
    """Overwrite the staged days (or just ``day``) of the fact; re-running changes nothing.

    A ``day`` that has no rows any more is emptied.
    """
    rows = staged if day is None else staged.where(F.col("date_time").cast("date") == day)
    if day is not None and rows.isEmpty():
        f_sales.clear_slice(date_id=int(str(day).replace("-", "")))
        return
    f_sales.overwrite_slices(sales_rows(rows, covering(d_calendar, rows)))


def migrate_add_status(old: DataFrame, target: Table) -> None:
    """Copy a fact without status into the layout that has one, as ``shipped``."""
    target.refresh(schemas.conform(old.drop("status"), "f_sales"))


def customer_retention(sales: DataFrame, semantics: str = "corrected") -> DataFrame:
    """New, returning and refunding customers per week and item.

    ``sales`` has ``date_actual``, ``item_id``, ``customer_id``,
    ``payment_amount`` and ``status``. A customer with one order in the week is
    new, with more is returning.

    ``reference`` counts each measure once per order of the customer (revenue
    and refunds are multiplied by the order count, and
    ``refunded_customer_count`` is the number of orders). Since that factor is
    the order count itself, the fact never has to be joined to its own
    aggregate: both variants are two aggregations.
    """
    per_customer = sales.groupBy(
        year_week(F.col("date_actual")).alias("period_id"), "item_id", "customer_id"
    ).agg(
        F.count(F.lit(1)).alias("_orders"),
        F.sum((F.col("status") == "refunded").cast("int")).alias("_refunds"),
        F.sum("payment_amount").alias("_revenue"),
    )
    known = F.col("customer_id").isNotNull() & F.col("item_id").isNotNull()
    new, back = F.col("_orders") <= 1, F.col("_orders") > 1
    if semantics == "reference":
        weight = F.col("_orders")
        refunded = F.sum(F.col("_orders"))
    else:
        weight = F.lit(1)
        refunded = F.sum((F.col("_refunds") > 0).cast("int"))
    revenue = F.col("_revenue").cast("decimal(18,2)") * weight.cast("decimal(18,0)")
    mart = (
        per_customer.where(known)
        .groupBy("period_id", "item_id")
        .agg(
            F.sum(new.cast("int")).alias("new_customers_count"),
            F.sum(back.cast("int")).alias("returning_customers_count"),
            refunded.alias("refunded_customer_count"),
            F.sum(F.when(new, revenue)).alias("new_customers_revenue"),
            F.sum(F.when(back, revenue)).alias("returning_customers_revenue"),
            F.sum(F.col("_refunds") * weight).alias("customers_refunded"),
        )
    )
    return schemas.conform(mart, "f_customer_retention")
