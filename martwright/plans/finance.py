"""Daily turnover per currency, and the dashboard series over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright import schemas
from martwright.functions import ratio
from martwright.operators.tables import Table

# Fixed value: the currency all totals are expressed in.
BASE_CURRENCY = 420


def day_of(rows: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of one day; Spark turns the cast into a range on the scan."""
    return rows.where(F.col(column).cast("date") == F.lit(day).cast("date"))


def stage_days(rows: DataFrame, column: str, staging: Table, day: str | None = None) -> None:
    """Land extracted rows by day of ``column``, all days or just ``day``.

    ``staging`` is partitioned by ``load_date``. A day that is extracted again
    replaces itself instead of doubling the base of the metrics.
    """
    extract = rows if day is None else day_of(rows, column, day)
    staging.overwrite_slices(extract.withColumn("load_date", F.col(column).cast("date")))


def global_metrics(
    transactions: DataFrame, currencies: DataFrame, load_date: str | None = None
) -> DataFrame:
    """Total in the base currency, count, mean per account and accounts, by day and currency.

    Only finished transactions of real accounts (number not negative) count. A
    currency without a rate on the day keeps a NULL total. The sums are split
    by account first, so that the distinct count and a hot currency cost no
    extra pass; rates are joined to the daily totals.
    """
    if load_date is not None:
        transactions = day_of(transactions, "transaction_dt", load_date)
        currencies = day_of(currencies, "date_update", load_date)
    done = transactions.where((F.col("account_number_from") >= 0) & (F.col("status") == "done"))
    per_account = done.groupBy(
        F.col("transaction_dt").cast("date").alias("date_update"),
        F.col("currency_code").alias("currency_from"),
        "account_number_from",
    ).agg(F.sum("amount").alias("_amount"), F.count(F.lit(1)).alias("_cnt"))
    daily = per_account.groupBy("date_update", "currency_from").agg(
        F.sum("_amount").alias("_total"),
        F.sum("_cnt").alias("cnt_transactions"),
        F.count(F.lit(1)).alias("cnt_accounts_make_transactions"),
    )
    rates = currencies.where(F.col("currency_code_with") == BASE_CURRENCY).select(
        F.col("date_update").cast("date").alias("date_update"),
        F.col("currency_code").alias("currency_from"),
        "currency_with_div",
    )
    total = F.col("_total").cast("decimal(18,0)")
    converted = F.when(F.col("currency_from") == BASE_CURRENCY, total).otherwise(
        total * F.col("currency_with_div")
    )
    mart = daily.join(rates, ["date_update", "currency_from"], "left").withColumns(
        {
            "amount_total": converted,
            "avg_transactions_per_account": ratio(
                F.col("_total"), F.col("cnt_accounts_make_transactions")
            ),
        }
    )
    return schemas.conform(mart, "global_metrics")


def load_global_metrics(
    mart: Table, transactions: DataFrame, currencies: DataFrame, load_date: str | None = None
) -> None:
    mart.upsert(
        global_metrics(transactions, currencies, load_date),
        ["date_update", "currency_from"],
        unique=True,
    )


def _filtered(metrics: DataFrame, since, until, currencies=None) -> DataFrame:
    if since is not None:
        metrics = metrics.where(F.col("date_update") >= F.lit(since).cast("date"))
    if until is not None:
        metrics = metrics.where(F.col("date_update") <= F.lit(until).cast("date"))
    if currencies:
        metrics = metrics.where(F.col("currency_from").isin(list(currencies)))
    return metrics


def amount_by_day(metrics: DataFrame, since=None, until=None, currencies=None) -> DataFrame:
    return (
        _filtered(metrics, since, until, currencies)
        .groupBy("date_update", "currency_from")
        .agg(F.sum("amount_total").cast("decimal(18,2)").alias("amount_total"))
    )


def avg_by_day(metrics: DataFrame, since=None, until=None, currencies=None) -> DataFrame:
    return _filtered(metrics, since, until, currencies).select(
        "date_update", "currency_from", "avg_transactions_per_account"
    )


def accounts_by_day(metrics: DataFrame, since=None, until=None, currencies=None) -> DataFrame:
    return _filtered(metrics, since, until, currencies).select(
        "date_update", "currency_from", "cnt_accounts_make_transactions"
    )


def turnover_by_day(metrics: DataFrame, since=None, until=None) -> DataFrame:
    """Total over all currencies; the currency filter does not apply here."""
    return (
        _filtered(metrics, since, until)
        .groupBy("date_update")
        .agg(F.sum("amount_total").cast("decimal(18,2)").alias("turnover"))
    )
