"""Daily turnover queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martwright import schemas
from martwright.catalog.registry import query, rounded_ratio
from martwright.catalog.views import view
from martwright.operators.state import audited
from martwright.operators.tables import Table
from martwright.operators.workspace import scratch
from martwright.plans import finance as plan

_METRICS = f"""
SELECT t.date_update, t.currency_from,
  CAST(CASE WHEN t.currency_from = 420 THEN t.total
    ELSE CAST(t.total AS DECIMAL(18,0)) * f.currency_with_div END AS DECIMAL(18,2))
    AS amount_total,
  t.cnt_transactions,
  CAST({rounded_ratio("t.total", "t.accounts")} AS DECIMAL(14,2)) AS avg_transactions_per_account,
  t.accounts AS cnt_accounts_make_transactions
FROM (SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code AS currency_from,
    CAST(SUM(amount) AS BIGINT) AS total, COUNT(*) AS cnt_transactions,
    COUNT(DISTINCT account_number_from) AS accounts
  FROM {{v_transactions}} WHERE account_number_from >= 0 AND status = 'done'
  GROUP BY CAST(transaction_dt AS DATE), currency_code) t
LEFT JOIN {{v_fx}} f ON f.date_update = t.date_update AND f.currency_code = t.currency_from
  AND f.currency_code_with = 420"""


def _sources(spark, sf_dir):
    return view(spark, sf_dir, "v_transactions"), view(spark, sf_dir, "v_fx")


def _metrics(spark, sf_dir):
    return plan.global_metrics(*_sources(spark, sf_dir))


@query("global_metrics", _METRICS)
def global_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query("global_metrics_day_merge", _METRICS)
def global_metrics_day_merge(spark, sf_dir):
    """All days merged into the mart, then one day merged again."""
    path = scratch(spark, "global_metrics")
    mart = Table(spark, path, schemas.SCHEMAS["global_metrics"])
    sources = _sources(spark, sf_dir)
    plan.load_global_metrics(mart, *sources)
    plan.load_global_metrics(mart, *sources, load_date="1998-08-02")
    return mart.read()


@query(
    "dash_amount_by_day",
    f"""SELECT date_update, currency_from, CAST(SUM(amount_total) AS DECIMAL(18,2)) AS amount_total
FROM ({_METRICS}) m GROUP BY date_update, currency_from""",
)
def dash_amount_by_day(spark, sf_dir):
    return plan.amount_by_day(_metrics(spark, sf_dir))


@query(
    "dash_avg_by_day",
    f"SELECT date_update, currency_from, avg_transactions_per_account FROM ({_METRICS}) m",
)
def dash_avg_by_day(spark, sf_dir):
    return plan.avg_by_day(_metrics(spark, sf_dir))


@query(
    "dash_accounts_by_day",
    f"""SELECT date_update, currency_from, cnt_accounts_make_transactions FROM ({_METRICS}) m
WHERE date_update BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND currency_from IN (410, 420)""",
)
def dash_accounts_by_day(spark, sf_dir):
    """With the dashboard's date range and currency filters set."""
    return plan.accounts_by_day(_metrics(spark, sf_dir), "1996-01-01", "1999-12-31", [410, 420])


@query(
    "dash_turnover",
    f"""SELECT date_update, CAST(SUM(amount_total) AS DECIMAL(18,2)) AS turnover
FROM ({_METRICS}) m GROUP BY date_update""",
)
def dash_turnover(spark, sf_dir):
    return plan.turnover_by_day(_metrics(spark, sf_dir))


@query(
    "transactions_day_extract",
    """SELECT operation_id, account_number_from, currency_code, status, amount, transaction_dt
FROM {v_transactions} WHERE transaction_dt >= TIMESTAMP '1998-08-02 00:00:00'
  AND transaction_dt < TIMESTAMP '1998-08-03 00:00:00'""",
)
def transactions_day_extract(spark, sf_dir):
    return plan.day_of(view(spark, sf_dir, "v_transactions"), "transaction_dt", "1998-08-02")


@query(
    "staging_day_overwrite",
    "SELECT event_id, event_type, ts, CAST(ts AS DATE) AS load_date FROM {events}",
)
def staging_day_overwrite(spark, sf_dir):
    """All days staged, two of them a second time: nothing is doubled."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "ts")
    staging = Table(
        spark,
        scratch(spark, "staging"),
        "event_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ, load_date DATE",
        ["load_date"],
    )
    plan.stage_days(events, "ts", staging)
    for day in ("2024-01-10", "2024-01-11"):
        plan.stage_days(events, "ts", staging, day)
    return staging.read()


@query(
    "audit_log",
    """SELECT 'STAGING' AS schema_name, 'transactions' AS table_name, COUNT(*) AS rows_loaded,
  'SUCCESS' AS status FROM {v_transactions}
UNION ALL SELECT 'STAGING', 'currencies', 0, 'ERROR'""",
)
def audit_log(spark, sf_dir):
    """A load that succeeds and one that fails, both on record."""
    root = scratch(spark, "audit")
    staged = Table(
        spark, f"{root}/transactions", view(spark, sf_dir, "v_transactions").schema
    )
    day = dt.datetime(2024, 1, 1)

    def load() -> int:
        staged.refresh(view(spark, sf_dir, "v_transactions"))
        return staged.read().count()

    def fail() -> int:
        raise ConnectionError("source is away")

    audited(spark, f"{root}/log", "STAGING", "transactions", day, load)
    try:
        audited(spark, f"{root}/log", "STAGING", "currencies", day, fail)
    except ConnectionError:
        pass
    log = Table(spark, f"{root}/log", schemas.SCHEMAS["load_log"]).read()
    return log.select(
        "schema_name", "table_name", F.col("rows_loaded").cast("bigint"), "status"
    )
