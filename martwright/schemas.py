"""Table schemas (fixed values: column names and types of the warehouse layers)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Staging, warehouse and mart layouts.
_DDL = {
    # customer report
    "d_craftsman": "craftsman_id BIGINT, craftsman_name STRING, craftsman_address STRING, "
    "craftsman_birthday DATE, craftsman_email STRING, load_dttm TIMESTAMP_NTZ",
    "d_customer": "customer_id BIGINT, customer_name STRING, customer_address STRING, "
    "customer_birthday DATE, customer_email STRING, load_dttm TIMESTAMP_NTZ",
    "d_product": "product_id BIGINT, product_name STRING, product_description STRING, "
    "product_type STRING, product_price DECIMAL(18,2), load_dttm TIMESTAMP_NTZ",
    "f_order": "order_id BIGINT, product_id BIGINT, craftsman_id BIGINT, customer_id BIGINT, "
    "order_created_date DATE, order_completion_date DATE, order_status STRING, "
    "load_dttm TIMESTAMP_NTZ",
    "customer_report_datamart": "customer_id BIGINT, customer_name STRING, "
    "customer_address STRING, customer_birthday DATE, customer_email STRING, "
    "customer_costs DECIMAL(18,2), platform_money DECIMAL(18,2), total_order_count BIGINT, "
    "avg_order_price DECIMAL(18,2), median_time_order_completed DECIMAL(10,1), "
    "top_craftsman_id BIGINT, top_product_category STRING, count_order_created BIGINT, "
    "count_order_in_progress BIGINT, count_order_delivery BIGINT, count_order_done BIGINT, "
    "count_order_not_done BIGINT, report_period STRING",
    "load_dates_customer_report_datamart": "id BIGINT, load_dttm TIMESTAMP_NTZ",
    # sales and retention
    "user_order_log": "uniq_id STRING, date_time TIMESTAMP_NTZ, city_id INT, city_name STRING, "
    "customer_id INT, first_name STRING, last_name STRING, item_id INT, item_name STRING, "
    "quantity BIGINT, payment_amount DECIMAL(10,2), status STRING",
    "d_city": "city_id INT, city_name STRING",
    "d_customer_sales": "customer_id INT, first_name STRING, last_name STRING, city_id INT",
    "d_item": "item_id INT, item_name STRING",
    "d_calendar": "date_id INT, date_actual DATE",
    "f_sales": "date_id INT, item_id INT, customer_id INT, city_id INT, quantity BIGINT, "
    "payment_amount DECIMAL(10,2), status STRING",
    "f_customer_retention": "period_id INT, item_id INT, new_customers_count BIGINT, "
    "returning_customers_count BIGINT, refunded_customer_count BIGINT, "
    "new_customers_revenue DECIMAL(18,2), returning_customers_revenue DECIMAL(18,2), "
    "customers_refunded BIGINT",
    # courier settlement
    "deliverysystem_couriers": "object_id STRING, object_value STRING",
    "deliverysystem_deliveries": "object_id STRING, object_value STRING",
    "dm_couriers": "id BIGINT, object_id STRING, name STRING",
    "dm_delivery_addresses": "id BIGINT, delivery_address STRING",
    "dm_deliveries": "id BIGINT, delivery_id STRING, delivery_ts TIMESTAMP_NTZ, order_id BIGINT, "
    "order_ts TIMESTAMP_NTZ, address_id BIGINT, courier_id BIGINT",
    "fct_courier_deliveries": "courier_id BIGINT, delivery_id BIGINT, rate INT, "
    "delivery_sum DECIMAL(18,2), tip_sum DECIMAL(14,2)",
    "dm_courier_rating": "min_rating DECIMAL(3,2), max_rating DECIMAL(3,2), percent_rate INT, "
    "min_payment INT",
    "dm_courier_report": "courier_id BIGINT, courier_name STRING, settlement_year INT, "
    "settlement_month INT, orders_count BIGINT, orders_total_sum DECIMAL(18,2), "
    "rate_avg DECIMAL(18,2), order_processing_fee DECIMAL(18,2), "
    "courier_order_sum DECIMAL(18,2), courier_tips_sum DECIMAL(18,2), "
    "courier_reward_sum DECIMAL(18,2)",
    "srv_wf_settings": "workflow_key STRING, workflow_settings STRING",
    # group vault
    "users": "id BIGINT, chat_name STRING, registration_dt TIMESTAMP_NTZ, country STRING, age INT",
    "groups": "id BIGINT, admin_id BIGINT, group_name STRING, registration_dt TIMESTAMP_NTZ, "
    "is_private INT",
    "dialogs": "message_id BIGINT, message_ts TIMESTAMP_NTZ, message_from BIGINT, "
    "message_to BIGINT, message STRING, message_group BIGINT",
    "group_log": "group_id BIGINT, user_id BIGINT, user_id_from BIGINT, event STRING, "
    "datetime TIMESTAMP_NTZ",
    "h_users": "hk_user_id BIGINT, user_id BIGINT, load_dt TIMESTAMP_NTZ, load_src STRING",
    "h_groups": "hk_group_id BIGINT, group_id BIGINT, registration_dt TIMESTAMP_NTZ, "
    "load_dt TIMESTAMP_NTZ, load_src STRING",
    "h_dialogs": "hk_message_id BIGINT, message_id BIGINT, message_ts TIMESTAMP_NTZ, "
    "load_dt TIMESTAMP_NTZ, load_src STRING",
    "l_user_message": "hk_l_user_message BIGINT, hk_user_id BIGINT, hk_message_id BIGINT, "
    "load_dt TIMESTAMP_NTZ, load_src STRING",
    "l_groups_dialogs": "hk_l_groups_dialogs BIGINT, hk_message_id BIGINT, hk_group_id BIGINT, "
    "load_dt TIMESTAMP_NTZ, load_src STRING",
    "l_user_group_activity": "hk_l_user_group_activity BIGINT, hk_user_id BIGINT, "
    "hk_group_id BIGINT, load_dt TIMESTAMP_NTZ, load_src STRING",
    "s_auth_history": "hk_l_user_group_activity BIGINT, user_id_from BIGINT, event STRING, "
    "event_dt TIMESTAMP_NTZ, load_dt TIMESTAMP_NTZ, load_src STRING",
    # geo marts
    "geo_cities": "id STRING, city STRING, lat STRING, lng STRING",
    "users_mart": "user_id BIGINT, act_city STRING, local_time TIMESTAMP_NTZ, home_city STRING, "
    "travel_count BIGINT, travel_array ARRAY<STRING>",
    "zones_mart": "zone_id STRING, year INT, month INT, week INT, week_message_cnt BIGINT, "
    "week_reaction_cnt BIGINT, week_subscription_cnt BIGINT, month_message_cnt BIGINT, "
    "month_reaction_cnt BIGINT, month_subscription_cnt BIGINT, week_reg_cnt BIGINT, "
    "month_reg_cnt BIGINT",
    "friends_mart": "user_left BIGINT, user_right BIGINT, zone_id STRING, processed_dttm DATE, "
    "local_time TIMESTAMP",
    # campaign notifications
    "campaign_message": "restaurant_id STRING, adv_campaign_id STRING, "
    "adv_campaign_content STRING, adv_campaign_owner STRING, adv_campaign_owner_contact STRING, "
    "adv_campaign_datetime_start BIGINT, adv_campaign_datetime_end BIGINT, "
    "datetime_created BIGINT",
    "subscribers_restaurants": "id BIGINT, client_id STRING, restaurant_id STRING",
    "subscribers_feedback": "restaurant_id STRING, adv_campaign_id STRING, "
    "adv_campaign_content STRING, adv_campaign_owner STRING, adv_campaign_owner_contact STRING, "
    "adv_campaign_datetime_start BIGINT, adv_campaign_datetime_end BIGINT, "
    "datetime_created BIGINT, client_id STRING, trigger_datetime_created BIGINT, feedback STRING",
    # order vault and counters
    "order_message": "object_id BIGINT, object_type STRING, payload STRUCT<id: BIGINT, "
    "date: STRING, cost: STRING, payment: STRING, status: STRING, "
    "restaurant: STRUCT<id: STRING, name: STRING>, user: STRUCT<id: STRING, name: STRING>, "
    "products: ARRAY<STRUCT<id: STRING, name: STRING, price: STRING, quantity: BIGINT, "
    "category: STRING>>>",
    "enriched_message": "object_id BIGINT, object_type STRING, payload STRUCT<"
    "user: STRUCT<id: STRING>, products: ARRAY<STRUCT<id: STRING, name: STRING, "
    "category: STRUCT<id: STRING, name: STRING>>>>",
    "h_user": "h_user_pk STRING, user_id STRING",
    "h_product": "h_product_pk STRING, product_id STRING",
    "h_category": "h_category_pk STRING, category_name STRING",
    "h_restaurant": "h_restaurant_pk STRING, restaurant_id STRING",
    "h_order": "h_order_pk STRING, order_id BIGINT, order_dt TIMESTAMP_NTZ",
    "l_order_product": "hk_order_product_pk STRING, h_order_pk STRING, h_product_pk STRING",
    "l_product_restaurant": "hk_product_restaurant_pk STRING, h_product_pk STRING, "
    "h_restaurant_pk STRING",
    "l_product_category": "hk_product_category_pk STRING, h_product_pk STRING, "
    "h_category_pk STRING",
    "l_order_user": "hk_order_user_pk STRING, h_order_pk STRING, h_user_pk STRING",
    "s_user_names": "hk_user_names_hashdiff STRING, h_user_pk STRING, username STRING, "
    "userlogin STRING",
    "s_product_names": "hk_product_names_hashdiff STRING, h_product_pk STRING, name STRING",
    "s_restaurant_names": "hk_restaurant_names_hashdiff STRING, h_restaurant_pk STRING, "
    "name STRING",
    "s_order_cost": "hk_order_cost_hashdiff STRING, h_order_pk STRING, cost DECIMAL(19,5), "
    "payment DECIMAL(19,5)",
    "s_order_status": "hk_order_status_hashdiff STRING, h_order_pk STRING, status STRING",
    "user_product_counters": "user_id STRING, product_id STRING, product_name STRING, "
    "order_cnt BIGINT",
    "user_category_counters": "user_id STRING, category_id STRING, category_name STRING, "
    "order_cnt BIGINT",
    # finance
    "transactions": "operation_id STRING, account_number_from BIGINT, account_number_to BIGINT, "
    "currency_code INT, country STRING, status STRING, transaction_type STRING, amount BIGINT, "
    "transaction_dt TIMESTAMP_NTZ",
    "currencies": "date_update TIMESTAMP_NTZ, currency_code INT, currency_code_with INT, "
    "currency_with_div DECIMAL(5,3)",
    "global_metrics": "date_update DATE, currency_from INT, amount_total DECIMAL(18,2), "
    "cnt_transactions BIGINT, avg_transactions_per_account DECIMAL(14,2), "
    "cnt_accounts_make_transactions BIGINT",
    "load_log": "schema_name STRING, table_name STRING, load_date TIMESTAMP_NTZ, "
    "load_end TIMESTAMP_NTZ, rows_loaded BIGINT, status STRING, error_message STRING",
}


class _Schemas(Mapping):
    """Schemas by table name, parsed at first use (parsing needs a running session)."""

    def __init__(self, texts: dict[str, str]):
        self._texts = texts
        self._parsed: dict[str, T.StructType] = {}

    def __getitem__(self, name: str) -> T.StructType:
        if name not in self._parsed:
            self._parsed[name] = T.StructType.fromDDL(self._texts[name])
        return self._parsed[name]

    def __iter__(self):
        return iter(self._texts)

    def __len__(self) -> int:
        return len(self._texts)


SCHEMAS = _Schemas(_DDL)


def column_names(name: str) -> list[str]:
    """Columns of a table without nested types, known before a session exists."""
    return [field.split()[0] for field in _DDL[name].split(", ")]


# Partition columns that loads and date-range readers prune by.
PARTITIONS: dict[str, list[str]] = {
    "customer_report_datamart": ["report_period"],
    "f_sales": ["date_id"],
    "global_metrics": ["date_update"],
}

# Default values of columns that older sources lack.
DEFAULTS: dict[str, dict[str, object]] = {
    "user_order_log": {"status": "shipped"},
    "f_sales": {"status": "shipped"},
    "f_customer_retention": {
        "new_customers_count": 0,
        "returning_customers_count": 0,
        "refunded_customer_count": 0,
        "new_customers_revenue": 0,
        "returning_customers_revenue": 0,
        "customers_refunded": 0,
    },
}


def conform(rows: DataFrame, name: str) -> DataFrame:
    """Rows in the column order and types of a registered table.

    A missing column takes the table's default, or NULL.
    """
    defaults = DEFAULTS.get(name, {})
    columns = []
    for field in SCHEMAS[name].fields:
        value = (
            F.col(field.name) if field.name in rows.columns else F.lit(defaults.get(field.name))
        )
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def create_table(
    spark: SparkSession, name: str, identifier: str | None = None, replace: bool = False
) -> None:
    """Create a registered table in the session catalog as partitioned Parquet."""
    target = identifier or name
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {target}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[name].fields)
    parts = PARTITIONS.get(name)
    clause = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({columns}) USING parquet{clause}")
