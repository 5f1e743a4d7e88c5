"""The test tables seen as the source tables of the marts.

Each view is one SQL text that both engines read: Spark gets the tables as
DataFrames, the SQL counterpart gets their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The city list, coordinates with a decimal comma.
CITY_LIST = """\
1;Sydney;-33,865;151,2094
2;Melbourne;-37,8136;144,9631
3;Brisbane;-27,4678;153,0281
4;Perth;-31,9522;115,8589
5;Adelaide;-34,9289;138,6011
6;Gold Coast;-28,0167;153,4
7;Cranbourne;-38,0996;145,2834
8;Canberra;-35,2931;149,1269
9;Newcastle;-32,9167;151,75
10;Wollongong;-34,4331;150,8831
11;Geelong;-38,15;144,35
12;Hobart;-42,8806;147,325
13;Townsville;-19,2564;146,8183
14;Ipswich;-27,6167;152,7667
15;Cairns;-16,9303;145,7703
16;Toowoomba;-27,5667;151,95
17;Darwin;-12,4381;130,8411
18;Ballarat;-37,55;143,85
19;Bendigo;-36,75;144,2667
20;Launceston;-41,4419;147,145
21;Mackay;-21,1411;149,1861
22;Rockhampton;-23,375;150,5117
23;Maitland;-32,7167;151,55
24;Bunbury;-33,3333;115,6333"""

_CITY_ROWS = [line.split(";") for line in CITY_LIST.splitlines()]


def _city_values() -> str:
    rows = ", ".join(
        f"('{i}', '{city}', CAST({lat.replace(',', '.')} AS DOUBLE), "
        f"CAST({lng.replace(',', '.')} AS DOUBLE))"
        for i, city, lat, lng in _CITY_ROWS
    )
    return f"SELECT * FROM (VALUES {rows}) t(id, city, city_lat, city_lng)"


VIEWS: dict[str, str] = {
    "v_cities": _city_values(),
    "v_f_order": """
        SELECT o_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS customer_id,
          l_suppkey AS craftsman_id, l_partkey AS product_id,
          CAST(o_orderdate AS DATE) AS order_created_date,
          CAST(l_shipdate AS DATE) AS order_completion_date,
          CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'created'
            WHEN l_linestatus = 'F' THEN 'delivery' ELSE 'in progress' END AS order_status,
          o_orderdate AS load_dttm
        FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey""",
    "v_d_craftsman": """
        SELECT s_suppkey AS craftsman_id, s_name AS craftsman_name, n_name AS craftsman_address,
          DATE '1970-01-01' + n_nationkey AS craftsman_birthday,
          CONCAT(LOWER(s_name), '@craft') AS craftsman_email,
          TIMESTAMP '1990-01-01 00:00:00' AS load_dttm
        FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey""",
    "v_d_customer": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS customer_address,
          DATE '1980-01-01' + n_nationkey AS customer_birthday,
          CONCAT(LOWER(c_name), '@home') AS customer_email,
          TIMESTAMP '1990-01-01 00:00:00' AS load_dttm
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey""",
    "v_d_product": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS product_description,
          p_type AS product_type, CAST(p_retailprice AS DECIMAL(18,2)) AS product_price,
          TIMESTAMP '1990-01-01 00:00:00' AS load_dttm
        FROM {part}""",
    "v_wide": """
        SELECT f.order_id, f.order_created_date, f.order_completion_date, f.order_status,
          m.craftsman_id, m.craftsman_name, m.craftsman_address, m.craftsman_birthday,
          m.craftsman_email, p.product_id, p.product_name, p.product_description,
          p.product_type, p.product_price, c.customer_id, c.customer_name, c.customer_address,
          c.customer_birthday, c.customer_email, o_orderpriority AS channel
        FROM {v_f_order} f JOIN {orders} ON o_orderkey = f.order_id
          JOIN {v_d_craftsman} m ON m.craftsman_id = f.craftsman_id
          JOIN {v_d_customer} c ON c.customer_id = f.customer_id
          JOIN {v_d_product} p ON p.product_id = f.product_id""",
    "v_sales": """
        SELECT CAST(o_orderdate AS DATE) AS date_actual, l_partkey % 10 AS item_id,
          o_custkey % 50 AS customer_id, c_nationkey AS city_id,
          CAST(l_quantity AS BIGINT) AS quantity,
          CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS payment_amount,
          CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'shipped' END AS status
        FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
          JOIN {customer} ON c_custkey = o_custkey""",
    "v_order_log": """
        SELECT event_id AS id, CAST(event_id AS VARCHAR(20)) AS uniq_id, ts AS date_time,
          CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 10 AS city_id,
          CONCAT('city ', CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 10
            AS VARCHAR(5))) AS city_name,
          CAST(user_id AS INT) AS customer_id,
          CONCAT('first ', CAST(user_id AS VARCHAR(20))) AS first_name,
          CONCAT('last ', CAST(user_id AS VARCHAR(20))) AS last_name,
          CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
            WHEN 'signup' THEN 4 ELSE 5 END AS item_id,
          event_type AS item_name, CAST(FLOOR(value / 10) + 1 AS BIGINT) AS quantity,
          CAST(value AS DECIMAL(10,2)) AS payment_amount,
          CASE WHEN event_type = 'error' THEN 'refunded' ELSE 'shipped' END AS status
        FROM {events}""",
    "v_deliveries": """
        SELECT o_orderkey AS delivery_id, o_custkey % 100 AS courier_id,
          CONCAT('courier ', CAST(o_custkey % 100 AS VARCHAR(10))) AS courier_name,
          CONCAT('addr ', CAST(o_orderkey % 500 AS VARCHAR(10))) AS address,
          o_orderdate AS delivery_ts,
          CASE WHEN o_custkey % 4 = 0 THEN 5 WHEN o_custkey % 4 = 1 THEN 4 + o_orderkey % 2
            ELSE 1 + o_orderkey % 5 END AS rate,
          f.delivery_sum, CAST((o_orderkey % 1000) * 0.01 AS DECIMAL(14,2)) AS tip_sum
        FROM {orders} JOIN (SELECT l_orderkey,
            CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS delivery_sum
          FROM {lineitem} GROUP BY l_orderkey) f ON f.l_orderkey = o_orderkey""",
    "v_transactions": """
        SELECT o_orderkey AS operation_id,
          CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_custkey END AS account_number_from,
          CAST(400 + 10 * (o_custkey % 5) AS INT) AS currency_code,
          CASE WHEN o_orderstatus = 'P' THEN 'chargeback' ELSE 'done' END AS status,
          CAST(FLOOR(o_totalprice) AS BIGINT) AS amount, o_orderdate AS transaction_dt
        FROM {orders}""",
    "v_fx": """
        SELECT d AS date_update, c AS currency_code, 420 AS currency_code_with,
          CAST(0.5 + (EXTRACT(DOY FROM d) % 100) * 0.01 AS DECIMAL(5,3)) AS currency_with_div
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, 400 AS c FROM {orders}
          UNION SELECT CAST(o_orderdate AS DATE), 410 FROM {orders}
          UNION SELECT CAST(o_orderdate AS DATE), 430 FROM {orders}) a""",
    "v_group_log": """
        SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS group_id, user_id,
          CASE WHEN event_id % 4 = 0 THEN NULL ELSE (user_id * 7 + 1) % 150 END AS user_id_from,
          CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'leave' ELSE 'create' END
            AS event,
          ts AS datetime
        FROM {events} WHERE event_type IN ('signup', 'error', 'view')""",
    "v_group_messages": """
        SELECT event_id AS message_id, ts AS message_ts, user_id AS message_from,
          CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS message_group
        FROM {events} WHERE event_type = 'click'""",
    "v_social": """
        SELECT e.event_id, CAST(e.ts AS DATE) AS date, e.ts AS event_ts,
          CASE e.event_type WHEN 'click' THEN 'message' WHEN 'view' THEN 'reaction'
            ELSE 'subscription' END AS event_type,
          e.user_id AS message_from,
          CASE WHEN e.event_id % 3 = 0 THEN (e.user_id + 12) % 150 END AS message_to,
          CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS message_group,
          CASE WHEN e.event_id % 50 = 0 THEN NULL
            ELSE c.city_lat + (e.user_id % 7) * CAST(0.002 AS DOUBLE) END AS lat,
          CASE WHEN e.event_id % 50 = 0 THEN NULL
            ELSE c.city_lng + (e.user_id % 5) * CAST(0.002 AS DOUBLE) END AS lon
        FROM (SELECT *, (user_id + CASE WHEN user_id % 3 = 0 THEN 0
              ELSE CAST(FLOOR((EXTRACT(DAY FROM ts) - 1) / 7) AS INT) END) % 12 + 1 AS cid
            FROM {events} WHERE event_type IN ('click', 'view', 'signup')) e
          JOIN {v_cities} c ON CAST(c.id AS BIGINT) = e.cid""",
    "v_campaigns": """
        SELECT CAST(s_suppkey AS VARCHAR(20)) AS restaurant_id,
          CONCAT('campaign ', CAST(s_suppkey AS VARCHAR(20))) AS adv_campaign_id,
          s_name AS adv_campaign_content, s_name AS adv_campaign_owner,
          CONCAT(LOWER(s_name), '@food') AS adv_campaign_owner_contact,
          1700000000 + s_suppkey * 60 AS adv_campaign_datetime_start,
          1700000000 + s_suppkey * 60 + s_nationkey * 600 AS adv_campaign_datetime_end,
          CAST(1700000000 + s_nationkey AS BIGINT) AS datetime_created
        FROM {supplier}""",
    "v_subscribers": """
        SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR(20)) AS client_id,
          CAST(c_custkey % 100 AS VARCHAR(20)) AS restaurant_id
        FROM {customer}""",
    "v_order_head": """
        SELECT o_orderkey AS object_id, o_orderdate AS order_dt,
          CAST(o_totalprice AS DECIMAL(18,2)) AS cost,
          CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS status,
          CONCAT('r', CAST(c_nationkey AS VARCHAR(10))) AS restaurant_id,
          n_name AS restaurant_name,
          CONCAT('u', CAST(o_custkey AS VARCHAR(20))) AS user_id, c_name AS user_name
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey
          JOIN {nation} ON n_nationkey = c_nationkey""",
    "v_order_line": """
        SELECT l_orderkey AS object_id, CONCAT('p', CAST(l_partkey AS VARCHAR(20))) AS product_id,
          p_name AS product_name, p_type AS category_name,
          CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS BIGINT) AS quantity,
          l_linenumber AS line_no
        FROM {lineitem} JOIN {part} ON p_partkey = l_partkey""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables of ``sf_dir`` as a DataFrame."""
    text = VIEWS[name]
    inputs = {
        part: view(spark, sf_dir, part) if part in VIEWS else table(spark, sf_dir, part)
        for part in (*TABLES, *VIEWS)
        if f"{{{part}}}" in text
    }
    # Timestamps without zone in both engines, whatever the session's setting.
    text = text.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return spark.sql(text, **inputs) if inputs else spark.sql(text)


def _needs(text: str) -> list[str]:
    """Views a text refers to, dependencies first."""
    found: list[str] = []
    for name, body in VIEWS.items():
        if f"{{{name}}}" in text:
            for inner in [*_needs(body), name]:
                if inner not in found:
                    found.append(inner)
    return found


def sql(text: str) -> str:
    """Standalone SQL for a text that refers to tables and views in braces."""
    names = {n: n for n in (*TABLES, *VIEWS)}
    needed = _needs(text)
    body = text.format(**names).strip()
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].format(**names)})" for n in needed)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def day(value: str):
    return F.lit(value).cast("date")
