"""Order Data Vault: hubs, links and satellites of closed orders, and their counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright import schemas
from martwright.functions import number_text, parse_timestamp, uuid5

CLOSED = "CLOSED"

# Table -> its key column.
HUBS = {
    "h_user": "h_user_pk",
    "h_product": "h_product_pk",
    "h_category": "h_category_pk",
    "h_restaurant": "h_restaurant_pk",
    "h_order": "h_order_pk",
}
LINKS = {
    "l_order_product": "hk_order_product_pk",
    "l_product_restaurant": "hk_product_restaurant_pk",
    "l_product_category": "hk_product_category_pk",
    "l_order_user": "hk_order_user_pk",
}
SATELLITES = {
    "s_user_names": "hk_user_names_hashdiff",
    "s_product_names": "hk_product_names_hashdiff",
    "s_restaurant_names": "hk_restaurant_names_hashdiff",
    "s_order_cost": "hk_order_cost_hashdiff",
    "s_order_status": "hk_order_status_hashdiff",
}
VAULT = {**HUBS, **LINKS, **SATELLITES}


def closed_orders(messages: DataFrame) -> DataFrame:
    """Closed orders with the source's ids of order, user and restaurant."""
    body = F.col("payload")
    return messages.where(body["status"] == CLOSED).select(
        "object_id",
        "object_type",
        body["id"].alias("order_id"),
        parse_timestamp(body["date"]).alias("order_dt"),
        number_text(body["cost"]).alias("cost"),
        number_text(body["payment"]).alias("payment"),
        body["status"].alias("status"),
        body["user"]["id"].alias("user_id"),
        body["user"]["name"].alias("username"),
        body["user"]["name"].alias("userlogin"),
        body["restaurant"]["id"].alias("restaurant_id"),
        body["restaurant"]["name"].alias("restaurant_name"),
        body["products"].alias("products"),
    )


def order_lines(orders: DataFrame) -> DataFrame:
    """One row per product line of a closed order."""
    return orders.withColumn("p", F.explode("products")).select(
        "order_id",
        "restaurant_id",
        F.col("p.id").alias("product_id"),
        F.col("p.name").alias("name"),
        F.col("p.category").alias("category_name"),
    )


# Vault key -> the source's id that it is made of.
_IDS = {
    "h_order_pk": "order_id",
    "h_user_pk": "user_id",
    "h_restaurant_pk": "restaurant_id",
    "h_product_pk": "product_id",
    "h_category_pk": "category_name",
}


def _complete(*parts: Column) -> Column:
    """:func:`uuid5` of parts that are not NULL.

    Never NULL, so that a check of the key is not moved below the distinct rows, where it would hash all.
    """
    return F.coalesce(uuid5(*parts), F.lit(""))


def vault_rows(orders: DataFrame) -> dict[str, DataFrame]:
    """Rows for every hub, link and satellite, named as the tables are.

    Hash keys of links and satellites join the text of their parts without a
    delimiter. Rows that lack a part of their key are left out. The ids and
    attributes of a table are made distinct before they are hashed: messages
    repeat them by far, and each hash is dear.
    """
    lines = order_lines(orders)
    restaurants = orders.withColumn("name", F.col("restaurant_name"))
    # Table -> its rows, the hubs it names, other attributes, and the parts of its own key.
    parts = {
        "h_user": (orders, ["h_user_pk"], ["user_id"], []),
        "h_restaurant": (orders, ["h_restaurant_pk"], ["restaurant_id"], []),
        "h_order": (orders, ["h_order_pk"], ["order_id", "order_dt"], []),
        "h_product": (lines, ["h_product_pk"], ["product_id"], []),
        "h_category": (lines, ["h_category_pk"], ["category_name"], []),
        "l_order_product": (lines, ["h_order_pk", "h_product_pk"], [], ["h_order_pk", "h_product_pk"]),
        "l_product_restaurant": (lines, ["h_product_pk", "h_restaurant_pk"], [], ["h_product_pk", "h_restaurant_pk"]),
        "l_product_category": (lines, ["h_product_pk", "h_category_pk"], [], ["h_product_pk", "h_category_pk"]),
        "l_order_user": (orders, ["h_order_pk", "h_user_pk"], [], ["h_order_pk", "h_user_pk"]),
        "s_user_names": (orders, ["h_user_pk"], ["username", "userlogin"], ["h_user_pk", "username", "userlogin"]),
        "s_product_names": (lines, ["h_product_pk"], ["name"], ["h_product_pk", "name"]),
        "s_restaurant_names": (restaurants, ["h_restaurant_pk"], ["name"], ["h_restaurant_pk", "name"]),
        "s_order_cost": (orders, ["h_order_pk"], ["cost", "payment"], ["h_order_pk", "cost", "payment"]),
        "s_order_status": (orders, ["h_order_pk"], ["status"], ["h_order_pk", "status"]),
    }
    keyed = {}
    for name, (source, hubs, attributes, own) in parts.items():
        rows = source.select(*dict.fromkeys([*(_IDS[h] for h in hubs), *attributes])).distinct()
        rows = rows.dropna(subset=[_IDS.get(c, c) for c in own or hubs])
        rows = rows.withColumns({h: _complete(F.col(_IDS[h])) for h in hubs})
        if own:
            rows = rows.withColumn(VAULT[name], _complete(*[F.col(c) for c in own]))
        keyed[name] = schemas.conform(rows, name)
    return keyed


def enriched_messages(orders: DataFrame) -> DataFrame:
    """The message for the counters: ids replaced by vault keys, products in place."""
    products = F.transform(
        "products",
        lambda p: F.struct(
            uuid5(p["id"]).alias("id"),
            p["name"].alias("name"),
            F.struct(uuid5(p["category"]).alias("id"), p["category"].alias("name")).alias(
                "category"
            ),
        ),
    )
    user = F.struct(uuid5(F.col("user_id")).alias("id"))
    payload = F.struct(user.alias("user"), products.alias("products"))
    return orders.select("object_id", "object_type", payload.alias("payload"))


# -- counters ---------------------------------------------------------------


def counter_lines(messages: DataFrame) -> DataFrame:
    """Product lines of enriched messages."""
    return messages.withColumn("p", F.explode("payload.products")).select(
        "object_id",
        F.col("payload.user.id").alias("user_id"),
        F.col("p.id").alias("product_id"),
        F.col("p.name").alias("product_name"),
        F.col("p.category.id").alias("category_id"),
        F.col("p.category.name").alias("category_name"),
    )


def count_orders(lines: DataFrame, subject: str, semantics: str = "reference") -> DataFrame:
    """Orders per user and ``subject`` (``product`` or ``category``) in ``lines``.

    ``reference`` counts product lines, ``corrected`` distinct orders. The name
    is that of the latest order.
    """
    key, name = f"{subject}_id", f"{subject}_name"
    if semantics == "reference":
        per_order = lines.groupBy("user_id", key, "object_id").agg(
            F.max(name).alias(name), F.count(F.lit(1)).alias("_n")
        )
    else:
        per_order = lines.groupBy("user_id", key, "object_id").agg(
            F.max(name).alias(name), F.lit(1).cast("bigint").alias("_n")
        )
    return per_order.groupBy("user_id", key).agg(
        F.max_by(name, "object_id").alias(name),
        F.sum("_n").alias("order_cnt"),
        F.max("object_id").alias("last_object_id"),
    )
