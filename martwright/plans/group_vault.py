"""Group-activity Data Vault: hubs, links, the history satellite, and conversion reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions import hash_key
from martwright.operators.tables import Table
from martwright.operators.workspace import cut_lineage

LOAD_SOURCE = "s3"


def _loaded(rows: DataFrame, load_dt: Column, load_src: str = LOAD_SOURCE) -> DataFrame:
    return rows.withColumn("load_dt", load_dt).withColumn("load_src", F.lit(load_src))


# -- hubs and links ---------------------------------------------------------


def hub_users(users: DataFrame, load_dt: Column) -> DataFrame:
    rows = users.where("user_id IS NOT NULL").select("user_id").distinct()
    return _loaded(rows.withColumn("hk_user_id", hash_key(F.col("user_id"))), load_dt)


def hub_groups(groups: DataFrame, load_dt: Column) -> DataFrame:
    """``groups`` has ``group_id`` and ``registration_dt``; the earliest date is kept."""
    rows = (
        groups.where("group_id IS NOT NULL")
        .groupBy("group_id")
        .agg(F.min("registration_dt").alias("registration_dt"))
    )
    return _loaded(rows.withColumn("hk_group_id", hash_key(F.col("group_id"))), load_dt)


def hub_dialogs(dialogs: DataFrame, load_dt: Column) -> DataFrame:
    rows = dialogs.groupBy("message_id").agg(F.min("message_ts").alias("message_ts"))
    return _loaded(rows.withColumn("hk_message_id", hash_key(F.col("message_id"))), load_dt)


def link_user_message(
    dialogs: DataFrame, h_users: DataFrame, h_dialogs: DataFrame, load_dt: Column
) -> DataFrame:
    rows = (
        dialogs.select(F.col("message_from").alias("user_id"), "message_id")
        .join(h_users.select("user_id", "hk_user_id"), "user_id")
        .join(h_dialogs.select("message_id", "hk_message_id"), "message_id")
        .withColumn("hk_l_user_message", hash_key(F.col("user_id"), F.col("message_id")))
        .select("hk_l_user_message", "hk_user_id", "hk_message_id")
        .distinct()
    )
    return _loaded(rows, load_dt)


def link_groups_dialogs(
    dialogs: DataFrame, h_groups: DataFrame, h_dialogs: DataFrame, load_dt: Column
) -> DataFrame:
    rows = (
        dialogs.select(F.col("message_group").alias("group_id"), "message_id")
        .join(h_groups.select("group_id", "hk_group_id"), "group_id")
        .join(h_dialogs.select("message_id", "hk_message_id"), "message_id")
        .withColumn("hk_l_groups_dialogs", hash_key(F.col("group_id"), F.col("message_id")))
        .select("hk_l_groups_dialogs", "hk_message_id", "hk_group_id")
        .distinct()
    )
    return _loaded(rows, load_dt)


def link_user_group_activity(
    group_log: DataFrame, h_users: DataFrame, h_groups: DataFrame, load_dt: Column
) -> DataFrame:
    """One row per user and group of the log.

    The log is reduced to its distinct pairs before the hub joins, so a busy
    group enters them once per user. Pairs without a hub row have no key and
    are left out, as the NULL key comparison of the load does.
    """
    pairs = group_log.select("user_id", "group_id").distinct()
    rows = (
        pairs.join(h_users.select("user_id", "hk_user_id"), "user_id")
        .join(h_groups.select("group_id", "hk_group_id"), "group_id")
        .withColumn("hk_l_user_group_activity", hash_key(F.col("group_id"), F.col("user_id")))
        .select("hk_l_user_group_activity", "hk_user_id", "hk_group_id")
    )
    return _loaded(rows, load_dt)


def load_link(rows: DataFrame, link: Table) -> None:
    link.insert_if_new(rows, ["hk_l_user_group_activity"])


# -- satellite --------------------------------------------------------------


def auth_history(
    group_log: DataFrame,
    h_users: DataFrame,
    h_groups: DataFrame,
    link: DataFrame,
    load_dt: Column,
) -> DataFrame:
    """Every log event under the key of its link.

    The link, with its business keys, is one narrow join away from the log.
    """
    keyed = (
        link.select("hk_l_user_group_activity", "hk_user_id", "hk_group_id")
        .join(h_users.select("hk_user_id", "user_id"), "hk_user_id")
        .join(h_groups.select("hk_group_id", "group_id"), "hk_group_id")
        .select("hk_l_user_group_activity", "user_id", "group_id")
    )
    rows = group_log.join(keyed, ["user_id", "group_id"]).select(
        "hk_l_user_group_activity",
        "user_id_from",
        "event",
        F.col("datetime").alias("event_dt"),
    )
    return _loaded(rows, load_dt)


def load_history(rows: DataFrame, satellite: Table, semantics: str = "corrected") -> None:
    """Append events that are not stored yet.

    ``reference`` skips a link once it has any event, so its later events are
    lost. ``corrected`` compares the event itself.
    """
    link_key = "hk_l_user_group_activity"
    event = [link_key, "event", "event_dt", "user_id_from"]
    if semantics != "reference":
        rows = rows.dropDuplicates(event)
    rows = cut_lineage(rows)
    # Only the history of the delivered links matters; a small delivery is
    # broadcast to the stored rows rather than these being shuffled.
    delivered = rows.select(link_key).distinct()
    stored = satellite.read().select(*event).join(delivered, link_key, "left_semi")
    if semantics == "reference":
        satellite.append(rows.join(stored.select(link_key), link_key, "left_anti"))
        return
    known = stored.select(*event)
    # user_id_from is NULL for users who joined on their own.
    same = [rows[c].eqNullSafe(known[c]) for c in event]
    satellite.append(rows.join(known, same, "left_anti"))


# -- reports ----------------------------------------------------------------


def oldest_groups(h_groups: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` groups registered first, ties by group id."""
    return h_groups.select("hk_group_id", "group_id", "registration_dt").orderBy(
        "registration_dt", "group_id"
    ).limit(k)


def _within(links: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Links of the given groups only; a short list of groups is broadcast."""
    if groups is None:
        return links
    return links.join(groups.select("hk_group_id"), "hk_group_id", "left_semi")


def users_added(
    history: DataFrame,
    link: DataFrame,
    semantics: str = "reference",
    groups: DataFrame | None = None,
) -> DataFrame:
    """Distinct users of 'add' events per group, of all groups or the given ones.

    ``reference`` counts the inviting users, ``corrected`` the added ones.
    """
    link = _within(link, groups)
    added = history.where(F.col("event") == "add").join(
        link.select("hk_l_user_group_activity", "hk_group_id", "hk_user_id"),
        "hk_l_user_group_activity",
    )
    counted = "user_id_from" if semantics == "reference" else "hk_user_id"
    return added.groupBy("hk_group_id").agg(F.countDistinct(counted).alias("cnt_added_users"))


def users_with_messages(
    l_groups_dialogs: DataFrame,
    h_dialogs: DataFrame,
    l_user_message: DataFrame,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Distinct users per group who wrote at least one message."""
    return (
        _within(l_groups_dialogs, groups).select("hk_message_id", "hk_group_id")
        .join(h_dialogs.select("hk_message_id"), "hk_message_id")
        .join(l_user_message.select("hk_message_id", "hk_user_id"), "hk_message_id")
        .groupBy("hk_group_id")
        .agg(F.countDistinct("hk_user_id").alias("cnt_users_in_group_with_messages"))
    )


def smallest(counts: DataFrame, h_groups: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """The ``k`` groups with the lowest ``measure``, ties by group id."""
    named = counts.join(h_groups.select("hk_group_id", "group_id"), "hk_group_id")
    return named.select("group_id", measure).orderBy(measure, "group_id").limit(k)


def group_conversion(groups: DataFrame, added: DataFrame, messaging: DataFrame) -> DataFrame:
    """Share of added users who wrote, for the given (oldest) groups.

    Give the same groups to :func:`users_added` and :func:`users_with_messages`,
    so that only their rows are counted.
    """
    share = F.try_divide(
        F.col("cnt_users_in_group_with_messages").cast("double"),
        F.col("cnt_added_users").cast("double"),
    )
    return (
        groups.select("hk_group_id", "group_id")
        .join(added, "hk_group_id", "left")
        .join(messaging, "hk_group_id", "left")
        .withColumn("group_conversion", share)
        .select(
            "group_id", "cnt_added_users", "cnt_users_in_group_with_messages", "group_conversion"
        )
        .orderBy(F.col("group_conversion").desc_nulls_first(), "group_id")
    )
