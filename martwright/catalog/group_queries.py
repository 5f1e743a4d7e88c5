"""Group vault and conversion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright import schemas
from martwright.catalog.registry import query
from martwright.catalog.views import day, view
from martwright.operators.tables import Table
from martwright.operators.workspace import cut_lineage, scratch
from martwright.plans import group_vault as plan

_NOW = "2024-02-01 00:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp_ntz")


def _vault(spark, sf_dir):
    log = view(spark, sf_dir, "v_group_log")
    dialogs = view(spark, sf_dir, "v_group_messages")
    users = log.select("user_id").unionByName(
        dialogs.select(F.col("message_from").alias("user_id"))
    )
    groups = log.select("group_id", F.col("datetime").alias("registration_dt"))
    h_users = plan.hub_users(users, _now())
    h_groups = plan.hub_groups(groups, _now())
    return log, dialogs, h_users, h_groups


def _oldest(spark, sf_dir):
    return cut_lineage(plan.oldest_groups(_vault(spark, sf_dir)[3]))


def _added(spark, sf_dir, semantics, groups=None):
    log, _, h_users, h_groups = _vault(spark, sf_dir)
    link = plan.link_user_group_activity(log, h_users, h_groups, _now())
    history = plan.auth_history(log, h_users, h_groups, link, _now())
    return plan.users_added(history, link, semantics, groups), h_groups


def _messaging(spark, sf_dir, groups=None):
    _, dialogs, h_users, h_groups = _vault(spark, sf_dir)
    h_dialogs = plan.hub_dialogs(dialogs, _now())
    return plan.users_with_messages(
        plan.link_groups_dialogs(dialogs, h_groups, h_dialogs, _now()),
        h_dialogs,
        plan.link_user_message(dialogs, h_users, h_dialogs, _now()),
        groups,
    )


_ADDED = """SELECT group_id, COUNT(DISTINCT {column}) AS cnt_added_users
  FROM {{v_group_log}} WHERE event = 'add' GROUP BY group_id"""
_MESSAGES = """SELECT message_group AS group_id,
    COUNT(DISTINCT message_from) AS cnt_users_in_group_with_messages
  FROM {v_group_messages} WHERE message_group IN (SELECT group_id FROM {v_group_log})
  GROUP BY message_group"""


def _conversion_sql(column):
    added = _ADDED.format(column=column)
    return f"""
WITH oldest AS (SELECT group_id, MIN(datetime) AS dt FROM {{v_group_log}} GROUP BY group_id
  ORDER BY dt, group_id LIMIT 10)
SELECT o.group_id, a.cnt_added_users, m.cnt_users_in_group_with_messages,
  m.cnt_users_in_group_with_messages / CAST(a.cnt_added_users AS DOUBLE) AS group_conversion
FROM oldest o LEFT JOIN ({added}) a ON a.group_id = o.group_id
  LEFT JOIN ({_MESSAGES}) m ON m.group_id = o.group_id"""


@query("group_conversion", _conversion_sql("user_id_from"))
def group_conversion(spark, sf_dir):
    groups = _oldest(spark, sf_dir)
    added, _ = _added(spark, sf_dir, "reference", groups)
    return plan.group_conversion(groups, added, _messaging(spark, sf_dir, groups))


@query("group_conversion_corrected", _conversion_sql("user_id"))
def group_conversion_corrected(spark, sf_dir):
    groups = _oldest(spark, sf_dir)
    added, _ = _added(spark, sf_dir, "corrected", groups)
    return plan.group_conversion(groups, added, _messaging(spark, sf_dir, groups))


@query(
    "group_users_added",
    _ADDED.format(column="user_id_from") + " ORDER BY cnt_added_users, group_id LIMIT 10",
)
def group_users_added(spark, sf_dir):
    added, h_groups = _added(spark, sf_dir, "reference")
    return plan.smallest(added, h_groups, "cnt_added_users")


@query(
    "group_users_messages",
    _MESSAGES + " ORDER BY cnt_users_in_group_with_messages, group_id LIMIT 10",
)
def group_users_messages(spark, sf_dir):
    _, _, _, h_groups = _vault(spark, sf_dir)
    return plan.smallest(
        _messaging(spark, sf_dir), h_groups, "cnt_users_in_group_with_messages"
    )


def _halves(log):
    """The log up to mid-month and the whole log: a first and a second delivery."""
    return log.where(F.col("datetime").cast("date") < day("2024-01-16")), log


def _tables(spark):
    root = scratch(spark, "group_vault")
    return [
        Table(spark, f"{root}/{name}", schemas.SCHEMAS[name])
        for name in ("l_user_group_activity", "s_auth_history")
    ]


@query("group_vault_link", "SELECT DISTINCT user_id, group_id FROM {v_group_log}")
def group_vault_link(spark, sf_dir):
    """The link loaded from two overlapping deliveries, shown by business keys."""
    log, _, h_users, h_groups = _vault(spark, sf_dir)
    link, _ = _tables(spark)
    for part in _halves(log):
        plan.load_link(plan.link_user_group_activity(part, h_users, h_groups, _now()), link)
    return (
        link.read()
        .join(h_users.select("hk_user_id", "user_id"), "hk_user_id")
        .join(h_groups.select("hk_group_id", "group_id"), "hk_group_id")
        .select("user_id", "group_id")
    )


def _satellite(spark, sf_dir, semantics):
    log, _, h_users, h_groups = _vault(spark, sf_dir)
    link, history = _tables(spark)
    for part in _halves(log):
        plan.load_link(plan.link_user_group_activity(part, h_users, h_groups, _now()), link)
        rows = plan.auth_history(part, h_users, h_groups, link.read(), _now())
        plan.load_history(rows, history, semantics)
    return (
        history.read()
        .join(link.read().drop("load_dt", "load_src"), "hk_l_user_group_activity")
        .join(h_users.select("hk_user_id", "user_id"), "hk_user_id")
        .join(h_groups.select("hk_group_id", "group_id"), "hk_group_id")
        .select("user_id", "group_id", "user_id_from", "event", "event_dt")
    )


@query(
    "group_vault_satellite",
    """
WITH early AS (SELECT * FROM {v_group_log} WHERE datetime < TIMESTAMP '2024-01-16 00:00:00')
SELECT user_id, group_id, user_id_from, event, datetime AS event_dt FROM early
UNION ALL SELECT l.user_id, l.group_id, l.user_id_from, l.event, l.datetime FROM {v_group_log} l
WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.user_id = l.user_id AND e.group_id = l.group_id)""",
)
def group_vault_satellite(spark, sf_dir):
    """As the load is written: a link that has history takes no later events."""
    return _satellite(spark, sf_dir, "reference")


@query(
    "group_vault_satellite_corrected",
    """SELECT DISTINCT user_id, group_id, user_id_from, event, datetime AS event_dt
FROM {v_group_log}""",
)
def group_vault_satellite_corrected(spark, sf_dir):
    return _satellite(spark, sf_dir, "corrected")
