"""Campaign notifications: which subscribers to tell about which campaign now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOTIFICATION_KEY = ["restaurant_id", "adv_campaign_id", "client_id"]


def active_campaigns(campaigns: DataFrame, now: Column | None = None) -> DataFrame:
    """Campaigns whose interval holds ``now`` (epoch seconds), both ends included."""
    now = F.unix_timestamp() if now is None else now
    return campaigns.where(
        now.between(F.col("adv_campaign_datetime_start"), F.col("adv_campaign_datetime_end"))
    )


def notifications(
    campaigns: DataFrame, subscribers: DataFrame, now: Column | None = None
) -> DataFrame:
    """Active campaigns joined to the subscribers of their restaurant."""
    now = F.unix_timestamp() if now is None else now
    clients = subscribers.select("restaurant_id", "client_id")
    return (
        active_campaigns(campaigns, now)
        .join(clients, "restaurant_id")
        .withColumn("trigger_datetime_created", now.cast("bigint"))
    )
