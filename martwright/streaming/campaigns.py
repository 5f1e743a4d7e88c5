"""Campaign stream -> feedback table and push messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright import schemas
from martwright.operators.tables import Table
from martwright.operators.workspace import cut_lineage
from martwright.plans.notifications import NOTIFICATION_KEY, active_campaigns, notifications
from martwright.sources.readers import read_messages
from martwright.sources.writers import as_messages, write_messages
from martwright.streaming.batches import Journal, batch_table, new_rows, replace_batch, run_stream


def feedback_table(spark: SparkSession, path: str) -> Table:
    return batch_table(spark, path, schemas.SCHEMAS["subscribers_feedback"])


def campaign_handler(
    subscribers: Callable[[], DataFrame],
    feedback: Table,
    push: Mapping[str, str],
    journal: Journal,
    now: Callable[[], Column] = F.unix_timestamp,
) -> Callable[[DataFrame, int], None]:
    """Handler of one micro-batch.

    Which campaigns are active and who subscribes is decided once, at the first attempt, and journalled
    with the moment; both sinks take the journalled rows, so a retry at a later clock or with other
    subscribers changes nothing. Subscribers are read again for every batch. Campaigns are filtered
    before the join, so only the active ones meet the subscribers.
    """
    # A campaign is announced once; the earliest message wins.
    order = ["datetime_created", "adv_campaign_datetime_start", "adv_campaign_content"]

    def handle(batch: DataFrame, epoch_id: int) -> None:
        name = journal.batch(epoch_id)

        def decide() -> DataFrame:
            moment = now()
            active = cut_lineage(active_campaigns(batch, moment))
            rows = notifications(active, subscribers(), moment)
            return new_rows(feedback, cut_lineage(rows), NOTIFICATION_KEY, name, order)

        rows = journal.once(name, decide)
        if rows.isEmpty():
            return
        replace_batch(feedback, rows.withColumn("feedback", F.lit(None).cast("string")), name)
        write_messages(as_messages(rows), push, name)

    return handle


def start_campaigns(
    spark: SparkSession,
    source: Mapping[str, str],
    subscribers: Callable[[], DataFrame],
    feedback: Table,
    push: Mapping[str, str],
    checkpoint: str,
    stream: str = "campaigns",
    now: Callable[[], Column] = F.unix_timestamp,
    trigger: Mapping[str, object] | None = None,
):
    messages = read_messages(spark, source, schemas.SCHEMAS["campaign_message"])
    handler = campaign_handler(subscribers, feedback, push, Journal(spark, checkpoint, stream), now)
    return run_stream(messages, handler, checkpoint, trigger)
