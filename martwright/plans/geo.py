"""Geo marts over social events: nearest city, users, zones and friend suggestions.

Events carry ``event_id``, ``event_ts`` (UTC, without zone), ``date``,
``event_type``, ``message_from``, ``message_to``, ``message_group``, ``lat`` and
``lon``; :func:`flatten_events` brings the nested layout into this form.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright import schemas
from martwright.functions import local_time, minute, parse_timestamp
from martwright.operators.islands import islands
from martwright.operators.pick import earliest_by, latest_by
from martwright.operators.quality import QualityError
from martwright.operators.skew import HOT_ROWS
from martwright.operators.spatial import nearest, pairs_within
from martwright.operators.workspace import cut_lineage

# Time zone of each city.
CITY_ZONES = {
    "Sydney": "Australia/Sydney",
    "Melbourne": "Australia/Melbourne",
    "Brisbane": "Australia/Brisbane",
    "Perth": "Australia/Perth",
    "Adelaide": "Australia/Adelaide",
    "Gold Coast": "Australia/Brisbane",
    "Cranbourne": "Australia/Melbourne",
    "Canberra": "Australia/Sydney",
    "Newcastle": "Australia/Sydney",
    "Wollongong": "Australia/Sydney",
    "Geelong": "Australia/Melbourne",
    "Hobart": "Australia/Hobart",
    "Townsville": "Australia/Brisbane",
    "Ipswich": "Australia/Brisbane",
    "Cairns": "Australia/Brisbane",
    "Toowoomba": "Australia/Brisbane",
    "Darwin": "Australia/Darwin",
    "Ballarat": "Australia/Melbourne",
    "Bendigo": "Australia/Melbourne",
    "Launceston": "Australia/Hobart",
    "Mackay": "Australia/Brisbane",
    "Rockhampton": "Australia/Brisbane",
    "Maitland": "Australia/Sydney",
    "Bunbury": "Australia/Perth",
}
HOME_DAYS = 27
FRIEND_KM = 1.0


def flatten_events(events: DataFrame) -> DataFrame:
    """Flat events from the nested layout.

    The event time is ``datetime`` or, where that is empty, ``message_ts``. The
    layout has no id, so a hash of the event's content stands in for one.
    """
    content = ["event", "lat", "lon", "date", "event_type"]
    return events.select(
        F.xxhash64(*content).alias("event_id"),
        F.coalesce(
            parse_timestamp(F.col("event.datetime")), parse_timestamp(F.col("event.message_ts"))
        ).alias("event_ts"),
        "date",
        "event_type",
        F.col("event.message_from").alias("message_from"),
        F.col("event.message_to").alias("message_to"),
        F.col("event.message_group").alias("message_group"),
        "lat",
        "lon",
    )


def events_with_city(
    events: DataFrame, cities: DataFrame, semantics: str = "corrected", **limits
) -> DataFrame:
    """Events with coordinates, each with the ``id`` and name of its nearest city.

    ``reference`` keeps one event per coordinate, day and type (the one with the
    smallest id); ``corrected`` keeps them all and needs no shuffle.
    """
    placed = nearest(events, cities, ["id", "city"], **limits)
    if semantics == "reference":
        return earliest_by(placed, ["lat", "lon", "date", "event_type"], ["event_id"])
    return placed


def _messages(events: DataFrame) -> DataFrame:
    return events.where((F.col("event_type") == "message") & F.col("message_from").isNotNull())


# -- users ------------------------------------------------------------------


def users_act_city(events: DataFrame) -> DataFrame:
    """City of each user's last message and its time on the local clock."""
    last = latest_by(
        _messages(events).select("message_from", "city", "event_ts", "event_id"),
        ["message_from"],
        ["event_ts", "event_id"],
    )
    zones = F.create_map(*[F.lit(v) for v in chain.from_iterable(CITY_ZONES.items())])
    # try_element_at: a city without a known zone has no local time.
    zone = F.try_element_at(zones, F.col("city"))
    return last.select(
        F.col("message_from").alias("user_id"),
        F.col("city").alias("act_city"),
        local_time(F.col("event_ts"), zone).alias("local_time"),
    )


def city_stays(events: DataFrame) -> DataFrame:
    """Pieces of uninterrupted stays of each user in a city, in message order."""
    rows = _messages(events).select(
        F.col("message_from").alias("user_id"), "city", "event_ts", "event_id"
    )
    return islands(
        rows, ["user_id"], ["event_ts", "event_id"], "city", minute(F.col("event_ts"))
    )


def travel_steps(stays: DataFrame) -> DataFrame:
    """Stays in order, one row each: user, step, city and number of messages."""
    return stays.groupBy("user_id", F.col("island_id").alias("step"), "city").agg(
        F.sum("n_rows").alias("messages")
    )


def users_travel(stays: DataFrame, semantics: str = "corrected") -> DataFrame:
    """Cities in the order of a user's messages, as an array with its length.

    ``reference`` lists a city once per message, ``corrected`` once per stay.
    Only stays are collected per user; repeats are expanded inside the row. Use
    :func:`travel_steps` where a user's path is too long for one cell.
    """
    steps = travel_steps(stays)
    path = F.array_sort(F.collect_list(F.struct("step", "city", "messages")))
    grouped = steps.groupBy("user_id").agg(
        path.alias("_path"),
        F.count(F.lit(1)).alias("_stays"),
        F.sum("messages").alias("_messages"),
    )
    if semantics == "reference":
        cities = F.flatten(
            F.transform("_path", lambda s: F.array_repeat(s["city"], s["messages"].cast("int")))
        )
        count = F.col("_messages")
    else:
        cities = F.transform("_path", lambda s: s["city"])
        count = F.col("_stays")
    return grouped.select(
        "user_id", count.cast("bigint").alias("travel_count"), cities.alias("travel_array")
    )


def users_home_city(stays: DataFrame, min_days: int = HOME_DAYS) -> DataFrame:
    """City of the last stay with messages on at least ``min_days`` different days."""
    days = stays.select(
        "user_id", "island_id", "city", F.substring("_slice", 1, 10).cast("date").alias("day")
    )
    long_stays = (
        days.groupBy("user_id", "island_id", "city")
        .agg(F.countDistinct("day").alias("days_count"), F.max("day").alias("last_date"))
        .where(F.col("days_count") >= min_days)
    )
    return latest_by(
        long_stays.select("user_id", "city", "last_date", "island_id"),
        ["user_id"],
        ["last_date", "island_id"],
    ).select("user_id", F.col("city").alias("home_city"))


def users_mart(
    events: DataFrame, semantics: str = "corrected", min_days: int = HOME_DAYS
) -> DataFrame:
    """Current city, local time, home city and travel history per user.

    Home city and travel both read the stays, so these are written out once.
    """
    stays = cut_lineage(city_stays(events))
    mart = (
        users_act_city(events)
        .join(users_home_city(stays, min_days), "user_id", "left")
        .join(users_travel(stays, semantics), "user_id", "left")
    )
    return schemas.conform(mart, "users_mart")


# -- zones ------------------------------------------------------------------

_KINDS = ("message", "reaction", "subscription")


def zones_mart(events: DataFrame) -> DataFrame:
    """Event and registration counts per zone, week and month.

    A registration is a user's first event. Months are summed from the weekly
    rows, so the events are aggregated once.
    """
    week = ["zone_id", "year", "month", "week"]
    month = week[:3]
    calendar = {
        "year": F.year("date"),
        "month": F.month("date"),
        "week": F.weekofyear("date"),
    }
    dated = events.withColumnRenamed("id", "zone_id").withColumns(calendar)
    weekly = dated.groupBy(*week).agg(
        *[
            F.count(F.when(F.col("event_type") == kind, 1)).alias(f"week_{kind}_cnt")
            for kind in _KINDS
        ]
    )
    monthly = weekly.groupBy(*month).agg(
        *[F.sum(f"week_{kind}_cnt").alias(f"month_{kind}_cnt") for kind in _KINDS]
    )
    first = earliest_by(
        events.where(F.col("message_from").isNotNull()).select(
            "message_from", F.col("id").alias("zone_id"), "date", "event_ts", "event_id"
        ),
        ["message_from"],
        ["event_ts", "event_id"],
    ).withColumns(calendar)
    week_reg = first.groupBy(*week).agg(F.count(F.lit(1)).alias("week_reg_cnt"))
    month_reg = week_reg.groupBy(*month).agg(F.sum("week_reg_cnt").alias("month_reg_cnt"))
    mart = weekly.join(monthly, month).join(
        week_reg.join(month_reg, month), week, "left"
    )
    return schemas.conform(mart, "zones_mart")


def validate_zones(mart: DataFrame) -> DataFrame:
    """Anomalies of the zones mart, one row each; NULL keys raise.

    ``month_sum``: the weekly messages of a month do not add up to its total.
    ``registrations``: a week has more registrations than messages.
    """
    keys = ["zone_id", "year", "month", "week"]
    broken = mart.where(" OR ".join(f"{k} IS NULL" for k in keys)).count()
    if broken:
        raise QualityError(f"zones_mart: {broken} rows with a NULL key")
    sums = (
        mart.groupBy("zone_id", "year", "month")
        .agg(F.sum("week_message_cnt").alias("found"), F.max("month_message_cnt").alias("expected"))
        .where("found != expected")
        .select(
            F.lit("month_sum").alias("check"),
            "zone_id", "year", "month", F.lit(None).cast("int").alias("week"), "found", "expected",
        )
    )
    registrations = mart.where("week_reg_cnt > week_message_cnt").select(
        F.lit("registrations").alias("check"),
        *keys,
        F.col("week_reg_cnt").alias("found"),
        F.col("week_message_cnt").alias("expected"),
    )
    return sums.unionByName(registrations)


# -- friends ----------------------------------------------------------------


def _contacts(messages: DataFrame) -> DataFrame:
    """Rows (user_id, known): contact in either direction, told by the one of the two with fewer contacts.

    With e contacts in all no list is longer than the root of 2 e, whoever is written to by everyone.
    """
    met = cut_lineage(
        messages.where(F.col("message_to").isNotNull())
        .select(F.least("message_from", "message_to").alias("a"), F.greatest("message_from", "message_to").alias("b"))
        .distinct()
    )
    degrees = met.select(F.explode(F.array("a", "b")).alias("user")).groupBy("user").count()
    first, second = (degrees.toDF(side, f"{side}_n") for side in ("a", "b"))
    fewer = F.col("a_n") <= F.col("b_n")
    return (
        met.join(first.hint("merge"), "a")
        .join(second.hint("merge"), "b")
        .select(F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("user_id"),
                F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("other"))
        .groupBy("user_id")
        .agg(F.collect_list("other").alias("known"))
    )


def friends_mart(
    events: DataFrame,
    date: str,
    semantics: str = "corrected",
    radius_km: float = FRIEND_KM,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Users of one channel who never wrote to each other and are within ``radius_km``.

    ``corrected`` gives each pair once; ``reference`` once per shared channel.

    Pairs may outnumber the members by far, so none is shuffled: members carry their zone, their
    contacts and their earlier channels into the join, which tells all that a pair needs.
    """
    # Read for channels, places and contacts: the nearest city is searched once.
    messages = cut_lineage(
        _messages(events).select(
            "message_from", "message_to", "message_group", "lat", "lon", "city", "event_ts", "event_id"
        )
    )
    members = (
        messages.where(F.col("message_group").isNotNull())
        .select(F.col("message_group").alias("group_id"), F.col("message_from").alias("user_id"))
        .distinct()
    )
    places = latest_by(
        messages.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
            F.col("message_from").alias("user_id"), "lat", "lon", "city", "event_ts", "event_id"
        ),
        ["user_id"],
        ["event_ts", "event_id"],
    ).select("user_id", "lat", "lon", F.col("city").alias("zone_id"))
    # Sizes of what follows are estimated from files that compress well: no side is broadcast.
    people = (
        places.join(members.groupBy("user_id").agg(F.collect_list("group_id").alias("groups")).hint("merge"), "user_id")
        .join(_contacts(messages).hint("merge"), "user_id", "left")
        .withColumn("group_id", F.explode("groups"))
        .withColumn("known", F.coalesce("known", F.array().cast("array<bigint>")))
    )
    # The channels before this one, by which a pair is left to the first channel it shares.
    before = F.filter("groups", lambda g: g < F.col("group_id"))
    if semantics == "reference":
        before = F.array().cast("array<bigint>")
    located = cut_lineage(people.withColumn("before", before).drop("groups"))
    named = located.withColumns(
        {f"{c}_{side}": F.col(c) for side in ("left", "right") for c in ("known", "before")}
    ).drop("known", "before")
    pairs = pairs_within(
        named, "group_id", "user_id", "lat", "lon", radius_km, hot_rows,
        ["known_left", "before_left", "zone_id"], ["known_right", "before_right"],
    )
    mart = (
        pairs.where(~F.arrays_overlap("before_left", "before_right"))
        .where(~F.array_contains("known_left", F.col("right")) & ~F.array_contains("known_right", F.col("left")))
        .withColumnsRenamed({"left": "user_left", "right": "user_right"})
        .withColumn("processed_dttm", F.lit(date).cast("date"))
        .withColumn("local_time", F.current_timestamp())
    )
    return schemas.conform(mart, "friends_mart")
