"""Geo mart queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.catalog.registry import query
from martwright.catalog.views import view
from martwright.operators.workspace import scratch
from martwright.plans import geo as plan
from martwright.sources.readers import read_day_folders, read_days
from martwright.sources.writers import write_lake, write_run

# Test events span 30 days, so the 27-day stay is lowered to 5.
MIN_DAYS = 5
RUN_DATE = "2024-01-30"

_LOCATED = """
located AS (SELECT e.*, c.id, c.city FROM {v_social} e, {v_cities} c
  WHERE e.lat IS NOT NULL AND e.lon IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY e.event_id ORDER BY
    2 * 6371 * asin(sqrt(pow(sin(radians(c.city_lat - e.lat) / 2), 2)
      + cos(radians(e.lat)) * cos(radians(c.city_lat))
      * pow(sin(radians(c.city_lng - e.lon) / 2), 2))), c.id) = 1),
msg AS (SELECT * FROM located WHERE event_type = 'message' AND message_from IS NOT NULL)"""

_COLUMNS = (
    "event_id, date, event_ts, event_type, message_from, message_to, message_group, lat, lon, "
    "id, city"
)


def _located(spark, sf_dir, **options):
    return plan.events_with_city(
        view(spark, sf_dir, "v_social"), view(spark, sf_dir, "v_cities"), **options
    )


@query(
    "events_with_city",
    f"""WITH {_LOCATED} SELECT {_COLUMNS} FROM located
QUALIFY ROW_NUMBER() OVER (PARTITION BY lat, lon, date, event_type ORDER BY event_id) = 1""",
)
def events_with_city(spark, sf_dir):
    return _located(spark, sf_dir, semantics="reference")


@query("events_with_city_corrected", f"WITH {_LOCATED} SELECT {_COLUMNS} FROM located")
def events_with_city_corrected(spark, sf_dir):
    return _located(spark, sf_dir)


@query("events_with_city_grid", f"WITH {_LOCATED} SELECT {_COLUMNS} FROM located")
def events_with_city_grid(spark, sf_dir):
    """The way taken for place lists too large for literals."""
    return _located(spark, sf_dir, max_literals=0)


# Every city twice, the second time without an id; places of no known position; events likewise.
_DIRTY = f"""
WITH dirty AS (SELECT id, city, city_lat, city_lng FROM {{v_cities}}
  UNION ALL SELECT NULL, 'nameless', city_lat, city_lng FROM {{v_cities}}
  UNION ALL SELECT id, 'nowhere', CAST('NaN' AS DOUBLE), city_lng FROM {{v_cities}}
  UNION ALL SELECT id, 'nowhere', city_lat, NULL FROM {{v_cities}}),
odd AS (SELECT * REPLACE (CASE WHEN event_type = 'reaction' THEN CAST('NaN' AS DOUBLE) ELSE lat END
  AS lat) FROM {{v_social}})
SELECT e.event_id, e.lat, e.lon, c.id, c.city FROM odd e, dirty c
WHERE isfinite(e.lat) AND isfinite(e.lon) AND isfinite(c.city_lat) AND isfinite(c.city_lng)
QUALIFY ROW_NUMBER() OVER (PARTITION BY e.event_id ORDER BY
  2 * 6371 * asin(sqrt(pow(sin(radians(c.city_lat - e.lat) / 2), 2)
    + cos(radians(e.lat)) * cos(radians(c.city_lat))
    * pow(sin(radians(c.city_lng - e.lon) / 2), 2))), c.id NULLS LAST, c.city) = 1"""


def _dirty(spark, sf_dir, **options):
    cities = view(spark, sf_dir, "v_cities").select("id", "city", "city_lat", "city_lng")
    nan = F.lit(float("nan"))
    dirty = (
        cities.unionByName(cities.withColumns({"id": F.lit(None), "city": F.lit("nameless")}))
        .unionByName(cities.withColumns({"city": F.lit("nowhere"), "city_lat": nan}))
        .unionByName(cities.withColumns({"city": F.lit("nowhere"), "city_lng": F.lit(None)}))
    )
    odd = F.when(F.col("event_type") == "reaction", nan).otherwise(F.col("lat"))
    events = view(spark, sf_dir, "v_social").withColumn("lat", odd)
    placed = plan.events_with_city(events, dirty, **options)
    return placed.select("event_id", "lat", "lon", "id", "city")


@query("events_with_city_dirty_places", _DIRTY)
def events_with_city_dirty_places(spark, sf_dir):
    return _dirty(spark, sf_dir)


@query("events_with_city_dirty_places_grid", _DIRTY)
def events_with_city_dirty_places_grid(spark, sf_dir):
    return _dirty(spark, sf_dir, max_literals=0)


_ZONES = "CASE city " + " ".join(
    f"WHEN '{city}' THEN '{zone}'" for city, zone in plan.CITY_ZONES.items()
) + " END"

_ACT = f"""
act AS (SELECT message_from AS user_id, city AS act_city,
    (event_ts AT TIME ZONE 'UTC') AT TIME ZONE ({_ZONES}) AS local_time
  FROM msg QUALIFY ROW_NUMBER() OVER (PARTITION BY message_from
    ORDER BY event_ts DESC, event_id DESC) = 1)"""
_STEPS = """
flagged AS (SELECT message_from AS user_id, event_id, event_ts, date, city,
    CASE WHEN city = LAG(city) OVER (PARTITION BY message_from ORDER BY event_ts, event_id)
      THEN 0 ELSE 1 END AS changed FROM msg),
numbered AS (SELECT *, SUM(changed) OVER (PARTITION BY user_id ORDER BY event_ts, event_id
    ROWS UNBOUNDED PRECEDING) AS step FROM flagged)"""
_HOME = f"""
home AS (SELECT user_id, city AS home_city FROM (
    SELECT user_id, step, city, MAX(date) AS last_date FROM numbered
    GROUP BY user_id, step, city HAVING COUNT(DISTINCT date) >= {MIN_DAYS}) i
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY last_date DESC, step DESC) = 1)"""
_TRAVEL = """
travel AS (SELECT user_id, COUNT(*) AS travel_count,
    string_agg(city, '>' ORDER BY event_ts, event_id) AS travel_path
  FROM numbered {which} GROUP BY user_id)"""
_TRAVEL_ALL = _TRAVEL.replace("{which}", "")
_TRAVEL_STAYS = _TRAVEL.replace("{which}", "WHERE changed = 1")


def _as_path(travel):
    """The array as text, which both engines compare alike."""
    return travel.selectExpr(
        "* except (travel_array)", "array_join(travel_array, '>') AS travel_path"
    )


@query("users_act_city", f"WITH {_LOCATED}, {_ACT} SELECT user_id, act_city, local_time FROM act")
def users_act_city(spark, sf_dir):
    return plan.users_act_city(_located(spark, sf_dir))


@query(
    "users_travel_reference",
    f"WITH {_LOCATED}, {_STEPS}, {_TRAVEL_ALL} SELECT user_id, travel_count, travel_path FROM travel",
)
def users_travel_reference(spark, sf_dir):
    stays = plan.city_stays(_located(spark, sf_dir))
    return _as_path(plan.users_travel(stays, "reference"))


@query(
    "users_travel",
    f"WITH {_LOCATED}, {_STEPS}, {_TRAVEL_STAYS} "
    "SELECT user_id, travel_count, travel_path FROM travel",
)
def users_travel(spark, sf_dir):
    return _as_path(plan.users_travel(plan.city_stays(_located(spark, sf_dir))))


@query(
    "users_travel_steps",
    f"""WITH {_LOCATED}, {_STEPS} SELECT user_id, CAST(step AS BIGINT) AS step, city,
  COUNT(*) AS messages FROM numbered GROUP BY user_id, step, city""",
)
def users_travel_steps(spark, sf_dir):
    return plan.travel_steps(plan.city_stays(_located(spark, sf_dir)))


@query("users_home_city", f"WITH {_LOCATED}, {_STEPS}, {_HOME} SELECT user_id, home_city FROM home")
def users_home_city(spark, sf_dir):
    return plan.users_home_city(plan.city_stays(_located(spark, sf_dir)), MIN_DAYS)


_USERS = f"""WITH {_LOCATED}, {_ACT}, {_STEPS}, {_HOME}, {_TRAVEL_ALL}
SELECT a.user_id, a.act_city, a.local_time, h.home_city, t.travel_count, t.travel_path
FROM act a LEFT JOIN home h ON h.user_id = a.user_id LEFT JOIN travel t ON t.user_id = a.user_id"""


@query("users_mart", _USERS)
def users_mart(spark, sf_dir):
    return _as_path(plan.users_mart(_located(spark, sf_dir), "reference", MIN_DAYS))


_DATED = """
dated AS (SELECT *, id AS zone_id, CAST(EXTRACT(YEAR FROM date) AS INT) AS year,
  CAST(EXTRACT(MONTH FROM date) AS INT) AS month, CAST(EXTRACT(WEEK FROM date) AS INT) AS week
  FROM located)"""


def _counts(grain):
    return ", ".join(
        f"COUNT(*) FILTER (WHERE event_type = '{k}') AS {grain}_{k}_cnt"
        for k in ("message", "reaction", "subscription")
    )


_ZONES_MART = f"""
WITH {_LOCATED}, {_DATED},
w AS (SELECT zone_id, year, month, week, {_counts("week")} FROM dated GROUP BY 1, 2, 3, 4),
m AS (SELECT zone_id, year, month, {_counts("month")} FROM dated GROUP BY 1, 2, 3),
reg AS (SELECT * FROM dated WHERE message_from IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY message_from ORDER BY event_ts, event_id) = 1),
wr AS (SELECT zone_id, year, month, week, COUNT(*) AS week_reg_cnt FROM reg GROUP BY 1, 2, 3, 4),
mr AS (SELECT zone_id, year, month, COUNT(*) AS month_reg_cnt FROM reg GROUP BY 1, 2, 3)
SELECT w.*, m.month_message_cnt, m.month_reaction_cnt, m.month_subscription_cnt,
  wr.week_reg_cnt, CASE WHEN wr.week_reg_cnt IS NOT NULL THEN mr.month_reg_cnt END
    AS month_reg_cnt
FROM w JOIN m ON m.zone_id = w.zone_id AND m.year = w.year AND m.month = w.month
  LEFT JOIN wr ON wr.zone_id = w.zone_id AND wr.year = w.year AND wr.month = w.month
    AND wr.week = w.week
  LEFT JOIN mr ON mr.zone_id = w.zone_id AND mr.year = w.year AND mr.month = w.month"""


@query("zones_mart", _ZONES_MART)
def zones_mart(spark, sf_dir):
    return plan.zones_mart(_located(spark, sf_dir))


@query(
    "zones_validation",
    f"""
WITH z AS ({_ZONES_MART})
SELECT 'month_sum' AS "check", zone_id, year, month, CAST(NULL AS INT) AS week,
  CAST(SUM(week_message_cnt) AS BIGINT) AS found, MAX(month_message_cnt) AS expected
FROM z GROUP BY zone_id, year, month HAVING SUM(week_message_cnt) <> MAX(month_message_cnt)
UNION ALL SELECT 'registrations', zone_id, year, month, week, week_reg_cnt, week_message_cnt
FROM z WHERE week_reg_cnt > week_message_cnt""",
)
def zones_validation(spark, sf_dir):
    return plan.validate_zones(plan.zones_mart(_located(spark, sf_dir)))


# Every third week of a zone loses its messages to a faulty load, every fifth gains registrations.
_FAULTY = f"""SELECT zone_id, year, month, week, month_message_cnt,
  CASE WHEN (week + CAST(zone_id AS INT)) % 3 = 0 THEN 0 ELSE week_message_cnt END AS week_message_cnt,
  CASE WHEN (week + CAST(zone_id AS INT)) % 5 = 0 THEN week_reg_cnt + 1000000 ELSE week_reg_cnt END AS week_reg_cnt
FROM ({_ZONES_MART}) m"""


@query(
    "zones_validation_faulty",
    f"""
WITH z AS ({_FAULTY})
SELECT 'month_sum' AS "check", zone_id, year, month, CAST(NULL AS INT) AS week,
  CAST(SUM(week_message_cnt) AS BIGINT) AS found, MAX(month_message_cnt) AS expected
FROM z GROUP BY zone_id, year, month HAVING SUM(week_message_cnt) <> MAX(month_message_cnt)
UNION ALL SELECT 'registrations', zone_id, year, month, week, week_reg_cnt, week_message_cnt
FROM z WHERE week_reg_cnt > week_message_cnt""",
)
def zones_validation_faulty(spark, sf_dir):
    """The checks of the zones mart over a mart that breaks both rules."""
    turn = F.col("week") + F.col("zone_id").cast("int")
    mart = plan.zones_mart(_located(spark, sf_dir))
    faulty = mart.withColumn(
        "week_message_cnt", F.when(turn % 3 == 0, F.lit(0)).otherwise(F.col("week_message_cnt")).cast("bigint")
    ).withColumn("week_reg_cnt", F.col("week_reg_cnt") + F.when(turn % 5 == 0, 1000000).otherwise(0))
    return plan.validate_zones(faulty)


_FRIENDS = f"""
WITH {_LOCATED},
members AS (SELECT DISTINCT message_group, message_from FROM msg WHERE message_group IS NOT NULL),
place AS (SELECT message_from AS u, lat, lon, city FROM msg
  QUALIFY ROW_NUMBER() OVER (PARTITION BY message_from ORDER BY event_ts DESC, event_id DESC) = 1),
pairs AS (SELECT {{distinct}} a.message_from AS user_left, b.message_from AS user_right
  FROM members a JOIN members b ON a.message_group = b.message_group
    AND a.message_from < b.message_from)
SELECT p.user_left, p.user_right, l.city AS zone_id, DATE '{RUN_DATE}' AS processed_dttm
FROM pairs p JOIN place l ON l.u = p.user_left JOIN place r ON r.u = p.user_right
WHERE 2 * 6371 * asin(sqrt(pow(sin(radians(r.lat - l.lat) / 2), 2)
    + cos(radians(l.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - l.lon) / 2), 2))) <= 1
  AND NOT EXISTS (SELECT 1 FROM msg c WHERE (c.message_from = p.user_left
      AND c.message_to = p.user_right) OR (c.message_from = p.user_right
      AND c.message_to = p.user_left))"""


@query("friends_mart", _FRIENDS.replace("{distinct}", "DISTINCT"))
def friends_mart(spark, sf_dir):
    return plan.friends_mart(_located(spark, sf_dir), RUN_DATE).drop("local_time")


@query("friends_mart_reference", _FRIENDS.replace("{distinct}", ""))
def friends_mart_reference(spark, sf_dir):
    """Pairs once per shared channel, with hot channels split from the tenth member on."""
    located = _located(spark, sf_dir)
    return plan.friends_mart(located, RUN_DATE, "reference", hot_rows=10).drop("local_time")


# Four of five users write from one square of their city's centre, in one channel.
_CROWD = """
crowd AS (SELECT s.event_id, s.date, s.event_ts, s.event_type, s.message_from, s.message_to,
    CASE WHEN message_from % 5 < 4 THEN 1 ELSE message_group END AS message_group,
    CASE WHEN lat IS NULL THEN NULL WHEN message_from % 5 < 4
      THEN (SELECT MIN(city_lat) FROM {v_cities}) + message_from % 7 * CAST(0.001 AS DOUBLE) ELSE lat END AS lat,
    CASE WHEN lat IS NULL THEN NULL WHEN message_from % 5 < 4
      THEN (SELECT MIN(city_lng) FROM {v_cities}) + message_from % 3 * CAST(0.001 AS DOUBLE) ELSE lon END AS lon
  FROM {v_social} s)"""


@query(
    "friends_mart_crowded",
    _FRIENDS.replace("{distinct}", "DISTINCT")
    .replace("{v_social}", "crowd")
    .replace("WITH", f"WITH {_CROWD.strip()},", 1),
)
def friends_mart_crowded(spark, sf_dir):
    """One cell of one channel owns most members; its pairs are cut into cells of eight by eight."""
    events, cities = view(spark, sf_dir, "v_social"), view(spark, sf_dir, "v_cities")
    near = F.col("message_from") % 5 < 4
    corner = F.broadcast(cities.agg(F.min("city_lat").alias("south"), F.min("city_lng").alias("west")))
    step = F.lit(0.001)
    crowd = events.join(corner).withColumns(
        {
            "message_group": F.when(near, F.lit(1).cast("bigint")).otherwise(F.col("message_group")),
            "lon": F.when(F.col("lat").isNotNull() & near, F.col("west") + F.col("message_from") % 3 * step)
            .otherwise(F.col("lon")),
            "lat": F.when(F.col("lat").isNotNull() & near, F.col("south") + F.col("message_from") % 7 * step)
            .otherwise(F.col("lat")),
        }
    ).drop("south", "west")
    located = plan.events_with_city(crowd, cities)
    return plan.friends_mart(located, RUN_DATE, hot_rows=8).drop("local_time")


# -- lake folders -----------------------------------------------------------

_WINDOW = f"""WITH {_LOCATED} SELECT event_id, date, event_type, city FROM located
WHERE date BETWEEN DATE '2024-01-16' AND DATE '{RUN_DATE}'"""


def _lake(spark, sf_dir):
    path = scratch(spark, "events_with_city")
    write_lake(_located(spark, sf_dir), path, ["date", "event_type"])
    return path


@query("lake_day_window", _WINDOW)
def lake_day_window(spark, sf_dir):
    """Located events written to the lake; the last 15 days read by predicate."""
    rows = read_days(spark, _lake(spark, sf_dir), RUN_DATE, 15)
    return rows.select("event_id", "date", "event_type", "city")


@query("lake_day_folders", _WINDOW)
def lake_day_folders(spark, sf_dir):
    """The same window through explicit folders."""
    rows = read_day_folders(spark, _lake(spark, sf_dir), RUN_DATE, 15)
    return rows.select("event_id", "date", "event_type", "city")


@query("run_folder_overwrite", _ZONES_MART)
def run_folder_overwrite(spark, sf_dir):
    """A mart written to its run folder twice and read back."""
    path = scratch(spark, "zones_mart")
    mart = plan.zones_mart(_located(spark, sf_dir))
    write_run(mart, path, RUN_DATE)
    write_run(mart, path, RUN_DATE)
    return spark.read.parquet(f"{path}/date={RUN_DATE}")
