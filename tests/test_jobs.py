import datetime as dt

import pytest

from martwright import jobs


@pytest.fixture
def lake(spark, tmp_path):
    """Nested raw events, partitioned by date and type, and a city list."""
    day = dt.date(2024, 1, 15)
    events = []
    for i in range(6):
        when = day - dt.timedelta(days=i % 3)
        events.append((
            (i % 2 + 1, None, 7, f"{when} 10:00:0{i}", None),
            -33.865 + (i % 2) * 0.001, 151.2094, when, "message",
        ))
    events.append(((3, None, None, f"{day} 09:00:00", None), -31.95, 115.86, day, "reaction"))
    frame = spark.createDataFrame(
        events,
        "event STRUCT<message_from: BIGINT, message_to: BIGINT, message_group: BIGINT, "
        "datetime: STRING, message_ts: STRING>, lat DOUBLE, lon DOUBLE, date DATE, "
        "event_type STRING",
    )
    frame.write.partitionBy("date", "event_type").parquet(str(tmp_path / "events"))
    (tmp_path / "geo.csv").write_bytes(
        b"id;city;lat;lng\r1;Sydney;-33,865;151,2094\r4;Perth;-31,9522;115,8589")
    return tmp_path


def test_geo_chain(spark, lake, capsys):
    run = lambda *a: jobs.main([str(x) for x in a], spark=spark)
    staging, marts = lake / "staging", lake / "marts"
    for _ in range(2):  # every step may be repeated
        run("events-with-city", "2024-01-15", 3, lake / "events", lake / "geo.csv", staging)
        run("users-mart", "2024-01-15", 3, staging, marts / "users")
        run("zones-mart", "2024-01-15", 3, staging, marts / "zones")
        run("friends-mart", "2024-01-15", 3, staging, marts / "friends")
    assert spark.read.parquet(str(staging)).count() == 7
    users = {r["user_id"]: r for r in spark.read.parquet(str(marts / "users")).collect()}
    assert sorted(users) == [1, 2] and users[1]["act_city"] == "Sydney"
    assert users[1]["travel_array"] == ["Sydney"] and users[1]["home_city"] is None
    zones = spark.read.parquet(str(marts / "zones"))
    # the 14th is a Sunday, the 15th opens a new week
    found = sorted((r["zone_id"], r["week"]) for r in zones.collect())
    assert found == [("1", 2), ("1", 3), ("4", 3)]
    friends = spark.read.parquet(str(marts / "friends" / "date=2024-01-15")).collect()
    assert [(r["user_left"], r["user_right"], r["zone_id"]) for r in friends] == [(1, 2, "Sydney")]
    run("validate-zones", marts / "zones" / "date=2024-01-15")
    out = capsys.readouterr().out
    # the reaction in Perth is a first event without a message
    assert "[OK] month_sum" in out and "[WARN] registrations: 1" in out


def test_reference_semantics_are_an_option(spark, lake):
    jobs.main(
        ["events-with-city", "2024-01-15", "3", str(lake / "events"), str(lake / "geo.csv"),
         str(lake / "s"), "--semantics", "reference"], spark=spark)
    # users 1 and 2 stand at one spot each: one event per spot, day and type is left
    assert spark.read.parquet(str(lake / "s")).count() == 7
