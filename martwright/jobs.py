"""Command line of the geo batch chain, for ``spark-submit``.

    jobs.py events-with-city DATE DEPTH EVENTS_PATH CITIES_CSV OUTPUT_PATH
    jobs.py users-mart       DATE DEPTH STAGING_PATH OUTPUT_PATH
    jobs.py zones-mart       DATE DEPTH STAGING_PATH OUTPUT_PATH
    jobs.py friends-mart     DATE DEPTH STAGING_PATH OUTPUT_PATH
    jobs.py validate-zones   MART_PATH
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from martwright import session
from martwright.plans import geo
from martwright.sources.readers import read_cities, read_days
from martwright.sources.writers import write_lake, write_run


def events_with_city(
    spark: SparkSession,
    date: str,
    depth: int,
    events_path: str,
    cities_path: str,
    output_path: str,
    semantics: str = "corrected",
) -> None:
    """Raw events of the window -> staging, partitioned by date and event type."""
    events = geo.flatten_events(read_days(spark, events_path, date, depth))
    located = geo.events_with_city(events, read_cities(spark, cities_path), semantics)
    write_lake(located, output_path, ["date", "event_type"])


def users_mart(
    spark: SparkSession,
    date: str,
    depth: int,
    staging_path: str,
    output_path: str,
    semantics: str = "corrected",
) -> None:
    staged = read_days(spark, staging_path, date, depth)
    write_run(geo.users_mart(staged, semantics), output_path, date)


def zones_mart(
    spark: SparkSession, date: str, depth: int, staging_path: str, output_path: str
) -> None:
    write_run(geo.zones_mart(read_days(spark, staging_path, date, depth)), output_path, date)


def friends_mart(
    spark: SparkSession,
    date: str,
    depth: int,
    staging_path: str,
    output_path: str,
    semantics: str = "corrected",
) -> None:
    staged = read_days(spark, staging_path, date, depth)
    write_run(geo.friends_mart(staged, date, semantics), output_path, date)


def validate_zones(spark: SparkSession, mart_path: str, samples: int = 20) -> DataFrame:
    """Print a warning with samples per failed check; NULL keys raise."""
    anomalies = geo.validate_zones(spark.read.parquet(mart_path))
    found = {row["check"]: row["count"] for row in anomalies.groupBy("check").count().collect()}
    for check in ("month_sum", "registrations"):
        if check in found:
            print(f"[WARN] {check}: {found[check]}")
            anomalies.where(anomalies["check"] == check).show(samples, truncate=False)
        else:
            print(f"[OK] {check}")
    return anomalies


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    windowed = {
        "events-with-city": (events_with_city, ["events_path", "cities_path", "output_path"]),
        "users-mart": (users_mart, ["staging_path", "output_path"]),
        "zones-mart": (zones_mart, ["staging_path", "output_path"]),
        "friends-mart": (friends_mart, ["staging_path", "output_path"]),
    }
    for name, (run, paths) in windowed.items():
        command = commands.add_parser(name)
        command.add_argument("date")
        command.add_argument("depth", type=int)
        for path in paths:
            command.add_argument(path)
        if run is not zones_mart:
            command.add_argument(
                "--semantics", choices=["corrected", "reference"], default="corrected"
            )
        command.set_defaults(run=run)
    command = commands.add_parser("validate-zones")
    command.add_argument("mart_path")
    command.set_defaults(run=validate_zones)
    options = vars(parser.parse_args(arguments))
    run, name = options.pop("run"), options.pop("command")
    run(spark or session.build(name), **options)


if __name__ == "__main__":
    main()
