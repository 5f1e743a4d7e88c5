import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martwright import schemas
from martwright.operators.state import WorkflowState, audited, days_before, greatest_mark
from martwright.operators.tables import Table
from martwright.operators.workspace import scratch, shared_folder

DDL = "k INT, v STRING, n BIGINT"


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), DDL)


def _frame(spark, *values):
    return spark.createDataFrame(list(values), DDL)


def test_upsert_updates_and_inserts(spark, table, rows):
    table.upsert(_frame(spark, (1, "a", 1), (2, "b", 1)), ["k"])
    table.upsert(_frame(spark, (2, "c", 5), (3, "d", 1)), ["k"])
    assert rows(table.read()) == [(1, "a", 1), (2, "c", 5), (3, "d", 1)]


def test_upsert_twice_changes_nothing(spark, table, rows):
    frame = _frame(spark, (1, "a", 1), (2, "b", 1))
    table.upsert(frame, ["k"])
    before = rows(table.read())
    table.upsert(frame, ["k"])
    assert rows(table.read()) == before


def test_upsert_reduces_several_rows_of_a_key(spark, table, rows):
    table.upsert(_frame(spark, (1, "a", 1), (1, "b", 3), (1, "c", 2)), ["k"], order=["n"])
    assert rows(table.read()) == [(1, "b", 3)]


def test_upsert_with_expressions_accumulates(spark, table, rows):
    update = {"n": F.col("t.n") + F.col("s.n")}
    for _ in range(3):
        table.upsert(_frame(spark, (1, "a", 2)), ["k"], update=update)
    assert rows(table.read()) == [(1, "a", 6)]


def test_upsert_keeps_and_extends_surrogates(spark, tmp_path):
    table = Table(spark, str(tmp_path / "d"), "id BIGINT, name STRING, v INT")
    names = lambda *pairs: spark.createDataFrame(list(pairs), "name STRING, v INT")
    table.upsert(names(("a", 1), ("b", 1)), ["name"], id_col="id")
    first = {r["name"]: r["id"] for r in table.read().collect()}
    table.upsert(names(("b", 2), ("c", 1)), ["name"], id_col="id")
    second = {r["name"]: (r["id"], r["v"]) for r in table.read().collect()}
    assert sorted(first.values()) == [1, 2]
    assert second == {"a": (first["a"], 1), "b": (first["b"], 2), "c": (3, 1)}


def test_partitioned_upsert_leaves_other_partitions_alone(spark, tmp_path, rows):
    table = Table(spark, str(tmp_path / "p"), "k INT, v STRING, p STRING", ["p"])
    make = lambda *v: spark.createDataFrame(list(v), "k INT, v STRING, p STRING")
    table.upsert(make((1, "a", "x"), (2, "b", "y")), ["k", "p"])
    untouched = tmp_path / "p" / "v=000001" / "p=x"
    files = sorted(os.listdir(untouched))
    table.upsert(make((2, "c", "y"), (3, "d", "z")), ["k", "p"])
    assert rows(table.read()) == [(1, "a", "x"), (2, "c", "y"), (3, "d", "z")]
    assert sorted(os.listdir(untouched)) == files
    assert table.versions() == [1]


def test_insert_if_new_keeps_existing(spark, table, rows):
    table.insert_if_new(_frame(spark, (1, "a", 1)), ["k"])
    table.insert_if_new(_frame(spark, (1, "z", 9), (2, "c", 2), (2, "b", 1)), ["k"], order=["n"])
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 1)]


def test_refresh_replaces_and_vacuum_trims(spark, table, rows):
    for n in range(4):
        table.refresh(_frame(spark, (n, "a", n)))
    assert rows(table.read()) == [(3, "a", 3)]
    table.vacuum(keep=2)
    assert table.versions() == [3, 4]


def test_unfinished_version_is_ignored(spark, table, rows):
    table.refresh(_frame(spark, (1, "a", 1)))
    _frame(spark, (2, "b", 2)).write.parquet(table.location(2))
    os.remove(f"{table.location(2)}/_SUCCESS")
    assert rows(table.read()) == [(1, "a", 1)]
    table.refresh(_frame(spark, (3, "c", 3)))
    assert rows(table.read()) == [(3, "c", 3)]


def test_slices_replace_only_their_days(spark, tmp_path, rows):
    table = Table(spark, str(tmp_path / "s"), "day INT, v STRING", ["day"])
    make = lambda *v: spark.createDataFrame(list(v), "day INT, v STRING")
    table.overwrite_slices(make((1, "a"), (2, "b")))
    table.overwrite_slices(make((2, "c"), (2, "d")))
    table.overwrite_slices(make((2, "c"), (2, "d")))
    assert rows(table.read()) == [(1, "a"), (2, "c"), (2, "d")]


def test_high_water_mark(spark, tmp_path):
    state = WorkflowState(spark, str(tmp_path / "state"))
    assert state.high_water("w") == "1900-01-01 00:00:00"
    state.advance("w", "2024-01-02 00:00:00", 5)
    state.advance("w", "2023-01-01 00:00:00", 1)
    state.advance("other", None)
    assert state.high_water("w") == "2024-01-02 00:00:00"
    assert state.get("w")["num_loaded"] == 1
    assert days_before(dt.datetime(2024, 1, 8)) == "2024-01-01 00:00:00"


def test_greatest_mark_skips_nulls(spark):
    frame = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), None)], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ"
    )
    assert greatest_mark(frame, "a", "b") == "2024-01-01 00:00:00.9"
    assert greatest_mark(frame.limit(0), "a", "b") is None


def test_audit_logs_success_and_error(spark, tmp_path):
    path = str(tmp_path / "log")
    day = dt.datetime(2024, 1, 1)
    assert audited(spark, path, "stg", "a", day, lambda: 7) == 7
    with pytest.raises(ZeroDivisionError):
        audited(spark, path, "stg", "b", day, lambda: 1 // 0)
    log = Table(spark, path, schemas.SCHEMAS["load_log"]).read()
    found = {r["table_name"]: (r["status"], r["rows_loaded"]) for r in log.collect()}
    assert found == {"a": ("SUCCESS", 7), "b": ("ERROR", 0)}


def test_conform_fills_defaults(spark):
    frame = spark.createDataFrame([("x", 1)], "uniq_id STRING, city_id INT")
    row = schemas.conform(frame, "user_order_log").first()
    assert (row["status"], row["item_id"], row["city_id"]) == ("shipped", None, 1)


def test_every_schema_parses(spark):
    for name in schemas.SCHEMAS:
        assert len(schemas.SCHEMAS[name].fields) > 0


def test_create_table(spark):
    schemas.create_table(spark, "f_sales", "t_create_f_sales", replace=True)
    frame = spark.table("t_create_f_sales")
    assert frame.schema["payment_amount"].dataType.simpleString() == "decimal(10,2)"
    spark.sql("DROP TABLE t_create_f_sales")


def test_scratch_is_below_the_configured_folder(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_repeated_null_keys_do_not_double(spark, table, rows):
    frame = _frame(spark, (None, "a", 1), (2, "b", 1))
    for _ in range(3):
        table.upsert(frame, ["k"])
    assert rows(table.read()) == [(2, "b", 1), (None, "a", 1)]


def test_null_keys_are_not_inserted(spark, table, rows):
    for _ in range(3):
        table.insert_if_new(_frame(spark, (None, "a", 1), (2, "b", 1)), ["k"])
    assert rows(table.read()) == [(2, "b", 1)]


def test_an_empty_delta_writes_nothing(spark, table):
    table.upsert(_frame(spark, (1, "a", 1)), ["k"])
    before = table.versions()
    table.upsert(_frame(spark, (1, "a", 1)).limit(0), ["k"])
    assert table.versions() == before


def test_days_outside_the_calendar_and_emptied_days(spark, tmp_path):
    from martwright.plans import sales

    columns = [f.name for f in schemas.SCHEMAS["f_sales"].fields]
    fact = Table(spark, str(tmp_path / "f"), schemas.SCHEMAS["f_sales"], partition_by=["date_id"])
    calendar = spark.createDataFrame([(20240101, dt.date(2024, 1, 1))], "date_id INT, date_actual DATE")
    staged = spark.createDataFrame(
        [(dt.datetime(2025, 1, d), 1, 1, 1, 1, 5.0, "shipped") for d in (1, 2)],
        "date_time TIMESTAMP_NTZ, item_id INT, customer_id INT, city_id INT, quantity INT, payment_amount DOUBLE, status STRING",
    )
    assert "date_id" in columns
    sales.load_sales(staged, calendar, fact, "2025-01-01")
    sales.load_sales(staged, calendar, fact, "2025-01-02")
    assert fact.read().count() == 2
    sales.load_sales(staged.limit(0), calendar, fact, "2025-01-02")
    assert [r.date_id for r in fact.read().collect()] == [20250101]
