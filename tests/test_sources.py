import datetime as dt

import pytest
from pyspark.sql import types as T

from martwright.operators.tables import Table
from martwright.sources import readers, writers

LOG = "group_id BIGINT, user_id BIGINT, user_id_from BIGINT, event STRING, datetime TIMESTAMP_NTZ"


def _log(tmp_path, bad, good=3):
    lines = ["group_id,user_id,user_id_from,event,datetime"]
    lines += [f"{i},5,,add,2024-01-01 10:00:00" for i in range(good)]
    lines += [f"x{i},5,6,add,2024-01-01 10:00:00" for i in range(bad)]
    path = tmp_path / f"log{bad}.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_rejects_up_to_the_limit(spark, tmp_path):
    schema = T.StructType.fromDDL(LOG)
    good, rejected = readers.read_delimited(spark, _log(tmp_path, 100), schema, reject_max=100)
    assert (good.count(), rejected.count()) == (3, 100)
    assert good.first()["user_id_from"] is None
    with pytest.raises(readers.RejectLimitError, match="101"):
        readers.read_delimited(spark, _log(tmp_path, 101), schema, reject_max=100)
    unlimited, rejected = readers.read_delimited(spark, _log(tmp_path, 150), schema)
    assert (unlimited.count(), rejected.count()) == (3, 150)


def test_short_rows_are_rejected_and_quotes_kept(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('id,text\n1,"a, b"\n2\n3,"c"\n')
    good, rejected = readers.read_delimited(
        spark, str(path), T.StructType.fromDDL("id BIGINT, text STRING"))
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a, b"), (3, "c")]
    assert [r[0] for r in rejected.collect()] == ["2"]


def test_city_list_with_carriage_returns(spark, tmp_path):
    path = tmp_path / "geo.csv"
    path.write_bytes(b"id;city;lat;lng\r1;Sydney;-33,865;151,2094\r2;Perth;-31,9522;115,8589")
    found = sorted(tuple(r) for r in readers.read_cities(spark, str(path)).collect())
    assert found == [("1", "Sydney", -33.865, 151.2094), ("2", "Perth", -31.9522, 115.8589)]


def test_increment_is_deduplicated_and_completed(spark):
    raw = spark.createDataFrame(
        [(1, "a", 2), (2, "a", 1), (3, "b", 3)], "id INT, uniq_id STRING, n INT")
    ready = readers.prepare_increment(raw, defaults={"status": "shipped", "n": 0})
    assert sorted(tuple(r) for r in ready.collect()) == [("a", 1, "shipped"), ("b", 3, "shipped")]


def test_day_windows(spark, tmp_path):
    path = str(tmp_path / "lake")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 5)]
    frame = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date DATE, n INT")
    writers.write_lake(frame, path, ["date"])
    found = readers.read_days(spark, path, "2024-01-05", 4)
    assert sorted(r["n"] for r in found.collect()) == [1, 2, 3]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date" in scan
    whole = readers.read_day_folders(spark, path, "2024-01-03", 3)
    assert sorted(r["n"] for r in whole.collect()) == [0, 1, 2]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_day_folders(spark, path, "2024-01-05", 2)


def test_lake_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "lake")
    make = lambda *v: spark.createDataFrame(list(v), "n INT, date STRING")
    writers.write_lake(make((1, "a"), (2, "b")), path, ["date"])
    writers.write_lake(make((3, "b")), path, ["date"])
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_null_marker_roundtrip(spark, tmp_path):
    path = str(tmp_path / "export")
    frame = spark.createDataFrame([(1, None), (2, "x"), (3, "")], "n INT, t STRING")
    writers.write_delimited(frame, path)
    assert sorted(spark.read.text(path).collect()) == [("1|\\N",), ('2|x',), ('3|""',)]


def test_documents(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text('{"_id": "c1", "name": "Ann"}\n{"_id": "c2", "name": "Bob"}\n')
    found = readers.read_documents(spark, str(path), "_id", T.StructType.fromDDL("_id STRING"))
    assert sorted(r["object_id"] for r in found.collect()) == ["c1", "c2"]


def test_connector_seam_uses_the_named_format(spark, tmp_path):
    path = str(tmp_path / "rows")
    writers.write_rows(spark.range(3), {"format": "json", "path": path})
    found = readers.read_table(spark, {"format": "json", "path": path})
    assert found.count() == 3


def test_day_extract_reaches_the_scan_as_a_range(spark, tmp_path):
    from martwright.plans.finance import day_of

    path = str(tmp_path / "tx")
    frame = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23),), (dt.datetime(2024, 1, 2, 0),)], "t TIMESTAMP_NTZ")
    frame.write.parquet(path)
    found = day_of(spark.read.parquet(path), "t", "2024-01-01")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan


PAIR = T.StructType().add("id", "long").add("a", "string").add("b", "string")


def test_columns_go_by_the_names_in_each_file(spark, tmp_path):
    folder = tmp_path / "in put"
    folder.mkdir()
    (folder / "1.csv").write_text("id,a,b\n1,x,y\n")
    (folder / "2.csv").write_text('﻿B,"A",ID\ny,x,2\n')
    (folder / "3.csv").write_text("\nextra,b,id\n7,y,3\nshort\n8,9,oops\n")
    (folder / "4.csv").write_text("")
    good, rejected = readers.read_delimited(spark, str(folder), PAIR)
    assert sorted(tuple(r) for r in good.collect()) == [(1, "x", "y"), (2, "x", "y"), (3, None, "y")]
    assert sorted(r[0] for r in rejected.collect()) == ["8,9,oops", "short"]
    assert [len(files) for _, files in sorted(readers.layouts(spark, str(folder)).items())] == [1, 1, 1]


def test_headers_that_fit_nothing_fail(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,x,y\n2,x,y\n")
    with pytest.raises(ValueError, match="no column"):
        readers.read_delimited(spark, str(tmp_path / "x.csv"), PAIR)
    (tmp_path / "y.csv").write_text("id,a,A\n2,x,y\n")
    with pytest.raises(ValueError, match="twice"):
        readers.read_delimited(spark, str(tmp_path / "y.csv"), PAIR)
    (tmp_path / "z.csv").write_text("")
    good, rejected = readers.read_delimited(spark, str(tmp_path / "z.csv"), PAIR)
    assert good.columns == PAIR.names and good.count() == rejected.count() == 0


def test_rejects_are_kept_when_the_load_fails(spark, tmp_path):
    kept = Table(spark, str(tmp_path / "rejects"), readers.REJECTS)
    path = _log(tmp_path, 3)
    with pytest.raises(readers.RejectLimitError):
        readers.read_delimited(spark, path, T.StructType.fromDDL(LOG), reject_max=2, rejects=kept)
    assert {(r["path"], r["rejected"][0]) for r in kept.read().collect()} == {(path, "x")}
    assert kept.read().count() == 3


def test_increments_are_staged_once(spark, tmp_path):
    folder = tmp_path / "increment"
    folder.mkdir()
    (folder / "1.csv").write_text("id,uniq_id,n\n1,a,5\n2,a,5\n3,b,6\n")
    staging = Table(spark, str(tmp_path / "staged"), "uniq_id STRING, n INT, status STRING")
    readers.load_increment(spark, str(folder), staging, defaults={"status": "shipped"})
    (folder / "2.csv").write_text("status,N,uniq_id\nrefunded,7,c\n,8,a\n")
    for _ in range(2):
        readers.load_increment(spark, str(folder), staging, defaults={"status": "shipped"})
    found = sorted(tuple(r) for r in staging.read().collect())
    assert found == [("a", 5, "shipped"), ("b", 6, "shipped"), ("c", 7, "refunded")]
