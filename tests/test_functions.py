import datetime as dt
import math
import random
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from martwright import functions as fn


def test_uuid5_equals_python(spark):
    names = ["u1", "пример", "a" * 300, "", "x y|z"]
    frame = spark.createDataFrame([(n, n[::-1]) for n in names], "a STRING, b STRING")
    for a, one, two in frame.select("a", fn.uuid5(F.col("a")), fn.uuid5(F.col("a"), F.col("b"))).collect():
        assert one == str(uuid.uuid5(uuid.NAMESPACE_X500, a))
        assert two == str(uuid.uuid5(uuid.NAMESPACE_X500, a + a[::-1]))


def test_uuid5_of_numbers_and_null(spark):
    frame = spark.createDataFrame([(7,), (None,)], "a BIGINT")
    keys = [r[0] for r in frame.select(fn.uuid5(F.col("a"))).collect()]
    assert keys == [str(uuid.uuid5(uuid.NAMESPACE_X500, "7")), None]


def test_hash_key_needs_all_parts(spark):
    frame = spark.createDataFrame([(1, 2), (1, None)], "a INT, b INT")
    keys = [r[0] for r in frame.select(fn.hash_key(F.col("a"), F.col("b"))).collect()]
    assert keys[0] is not None and keys[1] is None


def test_year_week_counts_from_january_first(spark):
    days = ["2021-01-01", "2021-01-07", "2021-01-08", "2020-12-31", "2021-12-31"]
    frame = spark.createDataFrame([(d,) for d in days], "d STRING")
    found = [r[0] for r in frame.select(fn.year_week(F.col("d").cast("date"))).collect()]
    assert found == [202101, 202101, 202102, 202053, 202153]


def test_year_month(spark):
    frame = spark.createDataFrame([(dt.date(2021, 3, 9),)], "d DATE")
    assert frame.select(fn.year_month(F.col("d"))).first()[0] == "2021-03"


def test_parse_timestamp_with_and_without_fraction(spark):
    frame = spark.createDataFrame(
        [("2024-01-02 03:04:05",), ("2024-01-02 03:04:05.678",), ("tomorrow",)], "t STRING"
    )
    found = [r[0] for r in frame.select(fn.parse_timestamp(F.col("t"))).collect()]
    assert found == [
        dt.datetime(2024, 1, 2, 3, 4, 5),
        dt.datetime(2024, 1, 2, 3, 4, 5, 678000),
        None,
    ]


def test_decimal_comma(spark):
    frame = spark.createDataFrame([("-33,865",), ("151",), ("n/a",)], "t STRING")
    found = [r[0] for r in frame.select(fn.decimal_comma(F.col("t"))).collect()]
    assert found == [-33.865, 151.0, None]


def test_number_text(spark):
    texts = ["2700", "112946.2", "1.23456785E7", "1.0E7", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t STRING")
    found = [r[0] for r in frame.select(fn.number_text(F.col("t"))).collect()]
    assert found == ["2700", "112946.2", "12345678.5", "10000000.0", None]


def test_ratio_rounds_half_up_and_skips_zero(spark):
    frame = spark.createDataFrame([(201, 200), (1, 0), (None, 2)], "a BIGINT, b BIGINT")
    found = [r[0] for r in frame.select(fn.ratio(F.col("a"), F.col("b"))).collect()]
    assert found == [Decimal("1.01"), None, None]


def test_local_time_follows_daylight_saving(spark):
    frame = spark.createDataFrame(
        [("2024-01-15 10:00:00", "Australia/Sydney"), ("2024-07-15 10:00:00", "Australia/Sydney")],
        "t STRING, z STRING",
    )
    found = [r[0] for r in frame.select(fn.local_time(F.col("t"), F.col("z"))).collect()]
    assert found == [dt.datetime(2024, 1, 15, 21), dt.datetime(2024, 7, 15, 20)]


def _haversine(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = (
        math.sin((q - p) / 2) ** 2
        + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    )
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


def test_haversine(spark):
    rng = random.Random(1)
    points = [tuple(rng.uniform(-90, 90) if i % 2 == 0 else rng.uniform(-180, 180) for i in range(4))
              for _ in range(200)] + [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)]
    frame = spark.createDataFrame(points, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    found = frame.select("*", fn.haversine(*[F.col(c) for c in "abcd"]).alias("km")).collect()
    for a, b, c, d, km in found:
        assert abs(km - _haversine(a, b, c, d)) < 1e-6


def test_uuid5_makes_each_digest_once(spark):
    nested = str(fn.uuid5(fn.uuid5(F.col("a")), F.col("b")))
    assert nested.count("sha1") == 2
