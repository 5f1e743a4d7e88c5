import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.functions import haversine
from martwright.operators import pick
from martwright.operators.islands import islands
from martwright.operators.quality import (
    QualityError,
    Rule,
    check_constraints,
    enforce,
    in_range,
    max_length,
    not_null,
)
from martwright.operators.skew import hot_key_join
from martwright.operators.spatial import nearest, pairs_within
from martwright.operators.surrogate import with_surrogate


def test_latest_and_earliest(spark, rows):
    frame = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d")], "k INT, t INT, v STRING"
    )
    assert rows(pick.latest_by(frame, ["k"], ["t", "v"])) == [(1, 7, "c"), (2, None, "d")]
    assert rows(pick.earliest_by(frame, ["k"], ["t", "v"])) == [(1, 5, "a"), (2, None, "d")]


def test_dedupe_without_other_columns(spark, rows):
    frame = spark.createDataFrame([(1,), (1,), (2,)], "k INT")
    assert rows(pick.dedupe(frame, ["k"])) == [(1,), (2,)]


def test_leaders_keep_ties(spark, rows):
    frame = spark.createDataFrame([(1, "a", 3), (1, "b", 3), (1, "c", 1)], "k INT, v STRING, n INT")
    assert rows(pick.leaders(frame, ["k"], "n"), "v") == [("a",), ("b",)]


@pytest.mark.parametrize("values", [[], [1, 2, None], [*range(50), 7, None, None], [1, 1, 2, 2, None, None]])
def test_distinct_rows(spark, rows, values):
    frame = spark.createDataFrame([(v, None if v is None else str(v)) for v in values], "a INT, b STRING")
    assert rows(pick.distinct_rows(frame.repartition(3))) == rows(frame.distinct())


def test_global_dense_rank(spark, rows):
    frame = spark.createDataFrame([("a", 5), ("b", 5), ("c", 2), ("d", None)], "k STRING, n INT")
    ranked = pick.global_dense_rank(frame, "n", "r")
    assert rows(ranked, "k", "r") == [("a", 1), ("b", 1), ("c", 2), ("d", 3)]


@pytest.mark.parametrize("values", [
    [None, None], [], [7.0] * 900 + [3.0, None], [float("nan"), float("inf"), -0.0, 0.0, None],
    [float(i % 701) for i in range(3000)] + [None] * 5,
])
def test_global_dense_rank_equals_one_window(spark, rows, values):
    frame = spark.createDataFrame(list(enumerate(values)), "k INT, n DOUBLE").repartition(5)
    ranked = pick.global_dense_rank(frame, "n", "r", "bigint")
    window = Window.orderBy(F.col("n").desc_nulls_last())
    want = frame.withColumn("r", F.dense_rank().over(window).cast("bigint"))
    assert rows(ranked, "k", "r") == rows(want, "k", "r")
    assert ranked.schema["r"].dataType.simpleString() == "bigint"


def test_global_dense_rank_keeps_values_apart(spark):
    """With many values there are several ranges, and no window sees more than one of them."""
    frame = spark.range(200000).selectExpr("id", "id * 7 % 200003 AS n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = pick.global_dense_rank(frame, "n", "r")
        greatest = frame.agg(F.max("n")).first()[0]
        assert ranked.agg(F.min("r"), F.max("r"), F.countDistinct("r")).first() == (1, 200000, 200000)
        assert ranked.where(F.col("r") == 1).first()["n"] == greatest
        order = ranked.orderBy("r").select("n").toPandas()["n"]
        assert order.is_monotonic_decreasing
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(
    "values, expected",
    [([1], [(2,)]), ([1, None], []), ([], [(1,), (2,), (None,)])],
)
def test_sql_not_in(spark, rows, values, expected):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a INT")
    right = spark.createDataFrame([(v,) for v in values], "b INT")
    assert rows(pick.sql_not_in(left, "a", right, "b")) == expected


def test_surrogate_digests_are_not_shuffled(spark, rows):
    """rows are dealt by the bucket of their digest, which does not travel; the numbers follow it as before."""
    frame = spark.range(500).selectExpr("IF(id = 7, NULL, id) AS k", "id AS v").repartition(3)
    numbered = with_surrogate(frame, "sk", ["k"], start=10)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [line for line in plan if "_digest" in line]
    dealt = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert below and all(plan.index(line) < dealt for line in below)
    digest = F.sha1(F.coalesce(F.col("k").cast("string"), F.lit("")))
    want = frame.withColumn("sk", F.row_number().over(Window.orderBy(digest, "k")).cast("bigint") + 10)
    assert rows(numbered, "v", "sk") == rows(want, "v", "sk")


def test_surrogates_are_dense_and_stable(spark):
    frame = spark.range(5000).withColumn("name", F.concat(F.lit("n"), F.col("id"))).drop("id")
    first = {r["name"]: r["sk"] for r in with_surrogate(frame, "sk", ["name"], 10).collect()}
    shuffled = frame.repartition(7)
    second = {r["name"]: r["sk"] for r in with_surrogate(shuffled, "sk", ["name"], 10).collect()}
    assert first == second
    assert sorted(first.values()) == list(range(11, 5011))


def test_surrogate_of_keys_sharing_a_bucket(spark):
    frame = spark.range(300).withColumnRenamed("id", "k")
    numbered = with_surrogate(frame, "sk", ["k"], bucket_digits=1)
    assert sorted(r["sk"] for r in numbered.collect()) == list(range(1, 301))


def test_hot_key_join_is_the_plain_join(spark, rows):
    left = spark.range(400).select(
        F.when(F.col("id") < 300, 1).otherwise(F.col("id") % 5).alias("k"), F.col("id").alias("a")
    )
    right = spark.range(60).select((F.col("id") % 6).alias("k"), F.col("id").alias("b"))
    plain = rows(left.join(right, "k"), "k", "a", "b")
    assert rows(hot_key_join(left, right, ["k"], hot_rows=20), "k", "a", "b") == plain


def _points(seed, n, lat, lon, spread):
    rng = random.Random(seed)
    return [
        (rng.randrange(3), i, lat + rng.uniform(-spread, spread), lon + rng.uniform(-spread, spread))
        for i in range(n)
    ]


@pytest.mark.parametrize(
    "lat, lon, radius",
    [(-33.86, 151.2, 1.0), (0.0, 179.99, 1.0), (89.99, 10.0, 1.0), (-89.995, -170.0, 2.5),
     (51.0, 0.0, 40.0)],
)
def test_pairs_within_equals_brute_force(spark, rows, lat, lon, radius):
    spread = 0.04 if radius < 10 else 1.5
    wrap = [
        (g, i, max(-90.0, min(90.0, a)), (b + 180) % 360 - 180)
        for g, i, a, b in _points(7, 150, lat, lon, spread)
    ]
    frame = spark.createDataFrame(wrap, "g INT, u BIGINT, lat DOUBLE, lon DOUBLE")
    other = frame.toDF("g", "u2", "lat2", "lon2")
    brute = frame.join(other, "g").where("u < u2").where(
        haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) <= radius
    )
    expected = rows(brute, "g", "u", "u2")
    found = pairs_within(frame, "g", "u", "lat", "lon", radius, hot_rows=15)
    assert expected and rows(found, "g", "left", "right") == expected


@pytest.mark.parametrize("radius", [0.001, 1.0, 500.0, 20015.0, 30000.0])
def test_chords_decide_as_the_haversine_does(spark, rows, radius):
    """Pairs at the radius to the last bit, equal points and antipodes; chords leave only the closest to the haversine."""
    from martwright.functions.geo import unit_vector
    from martwright.operators.spatial import _chord_limits

    places = [(0.0, 0.0), (-37.8136, 144.9631), (89.9999, 10.0), (-90.0, 0.0), (45.0, 180.0)]
    step = math.degrees(radius / 6371.0)
    near = [(lat + step * (1 + d), lon) for lat, lon in places for d in (0, 1e-15, -1e-15, 1e-12, -1e-12, 1e-6, -1e-6)]
    points = [*places, *places, *((-lat, lon - 180) for lat, lon in places), *[(a, b) for a, b in near if abs(a) <= 90]]
    frame = spark.createDataFrame([(1, i, *p) for i, p in enumerate(points)], "g int, u int, lat double, lon double")
    a, b = (frame.select(*[F.col(c).alias(f"{c}{side}") for c in ("u", "lat", "lon")]) for side in (1, 2))
    distance = haversine(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    vectors = zip(unit_vector(F.col("lat1"), F.col("lon1")), unit_vector(F.col("lat2"), F.col("lon2")), strict=True)
    chord = sum((x - y) * (x - y) for x, y in vectors)
    both = a.join(b, F.col("u1") < F.col("u2")).select("u1", "u2", (distance <= radius).alias("near"), chord.alias("c")).collect()
    inside, outside = _chord_limits(radius)
    assert all(r.near for r in both if r.c <= inside) and not any(r.near for r in both if r.c > outside)
    found = pairs_within(frame, "g", "u", "lat", "lon", radius, hot_rows=10)
    assert rows(found, "left", "right") == sorted(((r.u1, r.u2) for r in both if r.near), key=lambda r: tuple((False, str(v)) for v in r))


def test_pairs_within_skips_missing_coordinates(spark, rows):
    frame = spark.createDataFrame(
        [(1, 1, 0.0, 0.0), (1, 2, None, 0.0), (1, 3, 0.0, 0.001)],
        "g INT, u BIGINT, lat DOUBLE, lon DOUBLE",
    )
    assert rows(pairs_within(frame, "g", "u", "lat", "lon", 1.0), "left", "right") == [(1, 3)]


@pytest.mark.parametrize("max_literals", [0, 256])
def test_nearest_equals_brute_force(spark, rows, max_literals):
    rng = random.Random(3)
    spot = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180))
    points = [(i, *spot()) for i in range(120)] + [(200, None, 1.0)]
    places = [(f"c{i:02d}", *spot()) for i in range(25)]
    events = spark.createDataFrame(points, "e INT, lat DOUBLE, lon DOUBLE")
    cities = spark.createDataFrame(places, "id STRING, city_lat DOUBLE, city_lng DOUBLE")
    km = haversine(F.col("lat"), F.col("lon"), F.col("city_lat"), F.col("city_lng"))
    brute = (
        events.where("lat IS NOT NULL").crossJoin(cities).withColumn("km", km)
        .groupBy("e").agg(F.min_by("id", "km").alias("id"))
    )
    found = nearest(events, cities, ["id"], max_literals=max_literals)
    assert rows(found, "e", "id") == rows(brute, "e", "id")


def test_nearest_breaks_ties_by_first_column(spark, rows):
    events = spark.createDataFrame([(1, 0.0, 0.0)], "e INT, lat DOUBLE, lon DOUBLE")
    cities = spark.createDataFrame(
        [("b", 0.0, 1.0), ("a", 0.0, -1.0)], "id STRING, city_lat DOUBLE, city_lng DOUBLE"
    )
    for limit in (0, 256):
        assert rows(nearest(events, cities, ["id"], max_literals=limit), "id") == [("a",)]


@pytest.mark.parametrize("max_literals", [0, 256])
def test_nearest_of_dirty_places(spark, rows, max_literals):
    nan, inf = float("nan"), float("inf")
    points = [(1, 0.0, 0.0), (2, nan, 0.0), (3, 0.0, inf), (4, None, 0.0), (5, 89.999, 10.0), (6, -90.0, 77.0)]
    places = [(None, "x", 0.0, 1.0), ("b", "z", 0.0, -1.0), ("b", "y", 0.0, -1.0), ("a", "n", nan, 0.0),
              ("a", "i", 0.0, -inf), ("a", "u", None, 0.0), ("p", None, 90.0, 0.0), ("p", "pole", 90.0, -120.0)]
    events = spark.createDataFrame(points, "e INT, lat DOUBLE, lon DOUBLE")
    cities = spark.createDataFrame(places, "id STRING, city STRING, city_lat DOUBLE, city_lng DOUBLE")
    found = nearest(events, cities, ["id", "city"], max_literals=max_literals)
    near = {r.e: (r.id, r.city) for r in found.collect()}
    assert near[1] == ("b", "y") and near[5][0] == "p" and set(near) == {1, 5, 6}


def test_both_ways_to_the_nearest_place_agree_on_every_tie(spark, rows):
    # On a lattice many places are equally far up to rounding; labels come in no order.
    rng = random.Random(9)
    lattice = [(lat, lon) for lat in range(-90, 91, 15) for lon in range(-180, 181, 30)]
    places = [(rng.choice([None, "a", "b", "c"]), f"n{rng.randrange(9)}", float(a), float(b)) for a, b in lattice]
    points = [(i, float(a) + 7.5, float(b) + 15) for i, (a, b) in enumerate(lattice)]
    events = spark.createDataFrame(points, "e INT, lat DOUBLE, lon DOUBLE").where("lat <= 90")
    cities = spark.createDataFrame(places, "id STRING, city STRING, city_lat DOUBLE, city_lng DOUBLE")
    ways = [nearest(events, cities, ["id", "city"], max_literals=n) for n in (0, 256)]
    assert rows(ways[0]) == rows(ways[1])


def _runs(events):
    """Brute-force islands: (user, island, city, messages)."""
    found = []
    for user, group in itertools.groupby(sorted(events), key=lambda e: e[0]):
        number = 0
        for city, run in itertools.groupby(list(group), key=lambda e: e[3]):
            number += 1
            found.append((user, number, city, len(list(run))))
    return sorted(found)


@pytest.mark.parametrize("minutes", [1, 15, 600])
def test_islands_equal_brute_force(spark, minutes):
    rng = random.Random(minutes)
    start = dt.datetime(2024, 1, 1)
    events = [
        (rng.randrange(4), start + dt.timedelta(minutes=rng.randrange(minutes)), i,
         rng.choice("AB"))
        for i in range(300)
    ]
    frame = spark.createDataFrame(events, "u INT, ts TIMESTAMP_NTZ, id INT, city STRING")
    slices = F.substring(F.col("ts").cast("string"), 1, 16)
    pieces = islands(frame, ["u"], ["ts", "id"], "city", slices)
    whole = pieces.groupBy("u", "island_id", "city").agg(F.sum("n_rows").alias("n"))
    assert sorted(tuple(r) for r in whole.collect()) == _runs(events)


def test_constraints(spark, rows):
    parent = spark.createDataFrame([(1,), (2,)], "id INT")
    frame = spark.createDataFrame(
        [(1, 1, 5, "ab"), (1, 3, 9, "abcd"), (None, None, None, None)],
        "k INT, fk INT, n INT, s STRING",
    )
    rules = [
        *not_null("k"),
        in_range("n", 1, 6),
        max_length("s", 3),
        Rule("k_unique", unique=("k",)),
        Rule("fk_known", foreign=("fk", parent, "id"), severity="WARN"),
    ]
    report = check_constraints(frame, rules)
    assert rows(report) == sorted([
        ("fk_known", "WARN", 1), ("k_not_null", "FAIL", 1), ("k_unique", "FAIL", 1),
        ("n_check", "FAIL", 1), ("s_length", "FAIL", 1),
    ])
    with pytest.raises(QualityError, match="k_unique: 1"):
        enforce(report)
    enforce(report.where("severity = 'WARN'"))


def test_blocks_bound_both_sides_of_a_hot_key(spark):
    from martwright.operators.skew import blocks, hot_key_join

    left = spark.range(9000).selectExpr("CASE WHEN id < 6000 THEN NULL WHEN id < 8900 THEN 1 ELSE id END AS k", "id AS l")
    right = spark.range(5000).selectExpr("CASE WHEN id < 3000 THEN 1 ELSE id + 5000 END AS k", "id AS r")
    rows, cols = blocks(left, right, ["k"], 500)
    for side, most in ((rows, 700), (cols, 700)):
        sizes = side.where("k IS NOT NULL").groupBy("k", "_row", "_col").count()
        assert sizes.agg({"count": "max"}).first()[0] <= most
    # 2900 rows by 3000: six strips each way.
    assert rows.where("k = 1").select("_row", "_col").distinct().count() == 36
    found = hot_key_join(left, right, ["k"], 500)
    plain = left.join(right, "k")
    total = lambda df: df.selectExpr("count(*)", "bit_xor(xxhash64(k, l, r))", "sum(l * 7 + r)").first()
    assert total(found) == total(plain)
    assert found.count() == found.distinct().count()


def test_a_hot_key_is_not_copied_with_its_size(spark):
    """A key of n rows cut by eight once made n / 8 copies of each of its rows."""
    from martwright.operators.skew import blocks

    side = spark.range(4000).selectExpr("1 AS k", "id")
    rows, cols = blocks(side, side, ["k"], 8)
    assert rows.count() <= 8 * 4000 and cols.count() <= 8 * 4000
    assert rows.select("_row", "_col").distinct().count() > 1
