import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import schemas
from martwright.catalog import courier_queries
from martwright.operators import workspace
from martwright.operators.quality import QualityError, check_constraints
from martwright.operators.tables import Table
from martwright.plans import couriers, customer_report, finance, geo, group_vault, sales


def D(text):
    return Decimal(text)


def day(text):
    return dt.date.fromisoformat(text)


# -- customer report --------------------------------------------------------


@pytest.fixture(scope="module")
def star_parts(spark):
    old = dt.datetime(2020, 1, 1)
    facts = [
        # order, product, craftsman, customer, created, completed, status
        (1, 1, 10, 1, day("2024-01-01"), day("2024-01-05"), "done"),
        (2, 2, 10, 1, day("2024-01-02"), day("2024-01-04"), "done"),
        (3, 3, 20, 1, day("2024-01-03"), None, "created"),
        (4, 3, 20, 1, day("2024-01-09"), day("2024-01-12"), "delivery"),
        (5, 1, 30, 1, day("2024-02-01"), None, "in progress"),
        (6, 1, 10, 2, day("2024-01-01"), None, "created"),
    ]
    f_order = spark.createDataFrame(
        [(*f, old) for f in facts],
        "order_id BIGINT, product_id BIGINT, craftsman_id BIGINT, customer_id BIGINT, "
        "order_created_date DATE, order_completion_date DATE, order_status STRING, "
        "load_dttm TIMESTAMP_NTZ",
    )
    craft = spark.createDataFrame([(i, old) for i in (10, 20, 30)],
                                  "craftsman_id BIGINT, load_dttm TIMESTAMP_NTZ")
    customer = spark.createDataFrame(
        [(i, f"c{i}", "addr", day("1990-01-01"), "mail", old) for i in (1, 2)],
        "customer_id BIGINT, customer_name STRING, customer_address STRING, "
        "customer_birthday DATE, customer_email STRING, load_dttm TIMESTAMP_NTZ",
    )
    product = spark.createDataFrame(
        [(1, "zinc", D("10.00"), old), (2, "art", D("20.00"), old), (3, "art", D("5.00"), old)],
        "product_id BIGINT, product_type STRING, product_price DECIMAL(18,2), "
        "load_dttm TIMESTAMP_NTZ",
    )
    return f_order, craft, customer, product


@pytest.fixture(scope="module")
def star(star_parts):
    return customer_report.order_star(*star_parts)


def test_report_month_values(star, star_parts):
    row = (
        customer_report.customer_report(star, star_parts[2])
        .where("customer_id = 1 AND report_period = '2024-01'").first()
    )
    assert (row["customer_costs"], row["platform_money"]) == (D("40.00"), D("4.00"))
    assert (row["total_order_count"], row["avg_order_price"]) == (4, D("10.00"))
    # days 4, 2, 3; the open order has none
    assert row["median_time_order_completed"] == D("3.0")
    assert row["top_craftsman_id"] == 10  # tied with 20, the smaller wins
    assert row["top_product_category"] == "art"
    counts = [row[f"count_order_{s}"] for s in
              ("created", "in_progress", "delivery", "done", "not_done")]
    assert counts == [1, 0, 1, 2, 2]


def test_unified_sources_shuffle_no_whole_row_to_be_distinct(spark, rows):
    """one row is in all four layouts, one in two, others in one; the result is read without a shuffle."""
    def make(i):
        days = (day("2024-01-01"), None)
        return (i, *days, "done", i % 3, f"m{i % 3}", None, None, "m", i, f"p{i}", "d", "t", D("1.00"), 5, "c", "a", None, "e")

    types = {"order_id": "BIGINT", "craftsman_id": "BIGINT", "product_id": "BIGINT", "customer_id": "BIGINT",
             "product_price": "DECIMAL(18,2)"}
    kind = lambda c: types.get(c, "DATE" if "_date" in c or "birthday" in c else "STRING")
    ddl = ", ".join(f"{c} {kind(c)}" for c in customer_report.WIDE_COLUMNS)
    frame = lambda *ids: spark.createDataFrame([make(i) for i in ids], ddl)
    part = lambda rows, *names: rows.select(
        *[c for c in rows.columns if c in names or c.split("_")[0] in names])
    a, b, c, d = frame(*range(60), 3), frame(3, 100), frame(3, 4, 200), frame(3, 300)
    unified = customer_report.unify_sources(
        a,
        part(b, "craftsman", "product").distinct(), part(b, "order", "product_id", "craftsman_id", "customer"),
        part(c, "order", "product", "craftsman_id", "customer_id"),
        part(c, "craftsman").distinct(), part(c, "customer").distinct(),
        part(d, "order", "craftsman", "product", "customer_id"), part(d, "customer").distinct(),
    )
    assert rows(unified) == rows(frame(*range(60), 100, 200, 300))
    assert "Exchange" not in unified._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rank", [customer_report.craftsman_rank, customer_report.craftsman_money_rank])
def test_pairs_are_ranked_in_tasks_of_bounded_rows(spark, star_parts, rows, monkeypatch, rank):
    """lines, pairs and values are dealt to tasks by their number, whatever few bytes they take."""
    facts = star_parts[0].select(*[c for c in star_parts[0].columns if c != "craftsman_id"]).crossJoin(
        spark.range(40).select((F.col("id") * 10).alias("craftsman_id"))
    )
    craft = spark.range(40).select((F.col("id") * 10).alias("craftsman_id"), F.lit(None).cast("timestamp_ntz").alias("load_dttm"))
    star = customer_report.order_star(facts, craft, *star_parts[2:])
    want = rows(rank(star))
    kind = type(star)
    dealt, plain = [], kind.repartition
    monkeypatch.setattr(workspace, "TASK_ROWS", 30)
    monkeypatch.setattr(kind, "repartition", lambda self, *by: dealt.append(by[0]) or plain(self, *by))
    assert rows(rank(star)) == want
    assert dealt == [8, 3]  # 240 lines, 80 pairs


def test_report_reference_keeps_ties_and_ranks_category_by_name(star, star_parts, rows):
    report = customer_report.customer_report(star, star_parts[2], "reference")
    january = report.where("customer_id = 1 AND report_period = '2024-01'")
    assert rows(january, "top_craftsman_id", "top_product_category") == [(10, "zinc"), (20, "zinc")]
    assert report.where("customer_id = 1").count() == 4


def report_mart(spark, path):
    return Table(spark, str(path), schemas.SCHEMAS["customer_report_datamart"], ["report_period"])


def as_sides(f_order, craft, customer, product):
    return {"f_order": f_order, "d_craftsman": craft, "d_customer": customer, "d_product": product}


def test_report_incremental_rebuilds_touched_months(spark, star_parts, tmp_path, rows):
    f_order, craft, customer, product = star_parts
    mart = report_mart(spark, tmp_path / "mart")
    marks = customer_report.refresh_customer_report(mart, as_sides(*star_parts), {})
    late = dt.datetime(2024, 3, 1)
    more = spark.createDataFrame(
        [(7, 3, 20, 1, day("2024-01-20"), None, "created", late),
         (8, 1, 30, 1, day("2024-03-01"), None, "created", late)], f_order.schema,
    )
    parts = f_order.unionByName(more), craft, customer, product
    star = customer_report.order_star(*parts)
    marks = customer_report.refresh_customer_report(mart, as_sides(*parts), marks)
    want = schemas.conform(
        customer_report.customer_report(star, customer), "customer_report_datamart"
    )
    assert rows(mart.read()) == rows(want.select(*mart.read().columns))
    january = mart.read().where("customer_id = 1 AND report_period = '2024-01'").first()
    assert (january["total_order_count"], january["top_craftsman_id"]) == (5, 20)
    assert marks["f_order"] == "2024-03-01 00:00:00"


def monthly_fact(spark, path, f_order):
    schema = T.StructType([*f_order.schema.fields, T.StructField("report_month", T.DateType())])
    return Table(spark, str(path), schema, ["report_month"])


def restamped(dim, key, value, moment, **columns):
    """One member of a dimension changed by a later load."""
    hit = F.col(key) == value
    new = {"load_dttm": F.lit(moment).cast("timestamp_ntz"), **columns}
    return dim.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()})


def test_report_follows_a_change_of_any_side(spark, star_parts, tmp_path, rows):
    f_order, craft, customer, product = star_parts
    mart = report_mart(spark, tmp_path / "mart")
    marks = customer_report.refresh_customer_report(mart, as_sides(*star_parts), {})
    # The product's load is older than the customer's: each side has a mark of its own.
    customer = restamped(customer, "customer_id", 2, "2024-05-01", customer_name=F.lit("new"))
    marks = customer_report.refresh_customer_report(
        mart, as_sides(f_order, craft, customer, product), marks
    )
    product = restamped(
        product, "product_id", 2, "2024-04-01", product_price=F.lit("30.00").cast("decimal(18,2)")
    )
    parts = f_order, craft, customer, product
    marks = customer_report.refresh_customer_report(mart, as_sides(*parts), marks)
    want = customer_report.customer_report(customer_report.order_star(*parts), customer)
    assert rows(mart.read()) == rows(want.select(*mart.read().columns))
    assert mart.read().where("customer_name = 'new'").count() > 0
    assert marks["d_customer"] == "2024-05-01 00:00:00"
    assert marks["d_product"] == "2024-04-01 00:00:00"


def test_touched_months_are_those_of_the_changes(spark, star_parts, rows):
    f_order, craft, customer, product = star_parts
    sides = as_sides(*star_parts)
    marks = customer_report.newest_loads(sides)
    assert customer_report.touched_months(sides, marks, marks) is None
    craft = restamped(craft, "craftsman_id", 30, "2024-05-01")
    sides = as_sides(f_order, craft, customer, product)
    found = customer_report.touched_months(sides, marks, customer_report.newest_loads(sides))
    of_craftsman = f_order.where("craftsman_id = 30").select(
        "customer_id", F.trunc("order_created_date", "month").alias("report_month")
    )
    assert rows(found) == rows(of_craftsman.distinct())


def test_rows_that_land_during_a_refresh_are_found_by_the_next(spark, star_parts, tmp_path, rows):
    f_order, craft, customer, product = star_parts
    fact = monthly_fact(spark, tmp_path / "fact", f_order)
    month = F.trunc("order_created_date", "month")
    fact.append(f_order.withColumn("report_month", month))
    mart = report_mart(spark, tmp_path / "mart")
    sides = as_sides(fact.read(), craft, customer, product)
    late = spark.createDataFrame(
        [(9, 1, 10, 2, day("2024-02-02"), None, "created", dt.datetime(2024, 6, 1))],
        f_order.schema,
    )
    # Landed after the sides were read and before the refresh has ended.
    fact.append(late.withColumn("report_month", month))
    marks = customer_report.refresh_customer_report(mart, sides, {})
    assert marks["f_order"] < "2024-06-01"
    sides = as_sides(fact.read(), craft, customer, product)
    marks = customer_report.refresh_customer_report(mart, sides, marks)
    star = customer_report.order_star(fact.read(), craft, customer, product)
    want = customer_report.customer_report(star, customer)
    assert rows(mart.read()) == rows(want.select(*mart.read().columns))


def test_refresh_reads_the_touched_partitions_only(spark, star_parts, tmp_path):
    f_order, craft, customer, product = star_parts
    fact = monthly_fact(spark, tmp_path / "fact", f_order)
    fact.append(f_order.withColumn("report_month", F.trunc("order_created_date", "month")))
    sides = as_sides(fact.read(), craft, customer, product)
    touched = spark.createDataFrame([(1, day("2024-01-01"))], "customer_id BIGINT, report_month DATE")
    star = customer_report.touched_star(sides, touched)
    plan = star._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("report_month" in f.split("PartitionFilters:")[1].split("]")[0] for f in filters)
    assert star.count() == 4


def test_months_are_counted_after_one_shuffle_of_lines(spark):
    star = spark.range(50).selectExpr(
        "id % 7 AS customer_id", "date_add(DATE'2024-01-01', int(id % 5)) AS report_month", "id AS order_id", "id % 3 AS craftsman_id",
        "'art' AS product_type", "1.00BD AS product_price", "1 AS diff_order_date", "'done' AS order_status",
    )
    plan = customer_report._months_corrected(star)._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange hashpartitioning"), plan.count("Expand")) == (1, 0)


def test_ties_nulls_and_lines_without_order_id(spark, rows):
    lines = [
        # customer, order, craftsman, type, days
        (1, 1, 30, None, 1), (1, 2, 20, "b", None), (1, None, 10, "a", 9), (1, None, 10, "a", 9),
        (2, 3, 5, "b", 4), (2, 4, 5, "a", 8), (3, None, 7, "z", 3), (3, None, 6, None, 3),
    ]
    star = spark.createDataFrame(
        [(c, day("2024-01-01"), o, m, p, D("1.00"), d, "done") for c, o, m, p, d in lines],
        "customer_id BIGINT, report_month DATE, order_id BIGINT, craftsman_id BIGINT, product_type STRING, "
        "product_price DECIMAL(18,2), diff_order_date INT, order_status STRING",
    )
    months = customer_report._months_corrected(star)
    columns = (
        "customer_id", "customer_costs", "total_order_count", "count_order_done", "median_time_order_completed",
        "top_craftsman_id", "top_product_category",
    )
    assert rows(months, *columns) == [
        (1, D("4.00"), 2, 2, 1.0, 20, None), (2, D("2.00"), 2, 2, 6.0, 5, "a"), (3, D("2.00"), 0, 0, None, 6, None),
    ]


def test_reference_makes_its_star_once(spark, star, star_parts, monkeypatch):
    written = []
    monkeypatch.setattr(customer_report, "cut_lineage", lambda frame: written.append(frame.columns) or frame)
    report = customer_report.customer_report(star, star_parts[2], "reference")
    assert len(written) == 1 and "product_type" in written[0] and report.count() == 5


def test_dimensions_are_not_asked_for_orders_that_are_new(spark, star_parts, rows):
    """A fact without load time has no mark of its own and is found through its dimensions."""
    f_order, craft, customer, product = star_parts
    unstamped = f_order.where("order_id = 6").withColumn("load_dttm", F.lit(None).cast("timestamp_ntz"))
    sides = as_sides(f_order.where("order_id < 6").unionByName(unstamped), craft, customer, product)
    newest = customer_report.newest_loads(sides)
    touched = customer_report.touched_months(sides, {}, newest)
    assert rows(touched) == [
        (1, day("2024-01-01")), (1, day("2024-02-01")), (2, day("2024-01-01")),
    ]
    stored = customer_report.cut_lineage(sides["f_order"].where("order_id < 6"))
    new_only = customer_report.touched_months({**sides, "f_order": stored}, {}, newest)
    text = new_only._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") == 3 and text.count("NOT coalesce") == 3


def test_probe_counts_the_fan_out(star, star_parts, rows):
    report = customer_report.customer_report(star, star_parts[2])
    found = customer_report.customers_with_many_rows(star, report)
    assert rows(found) == [(1, 10)]  # five orders times two months; customer 2 has one row


# -- sales and retention ----------------------------------------------------


@pytest.fixture(scope="module")
def week(spark):
    first = day("2024-01-02")
    data = [
        (first, 1, 1, D("10.00"), "shipped"),
        (first, 1, 1, D("20.00"), "shipped"),
        (first, 1, 1, D("-5.00"), "refunded"),
        (first, 1, 2, D("7.00"), "shipped"),
        (day("2024-12-31"), 1, 2, D("-7.00"), "refunded"),
    ]
    return spark.createDataFrame(
        data, "date_actual DATE, item_id INT, customer_id INT, payment_amount DECIMAL(18,2), "
        "status STRING")


def test_retention_corrected(week, rows):
    assert rows(sales.customer_retention(week)) == [
        (202401, 1, 1, 1, 1, D("7.00"), D("25.00"), 1),
        (202453, 1, 1, 0, 1, D("-7.00"), None, 1),
    ]


def test_retention_reference_multiplies_by_order_count(week, rows):
    assert rows(sales.customer_retention(week, "reference")) == [
        (202401, 1, 1, 1, 4, D("7.00"), D("75.00"), 3),
        (202453, 1, 1, 0, 1, D("-7.00"), None, 1),
    ]


def test_sales_rows_flip_refunds(spark, rows):
    staged = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 2, 5), 1, 1, 1, 2, D("9.50"), "refunded"),
         ("b", dt.datetime(2030, 1, 2, 5), 1, 1, 1, 2, D("9.50"), "shipped")],
        "uniq_id STRING, date_time TIMESTAMP_NTZ, city_id INT, customer_id INT, item_id INT, "
        "quantity BIGINT, payment_amount DECIMAL(10,2), status STRING",
    )
    calendar = sales.calendar(spark, "2024-01-01", "2024-01-31")
    found = rows(sales.sales_rows(staged, calendar), "date_id", "payment_amount")
    assert found == [(20240102, D("-9.50")), (None, D("9.50"))]


# -- couriers ---------------------------------------------------------------


@pytest.mark.parametrize(
    "rates, percent",
    [([3, 4], "0.05"), ([4, 4], "0.07"), ([4, 5], "0.08"), ([5] * 9 + [4], "0.10"),
     ([5] * 8 + [4] * 2, "0.08"), ([5], "0.10")],
)
def test_courier_tiers_at_their_bounds(spark, rates, percent):
    facts = spark.createDataFrame(
        [(1, i, r, D("100.00"), D("1.00")) for i, r in enumerate(rates)],
        "courier_id BIGINT, delivery_id BIGINT, rate INT, delivery_sum DECIMAL(18,2), "
        "tip_sum DECIMAL(14,2)",
    )
    deliveries = facts.select(
        F.col("delivery_id").alias("id"), F.col("delivery_id").alias("order_id"),
        F.lit("2024-05-06 07:08:09").cast("timestamp_ntz").alias("delivery_ts"),
    )
    people = spark.createDataFrame([(1, "Ann")], "id BIGINT, name STRING")
    row = couriers.courier_report(facts, deliveries, people).first()
    n = len(rates)
    assert row["courier_order_sum"] == n * 100 * D(percent)
    assert row["courier_reward_sum"] == ((n * 100 * D(percent) + n) * D("0.95")).quantize(D("0.01"))
    assert row["order_processing_fee"] == n * 25
    least = couriers.courier_report(facts, deliveries, people, min_payment=True).first()
    assert least["courier_order_sum"] == n * {"0.05": 100, "0.07": 150, "0.08": 175, "0.10": 200}[percent]
    assert check_constraints(
        couriers.courier_report(facts, deliveries, people), couriers.report_rules()
    ).where("violations > 0").count() == 0


def test_rating_tiers_table(spark):
    assert couriers.rating_tiers(spark).count() == 4
    assert couriers.tiers_in_order(couriers.rating_tiers(spark)) == couriers.tiers_in_order()


def tier_table(spark, *rows):
    return spark.createDataFrame(
        [tuple(None if v is None else D(v) for v in row[:2]) + row[2:] for row in rows],
        schemas.SCHEMAS["dm_courier_rating"],
    )


@pytest.mark.parametrize("tiers", [
    [],
    [("0.00", "4.00", 5, 100), ("4.00", "5.00", 7, 150)],
    [("0.00", "5.00", 5, 100), ("1.00", "2.00", 7, 150)],
    [("3.00", "2.00", 5, 100)],
    [("0.00", None, 5, 100)],
    [("0.00", "5.00", 5, None)],
])
def test_tier_tables_that_leave_the_pay_open_are_refused(spark, tiers):
    with pytest.raises(ValueError):
        couriers.tiers_in_order(tier_table(spark, *tiers))


def test_courier_load_makes_orders_and_parsed_documents_once(spark, tmp_path, monkeypatch, rows):
    made = []
    monkeypatch.setattr(
        courier_queries, "cut_lineage", lambda frame: made.append(frame.columns) or workspace.cut_lineage(frame)
    )
    deliveries = spark.sql(
        """SELECT 1L AS delivery_id, 7L AS courier_id, 'seven' AS courier_name, 'addr' AS address,
        TIMESTAMP_NTZ'2024-01-01 10:00:00' AS delivery_ts, 5 AS rate, 9.00BD AS delivery_sum, 1.50BD AS tip_sum"""
    )
    monkeypatch.setattr(courier_queries, "view", lambda *_: deliveries)
    spark.sql("SELECT 1L AS l_orderkey, 9.0D AS l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = courier_queries.courier_dds_json(spark, str(tmp_path))
    assert rows(found, "delivery_key", "courier_name", "rate", "delivery_sum", "tip_sum") == [
        ("1", "seven", 5, D("9.00"), D("1.50"))
    ]
    assert sum("order_key" in columns for columns in made) == 1
    assert sum("tip_sum" in columns for columns in made) == 2


@pytest.mark.parametrize("rate,pay", [(1, 30), (2, 30), (3, 30), (4, 60), (5, 60), (None, 60)])
def test_courier_pay_follows_the_tier_table(spark, rate, pay):
    facts = spark.createDataFrame(
        [(1, 1, rate, D("100.00"), D("0.00"))],
        "courier_id BIGINT, delivery_id BIGINT, rate INT, delivery_sum DECIMAL(18,2), "
        "tip_sum DECIMAL(14,2)",
    )
    deliveries = facts.select(
        F.col("delivery_id").alias("id"), F.col("delivery_id").alias("order_id"),
        F.lit("2024-05-06 07:08:09").cast("timestamp_ntz").alias("delivery_ts"),
    )
    people = spark.createDataFrame([(1, "Ann")], "id BIGINT, name STRING")
    # Below the lowest tier, between the two and above the highest there is pay too.
    tiers = tier_table(spark, ("4.00", "4.50", 60, 10), ("2.00", "2.50", 30, 10))
    report = couriers.courier_report(facts, deliveries, people, tiers=tiers)
    assert report.first()["courier_order_sum"] == pay


# -- group vault ------------------------------------------------------------


def test_history_keeps_later_events_only_when_corrected(spark, tmp_path):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    columns = "group_id BIGINT, user_id BIGINT, user_id_from BIGINT, event STRING, " \
              "datetime TIMESTAMP_NTZ"
    first = [(1, 5, None, "create", dt.datetime(2024, 1, 1))]
    second = first + [(1, 5, 6, "add", dt.datetime(2024, 1, 2))]
    kept = {}
    for semantics in ("reference", "corrected"):
        link = Table(spark, str(tmp_path / semantics / "l"),
                     "hk_l_user_group_activity BIGINT, hk_user_id BIGINT, hk_group_id BIGINT, "
                     "load_dt TIMESTAMP_NTZ, load_src STRING")
        satellite = Table(spark, str(tmp_path / semantics / "s"),
                          "hk_l_user_group_activity BIGINT, user_id_from BIGINT, event STRING, "
                          "event_dt TIMESTAMP_NTZ, load_dt TIMESTAMP_NTZ, load_src STRING")
        for part in (first, second, second):
            log = spark.createDataFrame(part, columns)
            h_users = group_vault.hub_users(log, now)
            h_groups = group_vault.hub_groups(
                log.select("group_id", F.col("datetime").alias("registration_dt")), now)
            group_vault.load_link(
                group_vault.link_user_group_activity(log, h_users, h_groups, now), link)
            group_vault.load_history(
                group_vault.auth_history(log, h_users, h_groups, link.read(), now),
                satellite, semantics)
        assert link.read().count() == 1
        kept[semantics] = satellite.read().count()
    assert kept == {"reference": 1, "corrected": 2}


def test_conversion_without_added_users_is_null(spark):
    h_groups = spark.createDataFrame(
        [(11, 1, dt.datetime(2020, 1, 1)), (12, 2, dt.datetime(2021, 1, 1))],
        "hk_group_id BIGINT, group_id BIGINT, registration_dt TIMESTAMP_NTZ")
    added = spark.createDataFrame([(12, 4)], "hk_group_id BIGINT, cnt_added_users BIGINT")
    wrote = spark.createDataFrame(
        [(11, 1), (12, 1)], "hk_group_id BIGINT, cnt_users_in_group_with_messages BIGINT")
    found = [tuple(r) for r in group_vault.group_conversion(
        group_vault.oldest_groups(h_groups), added, wrote).collect()]
    assert found == [(1, None, 1, None), (2, 4, 1, 0.25)]


# -- geo --------------------------------------------------------------------

EVENTS = (
    "event_id BIGINT, event_ts TIMESTAMP_NTZ, date DATE, event_type STRING, message_from BIGINT, "
    "message_to BIGINT, message_group BIGINT, lat DOUBLE, lon DOUBLE"
)
CITIES = [("1", "Sydney", -33.865, 151.2094), ("2", "Melbourne", -37.8136, 144.9631)]


def _event(i, user, when, city="Sydney", kind="message", to=None, group=None, shift=0.0):
    lat, lon = next((a, b) for _, c, a, b in CITIES if c == city)
    moment = dt.datetime.fromisoformat(when)
    return (i, moment, moment.date(), kind, user, to, group, lat + shift, lon)


def _located(spark, events, semantics="corrected"):
    cities = spark.createDataFrame(
        CITIES, "id STRING, city STRING, city_lat DOUBLE, city_lng DOUBLE")
    return geo.events_with_city(spark.createDataFrame(events, EVENTS), cities, semantics)


def test_events_at_one_spot_collapse_in_reference_only(spark, rows):
    events = [_event(1, 1, "2024-01-01 10:00"), _event(2, 2, "2024-01-01 11:00"),
              (3, dt.datetime(2024, 1, 1), day("2024-01-01"), "message", 3, None, None, None, None)]
    assert rows(_located(spark, events), "event_id") == [(1,), (2,)]
    assert rows(_located(spark, events, "reference"), "event_id") == [(1,)]


def test_users_mart(spark):
    moves = ["Sydney", "Sydney", "Melbourne", "Sydney"]
    events = [_event(i, 1, f"2024-01-0{i + 1} 10:00", city) for i, city in enumerate(moves)]
    events.append(_event(9, 2, "2024-01-01 10:00", "Melbourne"))
    located = _located(spark, events)
    both = {
        s: {r["user_id"]: r for r in geo.users_mart(located, s, min_days=2).collect()}
        for s in ("corrected", "reference")
    }
    row = both["corrected"][1]
    assert row["travel_array"] == ["Sydney", "Melbourne", "Sydney"] and row["travel_count"] == 3
    assert both["reference"][1]["travel_array"] == moves
    assert both["reference"][1]["travel_count"] == 4
    assert (row["act_city"], row["home_city"]) == ("Sydney", "Sydney")
    assert row["local_time"] == dt.datetime(2024, 1, 4, 21)
    assert both["corrected"][2]["home_city"] is None


def test_same_day_city_changes_follow_the_clock(spark):
    events = [_event(1, 1, "2024-01-01 10:00:10", "Sydney"),
              _event(2, 1, "2024-01-01 10:00:20", "Melbourne"),
              _event(3, 1, "2024-01-01 10:00:20", "Sydney")]
    mart = geo.users_travel(geo.city_stays(_located(spark, events))).first()
    assert mart["travel_array"] == ["Sydney", "Melbourne", "Sydney"]


def test_zones_mart_and_validation(spark, rows):
    events = [_event(1, 1, "2024-01-01 10:00"), _event(2, 1, "2024-01-09 10:00", kind="reaction"),
              _event(3, 2, "2024-01-10 10:00", kind="subscription")]
    mart = geo.zones_mart(_located(spark, events))
    assert rows(mart) == [
        ("1", 2024, 1, 1, 1, 0, 0, 1, 1, 1, 1, 2),
        ("1", 2024, 1, 2, 0, 1, 1, 1, 1, 1, 1, 2),
    ]
    # week 2 has a registration without any message
    assert rows(geo.validate_zones(mart), "check", "week") == [("registrations", 2)]
    with pytest.raises(QualityError):
        geo.validate_zones(mart.withColumn("week", F.lit(None).cast("int")))
    broken = mart.withColumn("month_message_cnt", F.lit(5).cast("bigint"))
    assert geo.validate_zones(broken).where("check = 'month_sum'").count() == 1


def test_friends(spark, rows):
    when = "2024-01-01 10:00"
    events = []
    for user, group, shift in [
        (1, 7, 0.0), (2, 7, 0.001), (3, 7, 0.002), (4, 7, 0.5), (5, 8, 0.0), (1, 9, 0.0),
        (2, 9, 0.001),
    ]:
        events.append(_event(len(events), user, when, group=group, shift=shift))
    events.append(_event(50, 3, "2023-12-31 10:00", to=1))
    located = _located(spark, events)
    # 1-3 wrote to each other, 4 is far away, 5 shares no channel
    assert rows(geo.friends_mart(located, "2024-01-01"), "user_left", "user_right") == [
        (1, 2), (2, 3)]
    reference = geo.friends_mart(located, "2024-01-01", "reference", hot_rows=1)
    assert rows(reference, "user_left", "user_right") == [(1, 2), (1, 2), (2, 3)]


def test_friends_shuffle_no_pairs(spark, capsys):
    """Exchanges take members only: none is above the join that makes the pairs."""
    events = [_event(i, i, "2024-01-01 10:00", group=g) for i in range(4) for g in (1, 2)]
    geo.friends_mart(_located(spark, events), "2024-01-01").explain("simple")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")]


def test_flatten_nested_events(spark):
    nested = spark.createDataFrame(
        [((1, 2, None, None, "2024-01-01 10:00:00.5"), 1.0, 2.0, day("2024-01-01"), "message"),
         ((1, None, 3, "2024-01-01 11:00:00", None), 1.0, 2.0, day("2024-01-01"), "message")],
        "event STRUCT<message_from: BIGINT, message_to: BIGINT, message_group: BIGINT, "
        "datetime: STRING, message_ts: STRING>, lat DOUBLE, lon DOUBLE, date DATE, "
        "event_type STRING",
    )
    flat = geo.flatten_events(nested)
    assert [r["event_ts"] for r in flat.orderBy("event_ts").collect()] == [
        dt.datetime(2024, 1, 1, 10, 0, 0, 500000), dt.datetime(2024, 1, 1, 11)]
    assert flat.select("event_id").distinct().count() == 2


# -- finance ----------------------------------------------------------------


def test_global_metrics(spark, rows):
    when = dt.datetime(2024, 1, 1, 23, 59)
    transactions = spark.createDataFrame(
        [(1, 420, "done", 100), (2, 420, "done", 201), (1, 410, "done", 10), (1, 430, "done", 5),
         (-1, 420, "done", 999), (3, 420, "queued", 999)],
        "account_number_from BIGINT, currency_code INT, status STRING, amount BIGINT",
    ).withColumn("transaction_dt", F.lit(when).cast("timestamp_ntz"))
    currencies = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 410, 420, D("1.500")), (dt.datetime(2024, 1, 2), 430, 420, D("2.000")),
         (dt.datetime(2024, 1, 1), 430, 410, D("3.000"))],
        "date_update TIMESTAMP_NTZ, currency_code INT, currency_code_with INT, "
        "currency_with_div DECIMAL(5,3)")
    for load_date in (None, "2024-01-01"):
        found = finance.global_metrics(transactions, currencies, load_date)
        assert rows(found) == [
            (day("2024-01-01"), 410, D("15.00"), 1, D("10.00"), 1),
            (day("2024-01-01"), 420, D("301.00"), 2, D("150.50"), 2),
            (day("2024-01-01"), 430, None, 1, D("5.00"), 1),
        ]
    assert finance.global_metrics(transactions, currencies, "2024-01-02").count() == 0
    total = finance.turnover_by_day(finance.global_metrics(transactions, currencies))
    assert rows(total) == [(day("2024-01-01"), D("316.00"))]
