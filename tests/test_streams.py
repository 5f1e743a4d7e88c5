import json

import pytest
from pyspark.sql import functions as F

from martwright.plans.order_vault import VAULT, counter_lines
from martwright.sources.readers import parse_messages
from martwright.streaming import batches, campaigns, orders

NOW = 1_700_000_000


def _land(path, name, messages):
    path.mkdir(exist_ok=True, parents=True)
    (path / name).write_text("\n".join(json.dumps(m) for m in messages) + "\n")


def _campaign(restaurant, campaign, start, end):
    return {
        "restaurant_id": restaurant, "adv_campaign_id": campaign, "adv_campaign_content": "food",
        "adv_campaign_owner": "o", "adv_campaign_owner_contact": "c",
        "adv_campaign_datetime_start": start, "adv_campaign_datetime_end": end,
        "datetime_created": NOW - 5,
    }


def _run_campaigns(spark, root, subscribers, checkpoint="cp", stream="s"):
    feedback = campaigns.feedback_table(spark, str(root / "feedback"))
    campaigns.start_campaigns(
        spark,
        {"format": "text", "path": str(root / "in")},
        lambda: subscribers,
        feedback,
        {"format": "text", "path": str(root / "push")},
        checkpoint=str(root / checkpoint),
        stream=stream,
        now=lambda: F.lit(NOW),
    ).awaitTermination()
    return feedback


def test_campaign_interval_replay_and_late_subscriber(spark, tmp_path, rows):
    _land(tmp_path / "in", "1.txt", [
        _campaign("r1", "starts-now", NOW, NOW + 9),
        _campaign("r1", "ends-now", NOW - 9, NOW),
        _campaign("r1", "over", NOW - 9, NOW - 1),
        _campaign("r1", "later", NOW + 1, NOW + 9),
        _campaign("r9", "nobody", NOW, NOW),
    ])
    one = spark.createDataFrame([(1, "a", "r1")], "id BIGINT, client_id STRING, restaurant_id STRING")
    feedback = _run_campaigns(spark, tmp_path, one)
    expected = [("ends-now", "a"), ("starts-now", "a")]
    assert rows(feedback.read(), "adv_campaign_id", "client_id") == expected
    # A restart from the checkpoint has nothing to do.
    _run_campaigns(spark, tmp_path, one)
    assert feedback.read().count() == 2
    # A full replay meets a new subscriber: only that one is new.
    two = one.unionByName(one.withColumn("client_id", F.lit("b")))
    _run_campaigns(spark, tmp_path, two, checkpoint="cp2", stream="replay")
    assert feedback.read().count() == 4
    pushed = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "push")).collect()]
    assert len(pushed) == 4 and {p["client_id"] for p in pushed} == {"a", "b"}
    assert all("feedback" not in p for p in pushed)


def _order(number, status="CLOSED", products=(("p1", "Tea", "drinks"),), user="u1"):
    return {
        "object_id": number, "object_type": "order",
        "payload": {
            "id": number, "date": "2024-01-02 03:04:05", "cost": 2700, "payment": 2700.5,
            "status": status, "restaurant": {"id": "r1", "name": "Rest"},
            "user": {"id": user, "name": "Ann"},
            "products": [
                {"id": i, "name": n, "price": 1, "quantity": 1, "category": c}
                for i, n, c in products
            ],
        },
    }


def _run_vault(spark, root, names=tuple(VAULT), checkpoint="cp", stream="orders"):
    tables = orders.vault_tables(spark, str(root / "vault"), names)
    orders.start_vault(
        spark, {"format": "text", "path": str(root / "in")}, tables,
        {"format": "text", "path": str(root / "enriched")},
        checkpoint=str(root / checkpoint), stream=stream,
    ).awaitTermination()
    return tables


def test_order_vault_counts_and_keys(spark, tmp_path):
    import uuid

    _land(tmp_path / "in", "1.txt", [
        _order(1, products=(("p1", "Tea", "drinks"), ("p2", "Pie", "food"))),
        _order(2), _order(3, status="OPEN"), _order(1),
    ])
    tables = _run_vault(spark, tmp_path)
    counts = {name: table.read().count() for name, table in tables.items()}
    assert counts == {
        "h_user": 1, "h_product": 2, "h_category": 2, "h_restaurant": 1, "h_order": 2,
        "l_order_product": 3, "l_product_restaurant": 2, "l_product_category": 2,
        "l_order_user": 2, "s_user_names": 1, "s_product_names": 2, "s_restaurant_names": 1,
        "s_order_cost": 2, "s_order_status": 2,
    }
    space = uuid.NAMESPACE_X500
    order, user = str(uuid.uuid5(space, "1")), str(uuid.uuid5(space, "u1"))
    link = {r["h_order_pk"]: r for r in tables["l_order_user"].read().collect()}[order]
    assert link["hk_order_user_pk"] == str(uuid.uuid5(space, order + user))
    cost = {r["h_order_pk"]: r for r in tables["s_order_cost"].read().collect()}[order]
    assert cost["hk_order_cost_hashdiff"] == str(uuid.uuid5(space, order + "2700" + "2700.5"))
    assert link["load_src"] == "stg-service"
    enriched = spark.read.text(str(tmp_path / "enriched"))
    lines = counter_lines(parse_messages(enriched, orders.schemas.SCHEMAS["enriched_message"]))
    assert lines.count() == 4


def test_vault_rows_are_distinct_before_they_are_hashed(spark, rows):
    import re
    import uuid

    from martwright.plans.order_vault import closed_orders, vault_rows

    lost = _order(4)
    lost["payload"]["products"][0]["id"] = None
    raw = spark.createDataFrame([(json.dumps(m),) for m in (_order(1), _order(1), _order(2), lost, lost)], "value STRING")
    found = vault_rows(closed_orders(parse_messages(raw, orders.schemas.SCHEMAS["order_message"])))
    key = lambda *parts: str(uuid.uuid5(uuid.NAMESPACE_X500, "".join(parts)))
    product = _order(1)["payload"]["products"][0]["id"]
    pairs = [(key(str(n)), key(product)) for n in (1, 2)]
    assert rows(found["l_order_product"]) == sorted((key(*p), *p) for p in pairs)
    assert rows(found["h_product"]) == [(key(product), product)]
    assert rows(found["h_order"], "order_id") == [(1,), (2,), (4,)]
    for name, table in found.items():
        assert table.count() == table.distinct().count(), name
        # No check of a key hashes the rows before they are distinct.
        checked = table.where(F.col(VAULT[name]).isNotNull())._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"Filter .*sha1", checked), name


def test_messages_that_cannot_hold_a_value_are_left_out(spark, rows):
    texts = [json.dumps(_order(1)), json.dumps(_order(2, status="OPEN")), None, "no json CLOSED"]
    texts.append(json.dumps(_order(3)).replace("CLOSED", "\\u0043LOSED"))
    raw = spark.createDataFrame([(t,) for t in texts], "value STRING")
    schema = orders.schemas.SCHEMAS["order_message"]
    found = parse_messages(raw, schema, "CLOSED")
    assert rows(found, "object_id") == [(1,), (3,), (None,)]
    closed = lambda messages: rows(messages.where("payload.status = 'CLOSED'"), "object_id")
    assert closed(found) == closed(parse_messages(raw, schema)) == [(1,), (3,)]


def test_same_batch_again_changes_nothing(spark, tmp_path, rows):
    tables = orders.vault_tables(spark, str(tmp_path / "v"), ["h_order", "l_order_product"])
    push = {"format": "text", "path": str(tmp_path / "e")}
    handle = orders.vault_handler(tables, push, "s")
    raw = spark.createDataFrame([(json.dumps(_order(i)),) for i in (1, 2)], "value STRING")
    batch = parse_messages(raw, orders.schemas.SCHEMAS["order_message"])
    handle(batch, 0)
    before = {n: rows(t.read()) for n, t in tables.items()}
    sent = rows(spark.read.text(push["path"]))
    handle(batch, 0)
    after = {n: rows(t.read().drop("load_dt")) for n, t in tables.items()}
    assert {n: len(v) for n, v in after.items()} == {n: len(v) for n, v in before.items()}
    assert rows(spark.read.text(push["path"])) == sent
    handle(batch, 1)  # the same orders in a later batch
    assert tables["h_order"].read().count() == 2
    batches.compact(tables["h_order"], ["h_order_pk"])
    handle(batch, 2)
    assert tables["h_order"].read().count() == 2


@pytest.mark.parametrize("semantics, tea, drinks", [("reference", 3, 4), ("corrected", 2, 2)])
def test_counters_survive_replay(spark, tmp_path, semantics, tea, drinks):
    twice = (("p1", "Tea", "drinks"), ("p1", "Tea", "drinks"), ("p3", "Milk", "drinks"))
    _land(tmp_path / "in", "1.txt", [_order(1, products=twice), _order(2), _order(2)])
    _run_vault(spark, tmp_path, names=())
    tables = orders.counter_tables(spark, str(tmp_path / "cdm"))
    for run in ("a", "b"):
        orders.start_counters(
            spark, {"format": "text", "path": str(tmp_path / "enriched" / "*")}, tables,
            str(tmp_path / f"cp-{run}"), stream=run, semantics=semantics,
        ).awaitTermination()
    products = {r["product_name"]: r["order_cnt"]
                for r in orders.read_counters(tables, "product").collect()}
    assert products == {"Tea": tea, "Milk": 1}
    category = orders.read_counters(tables, "category").first()
    assert (category["category_name"], category["order_cnt"]) == ("drinks", drinks)


def test_landing_keeps_one_row_per_order(spark, tmp_path, rows):
    landing = orders.landing_table(spark, str(tmp_path / "stg"))
    source = {"format": "text", "path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"}
    _land(tmp_path / "in", "1.txt", [_order(1), _order(1)])
    _land(tmp_path / "in", "2.txt", [_order(1), _order(2)])
    orders.start_landing(spark, source, landing, str(tmp_path / "cp")).awaitTermination()
    assert rows(landing.read(), "object_id") == [(1,), (2,)]


def test_polling_is_bounded_and_goes_on_after_a_stop(spark, tmp_path, rows):
    """At most 100 messages per batch; two runs leave what one run leaves."""
    for name in range(6):
        _land(tmp_path / "in", f"{name}.txt", [_order(name * 60 + i) for i in range(100)])
    source = {"format": "text", "path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"}
    landing = orders.landing_table(spark, str(tmp_path / "stg"))
    first = orders.start_landing(
        spark, source, landing, str(tmp_path / "cp"), trigger={"processingTime": "1 second"})
    batches.poll(first, lambda: batches.finished_batches(first) >= 2, pause=0.1)
    assert not first.isActive
    early = landing.read().count()
    assert 160 <= early < 400
    rest = orders.start_landing(spark, source, landing, str(tmp_path / "cp"))
    rest.awaitTermination()
    read = [p["numInputRows"] for q in (first, rest) for p in q.recentProgress if p["numInputRows"]]
    assert max(read) <= 100 and sum(read) == 600
    whole = orders.landing_table(spark, str(tmp_path / "whole"))
    orders.start_landing(spark, source, whole, str(tmp_path / "other")).awaitTermination()
    found = rows(landing.read(), "object_id")
    assert found == rows(whole.read(), "object_id") and sorted(found) == [(i,) for i in range(400)]


def test_polling_raises_what_a_batch_raised(spark, tmp_path):
    _land(tmp_path / "in", "1.txt", [_order(1)])
    raw = spark.readStream.schema("value STRING").text(str(tmp_path / "in"))

    def broken(batch, epoch_id):
        raise RuntimeError("no sink")

    query = batches.run_stream(raw, broken, str(tmp_path / "cp"), {"processingTime": "1 second"})
    with pytest.raises(Exception, match="no sink"):
        batches.poll(query, lambda: False, pause=0.1)


def test_unreadable_messages_do_not_stop_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("not json\n" + json.dumps(_order(1)) + "\n")
    tables = _run_vault(spark, tmp_path, names=["h_order"])
    assert tables["h_order"].read().count() == 1


def test_retry_at_a_later_clock_changes_nothing(spark, tmp_path, rows):
    """The clock moves on, a subscriber comes and the table is compacted between two attempts at a batch."""
    journal = batches.Journal(spark, str(tmp_path / "cp"), "s")
    feedback = campaigns.feedback_table(spark, str(tmp_path / "feedback"))
    push = {"format": "text", "path": str(tmp_path / "push")}
    messages = [_campaign("r1", "now", NOW - 9, NOW), _campaign("r1", "soon", NOW + 5, NOW + 99)]
    raw = spark.createDataFrame([(json.dumps(m),) for m in messages], "value STRING")
    batch = parse_messages(raw, campaigns.schemas.SCHEMAS["campaign_message"])
    people = spark.createDataFrame([(1, "a", "r1")], "id BIGINT, client_id STRING, restaurant_id STRING")

    def attempt(clock, subscribers, journal=journal):
        campaigns.campaign_handler(lambda: subscribers, feedback, push, journal, lambda: F.lit(clock))(batch, 0)
        sent = [json.loads(r["value"]) for r in spark.read.text(push["path"]).collect()]
        stored = rows(feedback.read(), "adv_campaign_id", "client_id", "trigger_datetime_created")
        return stored, sorted((m["adv_campaign_id"], m["client_id"], m["trigger_datetime_created"]) for m in sent)

    first = attempt(NOW, people)
    assert first == ([("now", "a", NOW)],) * 2
    two = people.unionByName(people.withColumn("client_id", F.lit("b")))
    assert attempt(NOW + 50, two) == first
    batches.compact(feedback, campaigns.NOTIFICATION_KEY)
    assert attempt(NOW + 50, two) == first
    # A new checkpoint of the same stream starts from epoch zero and leaves the older rows alone.
    again = batches.Journal(spark, str(tmp_path / "cp2"), "s")
    more = [("now", "a", NOW), ("soon", "a", NOW + 50), ("soon", "b", NOW + 50)]
    assert attempt(NOW + 50, two, again) == (more, more)
    assert batches.Journal(spark, str(tmp_path / "cp"), "s").stream == journal.stream != again.stream
    # Compacting leaves the newest batch of each stream to itself.
    batches.compact(feedback, campaigns.NOTIFICATION_KEY)
    assert rows(feedback.read(), batches.BATCH, "client_id") == sorted(
        [(journal.batch(0), "a"), (again.batch(0), "a"), (again.batch(0), "b")]
    )


def test_messages_are_compressed_and_batches_not_gathered(spark, tmp_path, rows, monkeypatch):
    from martwright.operators.tables import Table
    from martwright.sources.writers import write_messages

    path = str(tmp_path / "out")
    messages = spark.createDataFrame([("a",), ("b",)], "value STRING")
    write_messages(messages, {"format": "text", "path": path, "compression": "gzip"}, "s-0")
    assert list((tmp_path / "out").glob("batch=s-0/part-*.gz")) and not list((tmp_path / "out").glob("batch=s-0/part-*.txt"))
    assert rows(spark.read.text(path), "value") == [("a",), ("b",)]
    monkeypatch.setattr(Table, "_gathered", lambda *_: pytest.fail("rows of one batch were shuffled"))
    table = batches.batch_table(spark, str(tmp_path / "t"), messages.schema)
    for _ in range(2):
        batches.replace_batch(table, messages, "s-0")
    assert rows(table.read(), "value") == [("a",), ("b",)]
