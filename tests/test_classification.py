"""Reminders, change logs, ranks and cancel types on hand-computed rows."""

import datetime as dt

import pytest
from factory import table, tables
from pyspark.sql import functions as F

from orderlore.operators import classification as cl
from orderlore.functions.json import unpack_changes
from orderlore.operators import history as hi


def test_reminder_without_time_counts_as_latest(spark):
    reminders = table(
        spark,
        "order_reminders",
        {"order_id": 1, "perform_at": None, "status": "failed", "result": "x"},
        {"order_id": 1, "perform_at": "2017-07-01", "status": "success", "result": "y"},
        {"order_id": 2, "perform_at": "2017-07-01", "status": "success", "result": "old"},
        {"order_id": 2, "perform_at": "2017-07-02", "status": "success", "result": "new"},
    )
    rows = {r.order_id: (r.status, r.result) for r in hi.latest_reminder(reminders).collect()}
    assert rows == {1: ("failed", "x"), 2: ("success", "new")}


def test_latest_reminder_is_limited_before_the_shuffle(spark):
    plan = hi.latest_reminder(table(spark, "order_reminders"))._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def _canceled(id, canceled_at, **more):
    return {"id": id, "workflow_state": "canceled", "canceled_at": canceled_at, "start_at": "2017-07-05 10:00:00"} | more


def _types(spark, **rows):
    return {r.order_id: r.cancel_type for r in cl.classified_orders(tables(spark, **rows)).collect()}


def test_ten_minutes_are_inclusive_and_rules_are_ordered(spark):
    auto = {"creation_mean": "auto", "created_at": "2017-07-01 10:00:00"}
    call = {"status": "failed", "result": "x"}
    got = _types(
        spark,
        orders=[
            _canceled(1, "2017-07-01 10:10:00", **auto),
            _canceled(2, "2017-07-01 10:10:00.000001", **auto),
            _canceled(3, "2017-07-01 10:05:00", subscription_id=7, **auto),
            _canceled(4, "2017-07-01 10:00:00"),
            _canceled(5, "2017-07-01 10:00:00"),
            _canceled(6, "2017-07-01 10:00:00", confirmed_at=None),
            _canceled(7, "2017-07-01 10:00:00", deal_id=1),
            _canceled(8, "2017-07-01 10:00:00"),
            _canceled(9, "2017-07-01 10:00:00"),
        ],
        order_reminders=[
            {"order_id": 4, "perform_at": "2017-07-01 10:01:00", **call},
            {"order_id": 5, "perform_at": "2017-07-01 09:55:00", **call},
            {"order_id": 8, "perform_at": "2017-07-01 09:55:00", "status": "success", "result": "order_canceled"},
            {"order_id": 9, "perform_at": "2017-07-01 09:55:00", "status": "success", "result": "handled_by_call_center"},
        ],
    )
    assert got == {
        1: "trash_autosubscr",
        2: "one-time",
        3: "trash_autosubscr",
        4: "one-time",
        5: "ivr-auto",
        8: "ivr-user",
        9: "ivr-cc",
    }


def test_subscription_rules(spark):
    ended = "2017-07-01 12:00:00"
    got = _types(
        spark,
        orders=[
            _canceled(1, "2017-07-01 13:00:00", subscription_id=1, start_at="2017-07-09"),
            _canceled(2, "2017-07-01 14:00:00", subscription_id=1, start_at="2017-07-08"),
            _canceled(3, "2017-07-01 11:00:00", subscription_id=1, start_at="2017-07-09"),
            _canceled(4, "2017-06-30 23:00:00", subscription_id=1),
            _canceled(5, "2017-07-02 00:00:00", subscription_id=1, start_at="2017-07-01"),
            _canceled(6, "2017-07-02 00:00:00", subscription_id=2),
            _canceled(7, "2017-07-02 00:00:00", subscription_id=3),
        ],
        subscriptions=[{"id": 1, "deactivated_at": ended}, {"id": 2, "deactivated_at": None}],
    )
    assert got == {
        1: "subscr_cancel",
        2: "trash_subscr",
        3: "trash_subscr",  # canceled before the end on that day: no rank
        4: "part-subscr",
        5: "unknown",
        6: "part-subscr",
        7: "part-subscr",  # subscription not found
    }


def test_rank_ties_and_missing_starts(spark):
    after = "2017-07-02 00:00:00"
    orders = table(
        spark,
        "orders",
        *[
            _canceled(i, after, subscription_id=s, start_at=start)
            for i, s, start in [
                (1, 1, "2017-07-05 10:00:00"),
                (2, 1, "2017-07-05 10:00:00"),
                (3, 1, "2017-07-05 09:00:00"),
                (4, 1, "2017-07-04 23:00:00"),
                (5, 2, None),
                (6, 2, None),
                (7, 2, "2017-07-05 10:00:00"),
            ]
        ],
    )
    ends = table(spark, "subscriptions", *[{"id": i, "deactivated_at": "2017-07-01"} for i in (1, 2)])
    ranks = {r.order_id: r.sub_cancel_num for r in hi.subscription_cancel_rank(ends, orders).collect()}
    assert ranks == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1, 6: 1, 7: 3}
    types = {
        r.order_id: r.cancel_type
        for r in cl.classified_orders(
            tables(
                spark,
                orders=[
                    _canceled(5, "2017-07-01 13:00:00", subscription_id=2, start_at=None),
                    _canceled(7, "2017-07-01 13:00:00", subscription_id=2),
                ],
                subscriptions=[{"id": 2, "deactivated_at": "2017-07-01 12:00:00"}],
            )
        ).collect()
    }
    assert types == {5: "subscr_cancel", 7: "trash_subscr"}


def test_fan_out_is_the_product_of_log_roles_and_crm(spark):
    log = '[{"name":"workflow_state","object":"canceled"}]'
    crm = '{"workflow_state":["paid","canceled"]}'
    classified = cl.classified_orders(
        tables(
            spark,
            orders=[_canceled(1, "2017-07-01"), _canceled(2, "2017-07-01")],
            deltas=[{"user_id": 9, "model_id": 1, "model_type": "Order", "object": log}] * 2
            + [{"user_id": None, "model_id": 2, "model_type": "Order", "object": log}] * 3,
            users_roles=[{"user_id": 9}] * 2,
            diffs=[{"subject_id": 1, "subject_type": "Order", "differences": crm}] * 2,
        )
    )
    assert {r.order_id: r.multiplicity for r in classified.collect()} == {1: 8, 2: 3}
    assert cl.explode_multiplicity(classified).groupBy("order_id").count().where("order_id = 1").first()["count"] == 8
    many = spark.createDataFrame(
        [(i, "unknown", n) for i, n in enumerate([1, 4096, 4097, 100_000])],
        "order_id long, cancel_type string, multiplicity long",
    )
    exploded = cl.explode_multiplicity(many)
    assert {r.order_id: r["count"] for r in exploded.groupBy("order_id").count().collect()} == {
        0: 1, 1: 4096, 2: 4097, 3: 100_000
    }


def test_change_documents(spark):
    def log(document):
        return {"user_id": 1, "model_id": 1, "model_type": "Order", "object": document}

    deltas = table(
        spark, "deltas", log("[]"), log(None), log('[{"name":"a","object":12}]'), log('[{"name":"b","object":null}]')
    )
    orders = table(spark, "orders", {"id": 1})
    got = [(r.field_name, r.field_value) for r in hi.unpacked_deltas(deltas, orders).orderBy("field_name").collect()]
    assert got == [("a", "12"), ("b", None)]


def test_elements_of_change_documents_are_read_one_by_one(spark):
    documents = ['[1,{"name":"a","object":"x"}]', '["s",{"name":"b","object":1.50}]', '[null,{"name":"c","object":{"k":[1]}},[2]]']
    df = spark.createDataFrame(list(enumerate(documents)), "id int, doc string")
    got = [tuple(r) for r in unpack_changes(df, "doc", "id").collect()]
    assert sorted(got, key=str) == sorted(
        [(0, None, None), (0, "a", "x"), (1, None, None), (1, "b", "1.5"), (2, None, None), (2, "c", '{"k":[1]}'), (2, None, None)],
        key=str,
    )


@pytest.mark.parametrize(
    "document, rows",
    [
        (r'["{\"name\":\"a\",\"object\":\"b\"}"]', [(None, None)]),  # a string that spells an object
        ('[true, 1.5, "x", null, []]', [(None, None)] * 5),
        ('[{"name":"a","object":{"x":[1, {"y":null}]}}, {"object":"only"}]', [("a", '{"x":[1,{"y":null}]}'), (None, "only")]),
        ('[{"name":"a","object":true},{"name":"b","object":-0.50},{"name":7}]', [("a", "true"), ("b", "-0.5"), ("7", None)]),
        ('[{"name":"a","name":"z","object":"q"},{"name":"b"}]', [("z", "q"), ("b", None)]),  # the last of repeated keys
        ('{"name":"lone","object":"o"}', []),
        ('[{"name":"a","object":"b"}', []),
        ("", []),
        ("no list", []),
        (None, []),
        ('[{"name":"w","object":"\\u0063anceled"}]', [("w", "canceled")]),
        ('[{"name":"n","object":12345678901234567890123}]', [("n", "12345678901234567890123")]),
    ],
)
def test_kinds_of_change_elements(spark, document, rows):
    df = spark.createDataFrame([(document,)], "doc string")
    assert [tuple(r) for r in unpack_changes(df, "doc").collect()] == rows


def test_escaped_words_are_still_found(spark):
    escaped = '[{"name":"workflow\\u005fstate","object":"canceled"}]'
    deltas = table(spark, "deltas", {"user_id": 1, "model_id": 1, "model_type": "Order", "object": escaped})
    orders = table(spark, "orders", {"id": 1})
    assert hi.logged_cancellations(deltas, orders).count() == 1
    assert hi.change_summary(deltas).first().cancellations == 1


def test_repeated_key_keeps_its_last_value(spark):
    def diff(document):
        return {"subject_id": 1, "subject_type": "Order", "differences": document}

    diffs = table(
        spark,
        "diffs",
        diff('{"workflow_state":["a"],"workflow_state":["canceled"]}'),
        diff('{"workflow_state":["canceled"],"workflow_state":["a"]}'),
        diff('{"note":"workflow_state canceled"}'),
    )
    assert hi.crm_cancellations(diffs).count() == 1


def test_null_keys_are_spread(spark):
    """Orders without a subscription shuffle by a second key part, not to one partition."""
    from orderlore.operators.joins import left_join_nullable

    left = spark.range(1000).select("id", F.lit(None).cast("long").alias("k"))
    right = spark.range(10).select(F.col("id").alias("r"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_join_nullable(left, right, "k", "r", "id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 1000 and max(sizes) < 500
    assert joined.where("v is not null").count() == 0


def test_intervals_do_not_depend_on_the_session_zone(spark):
    from orderlore.functions.columns import rounded_hours, within

    frame = spark.sql(
        "SELECT timestamp_ntz'2017-03-26 01:30:00' AS a, timestamp_ntz'2017-03-26 04:00:00' AS b, "
        "timestamp_ntz'2017-03-26 05:00:00' AS c"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = frame.select(
            rounded_hours(F.col("b"), F.col("a")).alias("x"),
            rounded_hours(F.col("c"), F.col("a")).alias("y"),
            within(F.col("b"), F.col("a"), dt.timedelta(hours=2, minutes=30)).alias("z"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.x, row.y, row.z) == (2.0, 4.0, True)  # 2.5 h and 3.5 h go to the even hour
