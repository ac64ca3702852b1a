"""Populations, history measures and matrices: literal rows, brute force, skew."""

import datetime as dt
import random

import pytest
from factory import ORDER, table, tables
from pyspark.sql import functions as F

from orderlore.operators import population as po
from orderlore.operators import recency as re
from orderlore.plans.features import feature_matrix, feature_matrix_segments
from orderlore.sources.schemas import FEATURES, HORIZONS, MATRIX_SCHEMA, VALIDATION, Window

JULY = Window(dt.date(2017, 7, 1), dt.date(2017, 7, 15))


def _rows(df, key="order_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_late_cancellations_and_window(spark):
    start = "2017-07-08 10:00:00"

    def canceled(id, at):
        return {"id": id, "workflow_state": "canceled", "start_at": start, "canceled_at": at}

    orders = table(
        spark,
        "orders",
        canceled(1, "2017-07-02 23:00:00"),
        canceled(2, "2017-07-01 23:00:00"),
        canceled(3, "2017-07-09 00:00:00"),
        {"id": 4, "start_at": "2017-07-01 00:00:00"},
        {"id": 5, "start_at": "2017-07-15 00:00:00"},
        {"id": 6, "start_at": start, "workflow_state": "hidden"},
        {"id": 7, "start_at": start, "workflow_state": "scheduled"},
        {"id": 8, "start_at": start, "deal_id": 1},
    )
    assert {r.id for r in po.population(orders, "train", JULY).collect()} == {1, 3, 4}
    assert {r.id for r in po.population(orders, "predict", JULY).collect()} == {4, 7}
    with pytest.raises(ValueError):
        po.population(orders, "other", JULY)


def test_general_columns(spark):
    rows = [
        {"id": 1, "start_at": "2017-07-02 07:59:00", "created_at": "2017-07-02 05:29:00", "subtotal_cents": 0},
        {"id": 2, "start_at": "2017-07-03 08:00:00", "created_at": "2017-07-03 04:30:00", "subtotal_cents": None},
        {"id": 3, "start_at": "2017-07-04 12:59:00", "subtotal_cents": 1000, "total_cents": 750, "address_id": 5},
        {"id": 4, "start_at": "2017-07-05 13:00:00", "canceled_at": "2017-07-04 13:00:00", "tableware": None},
        {"id": 5, "start_at": "2017-07-05 13:00:00", "windows": 3, "oven": True, "payment_type": "cash", "notice": "n"},
    ]
    places = table(spark, "addresses", {"id": 5, "lat": 1.5, "lng": 2.5})
    got = _rows(po.orders_general_info(table(spark, "orders", *rows), places, "train", JULY))
    assert [got[i]["discount_prc"] for i in (1, 2, 3)] == [1.0, 1.0, 0.25]
    assert [got[i]["creation_start_hours"] for i in (1, 2)] == [2.0, 4.0]
    assert [got[i]["day_slot_flg"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert got[1]["dow"] == 0  # a Sunday
    assert (got[3]["lat"], got[3]["lng"], got[4]["lat"]) == (1.5, 2.5, None)
    assert (got[4]["cancel"], got[5]["cancel"]) == (1, 0)  # paid, yet with a cancel time
    assert (got[5]["additionals_num"], got[5]["cash_flg"], got[5]["has_comment"], got[4]["additionals_num"]) == (2, 1, 1, 0)


def _classified(spark, *rows):
    """(order_id, cancel_type, multiplicity, user_id, start_at, canceled_at)"""
    data = [(*r[:4], *[dt.datetime.fromisoformat(t) if t else None for t in r[4:]]) for r in rows]
    return spark.createDataFrame(
        data,
        "order_id long, cancel_type string, multiplicity long, user_id long, "
        "start_at timestamp_ntz, canceled_at timestamp_ntz",
    )


def test_check_out_in_the_future_counts_in_day_horizons_only(spark):
    orders = table(
        spark,
        "orders",
        {"id": 1, "start_at": "2017-07-05 10:00:00"},
        {"id": 2, "start_at": "2017-07-04 10:00:00", "checked_out_at": "2017-07-06 10:00:00"},
    )
    loose = _rows(re.order_history(orders, _classified(spark), "train", JULY))[1]
    assert (loose["paid_16d"], loose["paid_all"], loose["days_since_last_paid_order"]) == (1, 0, 1)
    strict = _rows(re.order_history(orders, _classified(spark), "train", JULY, strict_past=True))[1]
    assert (strict["paid_16d"], strict["paid_all"]) == (0, 0)


def test_order_without_history(spark):
    matrix = _rows(feature_matrix(tables(spark, orders=[{"id": 1, "start_at": "2017-07-05 10:00:00"}]), "train", JULY))
    row = matrix[1]
    assert row["paid_all"] == row["dow_paid"] == row["canceled_60d_nt"] == 0
    assert row["canceled_all_nt_share"] == 0.0
    for name in ("dow_paid_share", "dow_all_paid_share", "shifts_num", "days_since_last_paid_order"):
        assert row[name] is None


def test_fan_out_only_weighs_on_weekday_counts(spark):
    week_before = "2017-06-28 10:00:00"
    orders = table(spark, "orders", {"id": 1, "start_at": "2017-07-05 10:00:00"})
    classified = _classified(spark, (2, "one-time", 8, 1, week_before, week_before), (3, "trash_subscr", 5, 1, week_before, week_before))
    exact = _rows(re.order_history(orders, classified, "train", JULY))[1]
    once = _rows(re.order_history(orders, classified, "train", JULY, fanout="dedup"))[1]
    assert (exact["dow_canceled"], exact["canceled_all_nt"], exact["canceled_onetime_nt"]) == (8, 1, 1)
    assert once["dow_canceled"] == 1


def _brute_force(orders, classified, chosen, strict):
    """The definitions, pair by pair."""
    types = {c[0]: c for c in classified}
    result = {}
    for a in chosen:
        now, today = a["start_at"], a["start_at"].date()
        past = [b for b in orders if b["user_id"] == a["user_id"] is not None and b["start_at"] and b["start_at"] < now
                and b["deal_id"] is None and b["confirmed_at"]]
        paid = [b for b in past if b["workflow_state"] == "paid"]
        out = [b for b in paid if b["checked_out_at"]]
        known = [b for b in out if b["checked_out_at"] < now]
        gone = [b for b in past if b["id"] in types and not types[b["id"]][1].startswith("trash") and b["canceled_at"]]
        before = [b for b in gone if b["canceled_at"] < now]
        once = [b for b in before if types[b["id"]][1] == "one-time"]
        row = {
            "paid_all": len({b["start_at"].date() for b in known}),
            "canceled_all_nt": len(before),
            "canceled_onetime_nt": len(once),
            "dow_paid": sum(b["start_at"].weekday() == now.weekday() for b in known),
            "dow_canceled": sum(types[b["id"]][2] for b in before if b["start_at"].weekday() == now.weekday()),
            "days_since_last_cancel_all_nt": min([(today - b["canceled_at"].date()).days for b in before], default=None),
            "days_since_last_cancel_onetime_nt": min([(today - b["canceled_at"].date()).days for b in once], default=None),
            "days_since_last_paid_order": min([(today - b["start_at"].date()).days for b in paid], default=None),
            "first_order_dt": min([b["start_at"].date() for b in paid], default=None),
            "last_order_dt": max([b["start_at"].date() for b in paid], default=None),
        }
        for n in HORIZONS:
            row[f"paid_{n}d"] = len({b["start_at"].date() for b in (known if strict else out)
                                     if (today - b["checked_out_at"].date()).days < n})
            row[f"canceled_{n}d_nt"] = sum((today - b["canceled_at"].date()).days < n for b in (before if strict else gone))
        result[a["id"]] = row
    return result


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_pairwise_definition(spark, seed, strict):
    """One user holds most rows; times are coarse so that ties and equal dates abound."""
    rng = random.Random(seed)
    base = dt.datetime(2017, 4, 1)
    kinds = ["one-time", "trash_subscr", "ivr-user"]
    rows, classified = [], []
    for i in range(500):
        start = base + dt.timedelta(days=rng.randrange(0, 105), hours=rng.choice([0, 9, 9, 15]))
        state = rng.choice(["paid", "paid", "canceled", "scheduled"])
        shift = lambda low, high: start + dt.timedelta(days=rng.randrange(low, high), hours=rng.choice([0, 3]))
        row = ORDER | {
            "id": i,
            "user_id": rng.choice([1, 1, 1, 1, 2, 3, None]),
            "workflow_state": state,
            "deal_id": rng.choice([None] * 9 + [4]),
            "confirmed_at": rng.choice([base] * 9 + [None]),
            "created_at": base,
            "start_at": start if rng.random() < 0.95 else None,
            "checked_out_at": shift(-80, 80) if state == "paid" and rng.random() < 0.9 else None,
            "canceled_at": shift(-80, 20) if state == "canceled" and rng.random() < 0.9 else None,
        }
        rows.append(row)
        if state == "canceled" and row["deal_id"] is None and row["confirmed_at"]:
            classified.append((i, rng.choice(kinds), rng.randrange(1, 4), row["user_id"], row["start_at"], row["canceled_at"]))
    schema = "order_id long, cancel_type string, multiplicity long, user_id long, start_at timestamp_ntz, canceled_at timestamp_ntz"
    orders = table(spark, "orders", *rows)
    history = _rows(
        re.order_history(orders, spark.createDataFrame(classified, schema), "train", JULY, strict_past=strict)
    )
    chosen = [r for r in rows if r["id"] in history]
    assert len(chosen) > 20
    expected = _brute_force(rows, classified, chosen, strict)
    for i, row in expected.items():
        assert {k: history[i][k] for k in row} == row, i


def test_shift_counts(spark):
    from orderlore.operators.history import change_summary

    moved = '[{"name":"start_at","object":"x"}]'
    deltas = table(
        spark,
        "deltas",
        *[{"user_id": u, "model_id": 1, "model_type": "Order", "object": moved} for u in (1, 2, 2)],
        {"user_id": 1, "model_id": 2, "model_type": "Order", "object": '[{"name":"note","object":"start_at"}]'},
        {"user_id": 1, "model_id": 3, "model_type": "User", "object": moved},
    )
    chosen = spark.range(1, 4).withColumnRenamed("id", "order_id")
    assert [tuple(r) for r in po.order_shifts(change_summary(deltas), chosen).collect()] == [(1, 2)]


def _segment_tables(spark):
    def seen(user, tracking, app="web", at="2017-07-03"):
        return {"user_id": user, "app_id": app, "collector_tstamp": at, "contexts": f'{{"tracking_id":"{tracking}"}}'}

    return tables(
        spark,
        orders=[{"id": i, "user_id": i, "start_at": "2017-07-05 10:00:00"} for i in (1, 2)],
        web_events=[seen(1, "a"), seen(1, "a"), seen(1, "b"), seen(2, "c", app="other"), seen(2, "d", at="2017-07-01")],
        segment_uploads=[
            {"tracking_id": "a", "segments": "x/y/x", "date": "2017-07-01"},
            {"tracking_id": "a", "segments": "old", "date": "2017-06-01"},
            {"tracking_id": "b", "segments": "first", "date": "2017-07-01"},
            {"tracking_id": "b", "segments": "undated", "date": None},
        ],
    )


def test_every_tracking_id_makes_a_row(spark):
    matrix = feature_matrix_segments(_segment_tables(spark), JULY, "web", "2017-07-01")
    assert sorted((r.order_id, r.segments or "") for r in matrix.collect()) == [(1, "undated"), (1, "x/y/x"), (2, "")]
    assert len(matrix.columns) == 36
    latest = feature_matrix_segments(_segment_tables(spark), JULY, "web", "2017-07-01", dedupe="latest")
    assert sorted((r.order_id, r.segments or "") for r in latest.collect()) == [(1, "undated"), (2, "")]


def test_whole_plan_without_stored_inputs(spark):
    """The matrix built in one plan, on the smallest test tables."""
    from orderlore.plans import registry

    folder = "/root/testdata/sf0.001"
    inputs = registry.tables_of(spark, folder)
    whole = feature_matrix(inputs, "train", VALIDATION)
    stored = registry.training_matrix(spark, folder, VALIDATION)
    assert whole.columns == MATRIX_SCHEMA.names and len(FEATURES) == 32
    assert whole.exceptAll(stored).count() == 0 and whole.count() == stored.count() == 38
    assert whole.select("order_id").distinct().count() == 38
    predict = feature_matrix(inputs, "predict", Window.next_days(registry.AS_OF))
    assert len(predict.columns) == 34 and predict.count() == 30
    for name in ("canceled_all_nt_share", "dow_paid_share", "dow_all_paid_share"):
        assert stored.where((F.col(name) < 0) | ((F.col(name) > 1) & (name != "dow_all_paid_share"))).count() == 0
