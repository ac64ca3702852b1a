"""History state: equal to full computation on every run date, whatever settles late."""

import datetime as dt
import random

import pytest
from factory import table
from pyspark.sql import functions as F

from orderlore.operators.recency import history_measures
from orderlore.operators.state import advance_state, load_state, state_measures
from orderlore.sources.schemas import Window
from orderlore.sources.tables import shared_folder

FIRST = dt.datetime(2017, 7, 3)


def _orders(seed: int = 5) -> list[dict]:
    """Three users, one with most orders, over five months; some check-outs come days or months later, some before the start."""
    draw = random.Random(seed)
    rows = []
    for id in range(420):
        start = FIRST + dt.timedelta(days=draw.randrange(-130, 19), hours=draw.choice([0, 9, 9, 14, 23]))
        out = start + dt.timedelta(hours=draw.choice([2, 2, 2, 30, 24 * 9, 24 * 40, 24 * 90, -24 * 20]))
        rows.append(
            {
                "id": id,
                "user_id": draw.choice([1, 1, 1, 2, 3, None]),
                "workflow_state": draw.choice(["paid", "paid", "paid", "scheduled"]),
                "start_at": start.isoformat(),
                "checked_out_at": None if draw.random() < 0.15 else out.isoformat(),
                "deal_id": 1 if draw.random() < 0.05 else None,
            }
        )
    rows += [{**row, "id": row["id"] + 1000} for row in rows[:20]]  # the same moments once more
    return rows


def _cancellations(spark, seed: int = 6):
    draw = random.Random(seed)
    rows = []
    for id in range(150):
        start = FIRST + dt.timedelta(days=draw.randrange(-100, 15), hours=draw.randrange(24))
        canceled = start + dt.timedelta(days=draw.choice([-80, -10, -1, 0, 1, 5, 30]))
        kind = draw.choice(["one-time", "subscription", "trash_dup"])
        moment = None if draw.random() < 0.05 else canceled
        rows.append((id + 5000, kind, draw.randrange(1, 4), draw.choice([1, 1, 2, 3, None]), start, moment))
    return spark.createDataFrame(
        rows,
        "order_id long, cancel_type string, multiplicity long, user_id long, "
        "start_at timestamp_ntz, canceled_at timestamp_ntz",
    )


def _points(orders, window):
    inside = (F.col("start_at") >= F.lit(window.start)) & (F.col("start_at") < F.lit(window.end))
    return orders.where(inside).select("user_id", "start_at")


def _rows(df):
    names = sorted(df.columns)
    return sorted(df.select(names).distinct().collect(), key=repr)


def _as_seen(row: dict, date: dt.datetime) -> dict:
    """An order as the table shows it at a date: nobody has paid what lies ahead."""
    times = [row["start_at"], row["checked_out_at"] or row["start_at"]]
    if row["workflow_state"] == "paid" and max(times) >= date.isoformat():
        return {**row, "workflow_state": "scheduled", "checked_out_at": None}
    return row


@pytest.mark.parametrize("fanout, changing, days", [("exact", True, [0, 1, 2, 5, 11]), ("dedup", False, [0, 3])])
def test_run_dates(spark, fanout, changing, days):
    folder, rows, classified = shared_folder(spark, "state"), _orders(), _cancellations(spark)
    for day in days:
        date = FIRST + dt.timedelta(days=day)
        orders = table(spark, "orders", *[_as_seen(r, date) for r in rows] if changing else rows)
        window = Window(date.date(), date.date() + dt.timedelta(days=8))
        state = advance_state(spark, folder, orders, classified, date.date(), fanout)
        points = _points(orders, window)
        got = _rows(state_measures(state, orders, classified, points, window))
        assert got and got == _rows(history_measures(orders, classified, points, window, fanout)), date
    assert state.pending.where(F.col("at") < F.lit(date.date())).count() == 0
    assert state.opening.groupBy("user_id", "dow").count().where("count > 1").count() == 0


def test_a_state_is_made_once_and_after_a_lost_run_again(spark):
    folder = shared_folder(spark, "state")
    orders, classified = table(spark, "orders", *_orders()), _cancellations(spark)
    first, second = FIRST.date(), FIRST.date() + dt.timedelta(days=6)
    assert load_state(spark, folder) is None
    whole = _rows(advance_state(spark, folder, orders, classified, first).opening)
    broken = classified.withColumn("multiplicity", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        advance_state(spark, folder, orders, broken, second)
    assert load_state(spark, folder).as_of == first  # its dates are written, but not its totals
    again = advance_state(spark, folder, orders, classified, second)
    other = advance_state(spark, shared_folder(spark, "state"), orders, classified, second)
    assert _rows(again.opening) == _rows(other.opening) and _rows(again.pending) == _rows(other.pending)
    # there already: nothing is read of the orders
    assert _rows(advance_state(spark, folder, None, None, first).opening) == whole
    with pytest.raises(ValueError):
        state_measures(again, orders, classified, _points(orders, Window(first, second)), Window(first, second))
    with pytest.raises(ValueError):
        advance_state(spark, folder, orders, classified, second, "other")


def test_empty_tables(spark):
    folder, window = shared_folder(spark, "state"), Window(FIRST.date(), FIRST.date() + dt.timedelta(days=8))
    orders, classified = table(spark, "orders"), _cancellations(spark).limit(0)
    for day in range(2):
        state = advance_state(spark, folder, orders, classified, window.start + dt.timedelta(days=day))
        assert state.opening.count() == 0
    state = load_state(spark, folder, window.start)
    assert state_measures(state, orders, classified, _points(orders, window), window).count() == 0


def test_a_step_reads_what_settles(spark):
    """The time filters of a step reach the scan, and its dates bound the log."""
    folder, source = shared_folder(spark, "state"), shared_folder(spark, "orders")
    table(spark, "orders", *_orders()).orderBy("start_at").write.parquet(source)
    orders, classified = spark.read.parquet(source), _cancellations(spark)
    window = Window(FIRST.date(), FIRST.date() + dt.timedelta(days=8))
    state = advance_state(spark, folder, orders, classified, window.start)
    measures = state_measures(state, orders, classified, _points(orders, window), window)
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    try:
        plan = measures._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = [line for line in plan.splitlines() if "PushedFilters" in line]
    both = "Or(GreaterThanOrEqual(start_at,2017-07-03T00:00),GreaterThanOrEqual(checked_out_at,2017-07-03T00:00))"
    assert any(both in line for line in filters), filters
    assert any("GreaterThanOrEqual(date," in line for line in filters)
