"""History measures carried from one run date to the next.

A daily run need not read all past orders. What happened before a run date is
stored as opening totals, and the next run adds only what settled since.

An order settles at the later of its start and its check-out, a cancellation
at the later of the order's start and its cancel time. Before a date D the
state holds

* ``opening``: per user and weekday the totals of all events before D;
* ``pending``: dated events of settled facts that happen at D or later, which
  are only the ends of day horizons, so at most 60 days of them;
* ``cells``: the aggregates of each settled (user, paid date), as a log with
  one part per run. Minima and maxima can be merged in any order and twice.

An order that settles late changes a date that was counted already. Then the
events of the date as it was are taken back and those of the merged date are
added; only the dates concerned are read from the log.

The state equals a full computation as long as settled facts stay as they
are. After corrections of settled orders, or of the classification of settled
cancellations, start a new folder. Totals that count only what is known
before the order starts (``strict_past``) are not offered: they need all
check-outs of a date, not their extremes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.functions.columns import weekday
from orderlore.operators.population import at_midnight
from orderlore.operators.recency import MEASURES, canceled_events, date_aggregates, date_events, paid_orders
from orderlore.operators.timeline import event, events_of, point_in_time
from orderlore.sources.schemas import HORIZONS, Window
from orderlore.sources.tables import finished

_CELL = {
    "first_known": F.min,
    "first_start": F.min,
    "last_out": F.max,
    **{f"opens_{n}": F.min for n in HORIZONS},
}
_DATE = ["user_id", "date"]


@dataclass(frozen=True)
class HistoryState:
    """What is known before the first moment of ``as_of``."""

    as_of: dt.date
    fanout: str
    opening: DataFrame
    pending: DataFrame
    cells: DataFrame


def load_state(
    spark: SparkSession, folder: str, as_of: dt.date | None = None, fanout: str = "exact"
) -> HistoryState | None:
    """The latest stored state, not after ``as_of`` if that is given; None without one."""
    root = f"{folder}/{fanout}"
    runs = [r for r in finished(spark, root, "opening") if as_of is None or r <= as_of.isoformat()]
    if not runs:
        return None
    last = f"{root}/{runs[-1]}"
    return HistoryState(
        dt.date.fromisoformat(runs[-1]),
        fanout,
        spark.read.parquet(f"{last}/opening"),
        spark.read.parquet(f"{last}/pending"),
        spark.read.parquet(*[f"{root}/{run}/cells" for run in runs]),
    )


def _settling(start: Column, other: Column, since: dt.date | None) -> Column:
    """At least one of the two times lies at ``since`` or later. Both comparisons reach the scan."""
    return F.lit(True) if since is None else (start >= at_midnight(since)) | (other >= at_midnight(since))


def _settled_orders(orders: DataFrame, since: dt.date | None, before: dt.date) -> DataFrame:
    """Paid orders that start before a date and settle at ``since`` or later, some of them after ``before``."""
    return paid_orders(orders.where("user_id IS NOT NULL"), before).where(
        _settling(F.col("start_at"), F.col("checked_out_at"), since)
    )


def _settled_cancellations(classified: DataFrame, since: dt.date | None) -> DataFrame:
    return classified.where(
        F.col("user_id").isNotNull() & _settling(F.col("start_at"), F.col("canceled_at"), since)
    )


def _merged(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*_DATE).agg(*[merge(name).alias(name) for name, merge in _CELL.items()])


def _changes_of_dates(fresh: DataFrame, log: DataFrame) -> DataFrame:
    """The events that newly settled orders add to their dates, and those of the dates as they were, taken back.

    Days need no taking back: a date that has been paid stays paid.
    """
    touched = log.join(fresh.select(*_DATE), _DATE, "left_semi")
    dow = weekday(F.col("date"))
    past = events_of(_merged(touched), dow, date_events()).withColumns(
        {"delta": -F.col("delta"), "day": F.lit(None).cast("date")}
    )
    return events_of(_merged(touched.unionByName(fresh)), dow, date_events()).unionByName(past)


def _from(log: DataFrame, rows: DataFrame) -> DataFrame:
    """The part of the log from the first date of ``rows`` on: one value, which the scan compares with its statistics."""
    first = rows.agg(F.min("date")).first()[0]
    return log.where(F.lit(False) if first is None else F.col("date") >= F.lit(first))


def _paid_counts(paid: DataFrame) -> DataFrame:
    return events_of(paid, weekday(F.col("date")), [event(F.col("known_at"), "dow_paid")])


def _empty_of(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))


def advance_state(
    spark: SparkSession,
    folder: str,
    orders: DataFrame,
    classified: DataFrame,
    to: dt.date,
    fanout: str = "exact",
) -> HistoryState:
    """The state at ``to``, stored below ``folder``, from the latest one before it and what settled since.

    The first call reads everything. A state that is there already is returned,
    so a run that was lost can be repeated; ``opening`` is written last and
    tells that the others are whole. States of different ``fanout`` are apart.
    """
    if fanout not in ("exact", "dedup"):
        raise ValueError(f"fanout is 'exact' or 'dedup', not {fanout!r}")
    state = load_state(spark, folder, to, fanout)
    if state is not None and state.as_of == to:
        return state
    since = None if state is None else state.as_of
    path = f"{folder}/{fanout}/{to.isoformat()}"
    end = at_midnight(to)

    paid = _settled_orders(orders, since, to).where(F.greatest("start_at", "checked_out_at") < end)
    fresh = paid.groupBy(*_DATE).agg(*date_aggregates())
    fresh.sortWithinPartitions("date").write.mode("overwrite").parquet(f"{path}/cells")
    fresh = spark.read.parquet(f"{path}/cells")
    log = _empty_of(fresh) if state is None else _from(state.cells, fresh)

    canceled = _settled_cancellations(classified, since).where(F.greatest("start_at", "canceled_at") < end)
    events = (
        _changes_of_dates(fresh, log)
        .unionByName(_paid_counts(paid.where("known_at IS NOT NULL")))
        .unionByName(canceled_events(canceled, fanout))
    )
    if state is not None:
        events = events.unionByName(state.pending)
    (
        events.where(F.col("at") >= end)
        .groupBy("user_id", "dow", "at", "measure")
        .agg(F.sum("delta").alias("delta"))
        .where("delta <> 0")
        .withColumn("day", F.lit(None).cast("date"))
        .write.mode("overwrite")
        .parquet(f"{path}/pending")
    )
    totals = events.where(F.col("at") < end).groupBy("user_id", "dow").agg(*MEASURES.from_events())
    if state is not None:
        totals = totals.unionByName(state.opening).groupBy("user_id", "dow").agg(*MEASURES.combined())
    totals.write.mode("overwrite").parquet(f"{path}/opening")
    return load_state(spark, folder, to, fanout)


def state_measures(
    state: HistoryState, orders: DataFrame, classified: DataFrame, points: DataFrame, window: Window
) -> DataFrame:
    """``history_measures`` of a window that starts at the state's date.

    Reads the state, and of the orders and cancellations those that settle at
    its date or later.
    """
    if window.start != state.as_of:
        raise ValueError(f"the window starts at {window.start}, the state is of {state.as_of}")
    users = points.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    paid = _settled_orders(orders, state.as_of, window.end)
    log = _from(state.cells, paid)
    paid = paid.join(users, "user_id", "left_semi")
    canceled = _settled_cancellations(classified, state.as_of).join(users, "user_id", "left_semi")
    # what started before the window settles here too late to be in the state
    canceled = canceled.where(F.greatest("start_at", "canceled_at") >= at_midnight(state.as_of))
    events = (
        _changes_of_dates(paid.groupBy(*_DATE).agg(*date_aggregates()), log)
        .unionByName(_paid_counts(paid.where("known_at IS NOT NULL")))
        .unionByName(canceled_events(canceled, state.fanout))
        .unionByName(state.pending.join(users, "user_id", "left_semi"))
    )
    opening = state.opening.join(users, "user_id", "left_semi")
    return point_in_time(events, points, window, MEASURES, opening)
