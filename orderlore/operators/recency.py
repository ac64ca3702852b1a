"""History measures of an order: what its user had done before it starts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlore.functions.columns import ONE_MICROSECOND, midnight, weekday
from orderlore.operators.classification import ONE_TIME, TRASH_PREFIX
from orderlore.operators.population import at_midnight, population
from orderlore.operators.timeline import Measures, event, events_of, point_in_time
from orderlore.sources.schemas import HORIZONS, Window

COUNTS = [
    "paid_all",
    *[f"paid_{n}d" for n in HORIZONS],
    "canceled_all_nt",
    *[f"canceled_{n}d_nt" for n in HORIZONS],
    "canceled_onetime_nt",
]
WEEKDAY_COUNTS = ["dow_paid", "dow_canceled"]
_LATEST = {
    "last_cancel_dt": "canceled_all_nt",
    "last_onetime_dt": "canceled_onetime_nt",
    "last_order_dt": "paid_day",
}
_EARLIEST = {"first_order_dt": "paid_day"}
MEASURES = Measures(COUNTS, WEEKDAY_COUNTS, _LATEST, _EARLIEST)


def _leaves_horizon(date: Column, days: int) -> Column:
    """Last moment before a date lies ``days`` or more calendar days back."""
    return midnight(F.date_add(date, days)) - F.lit(ONE_MICROSECOND)


def _horizon_events_plain() -> list[Column]:
    """Paid dates per horizon. An order counts from its start until its check-out
    is N days old. Orders of one date start on that date, and whatever is still
    open then stays open at least until midnight; so the date is open from the
    first such start to the last check-out's expiry, without gaps."""
    events = []
    for n in HORIZONS:
        opens = F.col(f"opens_{n}")
        closes = F.when(opens.isNotNull(), _leaves_horizon(F.col("last_out"), n))
        events += [event(opens, f"paid_{n}d"), event(closes, f"paid_{n}d", -1)]
    return events


def _strict_horizon_events(paid: DataFrame, users: DataFrame) -> DataFrame:
    """The same, counting an order only once it is checked out. Now the spans of
    one date can lie apart: walk through them by opening time and let each
    count for the part that reaches beyond the earlier ones. Per date there is
    one span per check-out day, so a group is at most a calendar long."""
    spans = (
        paid.where(F.col("checked_out_at").isNotNull())
        .groupBy("user_id", "date", F.to_date("checked_out_at").alias("out"))
        .agg(F.min("known_at").alias("opened"))
        .join(users, "user_id", "left_semi")
    )
    earlier = W.partitionBy("user_id", "date").orderBy("opened", "out").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.max("out").over(earlier))
    events = []
    for n in HORIZONS:
        begin = F.greatest("opened", _leaves_horizon(F.col("reached"), n))
        end = _leaves_horizon(F.col("out"), n)
        counts = end > begin
        events += [
            event(F.when(counts, begin), f"paid_{n}d"),
            event(F.when(counts, end), f"paid_{n}d", -1),
        ]
    return events_of(spans, weekday(F.col("date")), events)


def paid_orders(orders: DataFrame, before: dt.date) -> DataFrame:
    """Paid orders that start before a date, with their day and the moment from which they count as paid."""
    start, out = F.col("start_at"), F.col("checked_out_at")
    return (
        orders.where(
            (F.col("workflow_state") == "paid")
            & F.col("deal_id").isNull()
            & F.col("confirmed_at").isNotNull()
            & (start < at_midnight(before))
        )
        .select("user_id", "start_at", "checked_out_at")
        .withColumns(
            {"date": F.to_date(start), "known_at": F.when(out.isNotNull(), F.greatest(start, out))}
        )
    )


def date_aggregates() -> list[Column]:
    """What the events of a user's paid date are made of, from the orders of that date."""
    start, out = F.col("start_at"), F.col("checked_out_at")
    still_open = {n: F.date_add(F.to_date(out), n) > F.col("date") for n in HORIZONS}
    return [
        F.min("known_at").alias("first_known"),
        F.min("start_at").alias("first_start"),
        F.max(F.to_date(out)).alias("last_out"),
        *[F.min(F.when(still_open[n], start)).alias(f"opens_{n}") for n in HORIZONS],
    ]


def date_events(horizons: bool = True) -> list[Column]:
    """The events of a paid date; counts by weekday are those of its orders."""
    return [
        event(F.col("first_known"), "paid_all"),
        event(F.col("first_start"), "paid_day", 0, F.col("date")),
        *(_horizon_events_plain() if horizons else []),
    ]


def _paid_events(orders: DataFrame, users: DataFrame, window: Window, strict_past: bool) -> DataFrame:
    """Orders are first aggregated per user and date, then restricted to the users
    of the window. In this order a user with very many orders is spread over
    dates when shuffled by user and date, and down to one row per date when
    shuffled by user. A list of users small enough to broadcast is applied
    before the aggregation all the same: the optimizer moves it there.
    """
    start, out = F.col("start_at"), F.col("checked_out_at")
    paid = paid_orders(orders, window.end)
    opening = at_midnight(window.start)
    per_date = (
        paid.groupBy("user_id", "date")
        .agg(*date_aggregates(), F.count_if(F.col("known_at") < opening).alias("known_before"))
        .join(users, "user_id", "left_semi")
    )
    dow = weekday(F.col("date"))
    before_window = F.when(F.col("known_before") > 0, opening - F.lit(ONE_MICROSECOND))
    known = event(before_window, "dow_paid", F.col("known_before"))
    events = events_of(per_date, dow, [*date_events(horizons=not strict_past), known])
    # orders that become known inside the window: few, and found by the pushed time filter;
    # nearly all belong to users of the window, so no join is spent on the others
    recent = paid.where(((start >= opening) | (out >= opening)) & (F.col("known_at") >= opening))
    events = events.unionByName(events_of(recent, dow, [event(F.col("known_at"), "dow_paid")]))
    return events.unionByName(_strict_horizon_events(paid, users)) if strict_past else events


def canceled_events(classified: DataFrame, fanout: str, strict_past: bool = False) -> DataFrame:
    """The events of classified cancellations."""
    start, canceled = F.col("start_at"), F.col("canceled_at")
    kept = classified.where(
        ~F.col("cancel_type").startswith(TRASH_PREFIX) & start.isNotNull() & canceled.isNotNull()
    ).withColumns({"known_at": F.greatest(start, canceled), "date": F.to_date(canceled)})
    known, date = F.col("known_at"), F.col("date")
    begin = known if strict_past else start
    copies = F.col("multiplicity") if fanout == "exact" else F.lit(1)
    events = [
        event(known, "canceled_all_nt", 1, date),
        event(F.when(F.col("cancel_type") == ONE_TIME, known), "canceled_onetime_nt", 1, date),
        event(known, "dow_canceled", copies),
    ]
    for n in HORIZONS:
        events += [
            event(begin, f"canceled_{n}d_nt"),
            event(F.greatest(begin, _leaves_horizon(date, n)), f"canceled_{n}d_nt", -1),
        ]
    return events_of(kept, weekday(start), events)


def history_measures(
    orders: DataFrame,
    classified: DataFrame,
    points: DataFrame,
    window: Window,
    fanout: str = "exact",
    strict_past: bool = False,
) -> DataFrame:
    """All history measures per distinct ``(user_id, start_at)`` of ``points``.

    ``fanout="exact"`` lets a cancellation weigh as many rows as its
    classification has in ``dow_canceled``; ``"dedup"`` counts it once.
    N-day counters also count what is paid or canceled after the order starts,
    unless ``strict_past`` is set.
    """
    if fanout not in ("exact", "dedup"):
        raise ValueError(f"fanout is 'exact' or 'dedup', not {fanout!r}")
    users = points.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    events = _paid_events(orders, users, window, strict_past).unionByName(
        canceled_events(classified.join(users, "user_id", "left_semi"), fanout, strict_past)
    )
    return point_in_time(events, points, window, MEASURES)


def history_columns(start: Column) -> list[Column]:
    """The measures of an order that starts at ``start``: zero counts and null days without history."""
    today = F.to_date(start)
    return [
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in [*COUNTS, *WEEKDAY_COUNTS]],
        F.datediff(today, "last_cancel_dt").alias("days_since_last_cancel_all_nt"),
        F.datediff(today, "last_onetime_dt").alias("days_since_last_cancel_onetime_nt"),
        F.datediff(today, "last_order_dt").alias("days_since_last_paid_order"),
        F.col("first_order_dt"),
        F.col("last_order_dt"),
    ]


def order_history(
    orders: DataFrame,
    classified: DataFrame,
    mode: str,
    window: Window,
    fanout: str = "exact",
    strict_past: bool = False,
) -> DataFrame:
    """One row per order of the population with all its history measures."""
    chosen = population(orders, mode, window).select("user_id", F.col("id").alias("order_id"), "start_at")
    measures = history_measures(orders, classified, chosen, window, fanout, strict_past)
    return chosen.join(measures, ["user_id", "start_at"], "left").select(
        "user_id", "order_id", weekday(F.col("start_at")).alias("dow"), *history_columns(F.col("start_at"))
    )


def orders_recency_info(history: DataFrame) -> DataFrame:
    """Counts and day distances over the whole earlier history."""
    return history.drop("dow", *WEEKDAY_COUNTS)


def dow_cleanings(history: DataFrame) -> DataFrame:
    """Counts over earlier orders on the same weekday."""
    return history.select("user_id", "order_id", "dow", *WEEKDAY_COUNTS)


def history_size(orders: DataFrame, classified: DataFrame, mode: str, window: Window) -> DataFrame:
    """How many earlier orders each order has, and how many classification rows join to them."""
    chosen = population(orders, mode, window).select("user_id", F.col("id").alias("order_id"), "start_at")
    users = chosen.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    start = F.col("start_at")
    earlier = orders.where(start < at_midnight(window.end)).select("user_id", "start_at")
    events = events_of(
        earlier.join(users, "user_id", "left_semi"), weekday(start), [event(start, "earlier_orders")]
    ).unionByName(
        events_of(
            classified.where(start.isNotNull()).join(users, "user_id", "left_semi"),
            weekday(start),
            [event(start, "classified_orders"), event(start, "classified_rows", F.col("multiplicity"))],
        )
    )
    names = ["earlier_orders", "classified_orders", "classified_rows"]
    totals = point_in_time(events, chosen, window, Measures(counts=names))
    return chosen.join(totals, ["user_id", "start_at"], "left").select(
        "order_id", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in names]
    )
