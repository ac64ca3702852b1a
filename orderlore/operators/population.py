"""Which orders a matrix describes, and what is known about each of them alone."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlore.functions.columns import flag, rounded_hours, share, weekday
from orderlore.operators.joins import left_join_nullable
from orderlore.sources.schemas import BOOLEAN_EXTRAS, COUNTED_EXTRAS, Window

LATE_CANCEL_DAYS = 7  # fixed value: earlier cancellations are not trained on
DAY_SLOT = (8, 12)  # fixed value: start hours of the day slot, both included


def at_midnight(date: dt.date) -> Column:
    """A literal, so that it reaches the scan as a pushed filter."""
    return F.lit(date.isoformat()).cast("timestamp_ntz")


def population(orders: DataFrame, mode: str, window: Window) -> DataFrame:
    """Orders in the window that are trained on (``train``) or scored (``predict``)."""
    start, state = F.col("start_at"), F.col("workflow_state")
    inside = (
        (start >= at_midnight(window.start))
        & (start < at_midnight(window.end))
        & F.col("deal_id").isNull()
        & F.col("confirmed_at").isNotNull()
    )
    if mode == "train":
        canceled = F.col("canceled_at")
        late = canceled.isNull() | (F.datediff(start, canceled) < LATE_CANCEL_DAYS)
        return orders.where(inside & state.isin("paid", "canceled") & late)
    if mode == "predict":
        return orders.where(inside & (state != "canceled") & (state != "hidden"))
    raise ValueError(f"mode is 'train' or 'predict', not {mode!r}")


def _additionals() -> Column:
    ordered = [F.col(name) for name in BOOLEAN_EXTRAS] + [F.col(name) > 0 for name in COUNTED_EXTRAS]
    return reduce(add, [flag(extra) for extra in ordered])


def orders_general_info(
    orders: DataFrame, addresses: DataFrame, mode: str, window: Window, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Features of the order itself; ``keep`` names further order columns to carry along."""
    total, subtotal, start = F.col("total_cents"), F.col("subtotal_cents"), F.col("start_at")
    discount = subtotal - total
    own = [
        F.col("id").alias("order_id"),
        total,
        subtotal,
        discount.alias("discount"),
        share(discount, subtotal, F.lit(1.0)).alias("discount_prc"),
        flag(F.col("payment_type") == "cash").alias("cash_flg"),
        flag(F.col("creation_mean") == "auto").alias("auto_flg"),
        weekday(start).alias("dow"),
        flag(F.col("hot")).alias("hot"),
        _additionals().alias("additionals_num"),
        flag(F.hour(start).between(*DAY_SLOT)).alias("day_slot_flg"),
        flag(F.col("notice").isNotNull()).alias("has_comment"),
        flag(F.col("subscription_id").isNotNull()).alias("subscription_flg"),
    ]
    lead = rounded_hours(start, F.col("created_at")).alias("creation_start_hours")
    target = [flag(F.col("canceled_at").isNotNull()).alias("cancel")] if mode == "train" else []
    narrow = population(orders, mode, window).select(*own, lead, *target, "address_id", *keep)
    places = addresses.select(F.col("id").alias("place_id"), "lat", "lng")
    placed = left_join_nullable(narrow, places, "address_id", "place_id", "order_id")
    names = [c for c in narrow.columns if c not in ("creation_start_hours", "cancel", "address_id", *keep)]
    return placed.select(*names, "lat", "lng", "creation_start_hours", *(["cancel"] if target else []), *keep)


def shift_counts(changes: DataFrame) -> DataFrame:
    """Moves of an order after its first start was set, for orders with any logged start.

    ``changes`` is the change summary: counts are made before orders are
    compared, so the documents themselves are never shuffled.
    """
    moves = changes.where("moves > 0").groupBy("order_id").agg(F.sum("moves").alias("moves"))
    return moves.select("order_id", (F.col("moves") - 1).cast("long").alias("shifts_num"))


def order_shifts(changes: DataFrame, chosen: DataFrame) -> DataFrame:
    """The shift counts of chosen orders."""
    return shift_counts(changes).join(chosen.select("order_id"), "order_id", "left_semi")
