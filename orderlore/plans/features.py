"""The feature matrices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlore.functions.columns import share
from orderlore.operators.classification import classified_orders
from orderlore.operators.joins import left_join_nullable
from orderlore.operators.history import change_summary
from orderlore.operators.population import orders_general_info, population, shift_counts
from orderlore.operators.recency import history_columns, history_measures
from orderlore.operators.state import HistoryState, state_measures
from orderlore.operators.segments import latest_segments, trackings, user_segments
from orderlore.sources.schemas import MATRIX_SCHEMA, Window


def _matrix(tables, mode, window, fanout, strict_past, classified, changes, state=None) -> DataFrame:
    orders = tables["orders"]
    changes = change_summary(tables["deltas"]) if changes is None else changes
    classified = classified_orders(tables, changes) if classified is None else classified
    general = orders_general_info(orders, tables["addresses"], mode, window, keep=("user_id", "start_at"))
    points = population(orders, mode, window).select("user_id", "start_at")
    if state is None:
        measures = history_measures(orders, classified, points, window, fanout, strict_past)
    else:
        measures = state_measures(state, orders, classified, points, window)
    joined = (
        general.join(measures, ["user_id", "start_at"], "left")
        .select(general.columns + history_columns(F.col("start_at")))
        .join(shift_counts(changes), "order_id", "left")
    )
    paid, canceled = F.col("paid_all"), F.col("canceled_all_nt")
    on_weekday, none = F.col("dow_paid"), F.lit(None).cast("double")
    full = joined.withColumns(
        {
            "canceled_all_nt_share": F.when(canceled != 0, share(canceled, paid + canceled, none)).otherwise(0.0),
            "dow_paid_share": share(on_weekday, on_weekday + F.col("dow_canceled"), none),
            "dow_all_paid_share": share(on_weekday, paid, none),
        }
    )
    fields = [f for f in MATRIX_SCHEMA if f.name != "cancel" or mode == "train"]
    return full.select("user_id", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def feature_matrix(
    tables,
    mode: str,
    window: Window,
    fanout: str = "exact",
    strict_past: bool = False,
    classified: DataFrame | None = None,
    changes: DataFrame | None = None,
    state: HistoryState | None = None,
) -> DataFrame:
    """One row per order of the window: 35 columns to train on, 34 to score (no target).

    ``classified`` and ``changes`` take stored results of
    ``classified_orders`` and ``change_summary``; without them the two are
    part of this plan. With a ``state`` of the window's first day, as
    ``advance_state`` leaves it, history is not computed from all orders anew.
    """
    if state is not None and (strict_past or state.fanout != fanout):
        raise ValueError("a state has its own fanout and does not go with strict_past")
    return _matrix(tables, mode, window, fanout, strict_past, classified, changes, state).drop("user_id")


def feature_matrix_segments(
    tables,
    window: Window,
    app_id: str,
    since: str | dt.date,
    dedupe: str = "none",
    fanout: str = "exact",
    strict_past: bool = False,
    classified: DataFrame | None = None,
    changes: DataFrame | None = None,
) -> DataFrame:
    """The training matrix with the audience segments of the order's user.

    ``dedupe="none"``: one row per order and tracking id of its user;
    ``"latest"``: one row per order, with the most recent segments.
    Tracking ids get their segments before they meet the orders, so users
    without a tracking id never become null keys of a second join.
    """
    matrix = _matrix(tables, "train", window, fanout, strict_past, classified, changes)
    tracked = trackings(tables["web_events"], app_id, since)
    segments = user_segments(tracked, latest_segments(tables["segment_uploads"]), dedupe)
    return left_join_nullable(matrix, segments, "user_id", "user_id", "order_id").drop("user_id")
