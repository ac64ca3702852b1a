"""Single facts about past orders: reminders, logged changes, subscription ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlore.functions.json import changed_value, may_contain, unpack_changes
from orderlore.operators.joins import join_spread


def latest_reminder(reminders: DataFrame) -> DataFrame:
    """The reminder with the latest time per order; a missing time counts as latest.

    Filtering ``row_number() = 1`` makes Spark keep one row per order already
    before the shuffle, so an order with very many reminders costs nothing extra.
    """
    newest = W.partitionBy("order_id").orderBy(F.desc_nulls_first("perform_at"), "status", "result")
    return (
        reminders.select("order_id", "perform_at", "status", "result")
        .withColumn("place", F.row_number().over(newest))
        .where("place = 1")
        .drop("place")
    )


def _order_log(deltas: DataFrame) -> DataFrame:
    return deltas.where(F.col("model_type") == "Order").withColumnRenamed("model_id", "order_id")


def unpacked_deltas(deltas: DataFrame, orders: DataFrame) -> DataFrame:
    """Logged field changes of paid and canceled orders that have no deal."""
    eligible = orders.where(F.col("deal_id").isNull() & F.col("workflow_state").isin("paid", "canceled"))
    log = _order_log(deltas).join(eligible.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    return unpack_changes(log, "object", "user_id", "order_id", "created_at").select(
        "user_id", "order_id", "field_name", "field_value", "created_at"
    )


def logged_cancellations(deltas: DataFrame, orders: DataFrame) -> DataFrame:
    """The logged changes that set an order to canceled."""
    mentions = may_contain(F.col("object"), "workflow_state")
    return unpacked_deltas(deltas.where(mentions), orders).where(
        (F.col("field_name") == "workflow_state") & (F.col("field_value") == "canceled")
    )


def change_summary(deltas: DataFrame) -> DataFrame:
    """Per order and author: how often the order was set to canceled and how often it was moved.

    One pass over the change log serves the classification and the shift
    counts. Documents are parsed where they lie and only counts are shuffled.
    """
    canceled = (F.col("field_name") == "workflow_state") & (F.col("field_value") == "canceled")
    moved = F.col("field_name") == "start_at"
    mentions = may_contain(F.col("object"), "workflow_state") | may_contain(F.col("object"), "start_at")
    return (
        unpack_changes(_order_log(deltas).where(mentions), "object", "order_id", "user_id")
        .where(canceled | moved)
        .groupBy("order_id", "user_id")
        .agg(F.count_if(canceled).alias("cancellations"), F.count_if(moved).alias("moves"))
    )


def crm_cancellations(diffs: DataFrame) -> DataFrame:
    """One row per change set that turned an order's state to canceled."""
    mentions = may_contain(F.col("differences"), "workflow_state") & may_contain(F.col("differences"), "canceled")
    return (
        diffs.where((F.col("subject_type") == "Order") & mentions)
        .where(changed_value(F.col("differences"), "workflow_state").contains("canceled"))
        .select(F.col("subject_id").alias("order_id"))
    )


def _cancellations_after_end(subscriptions: DataFrame, orders: DataFrame) -> DataFrame:
    """Canceled orders of ended subscriptions, canceled at the end or later."""
    ended = subscriptions.where(F.col("deactivated_at").isNotNull()).select(
        F.col("id").alias("subscription_id"), "deactivated_at"
    )
    canceled = orders.where((F.col("workflow_state") == "canceled") & F.col("subscription_id").isNotNull()).select(
        F.col("id").alias("order_id"), "subscription_id", "start_at", "canceled_at"
    )
    joined = join_spread(canceled, ended, "subscription_id", "order_id")
    return joined.where(F.col("canceled_at") >= F.col("deactivated_at"))


def subscription_cancel_rank(subscriptions: DataFrame, orders: DataFrame) -> DataFrame:
    """Rank of those orders inside their subscription, latest start first, ties sharing a rank.

    Two levels instead of one window per subscription, which could be huge:
    the number of orders on later days comes from per-day counts (at most one
    row per calendar day), the place inside the day from a window over the day.
    Orders without a start all rank 1, so they need no common window.
    """
    rows = _cancellations_after_end(subscriptions, orders).withColumn("day", F.to_date("start_at"))
    later_days = (
        W.partitionBy("subscription_id").orderBy(F.desc_nulls_first("day")).rowsBetween(W.unboundedPreceding, -1)
    )
    ahead = (
        rows.groupBy("subscription_id", "day")
        .agg(F.count("*").alias("n"))
        .withColumn("ahead", F.sum("n").over(later_days))
        .where(F.col("day").isNotNull())
        .drop("n")
    )
    undated_apart = F.when(F.col("day").isNull(), F.col("order_id"))
    inside_day = W.partitionBy("subscription_id", "day", undated_apart).orderBy(F.desc("start_at"))
    place = F.rank().over(inside_day) + F.coalesce("ahead", F.lit(0))
    return rows.join(ahead, ["subscription_id", "day"], "left").select(
        "order_id", "subscription_id", place.cast("long").alias("sub_cancel_num")
    )


def subscription_ends(subscriptions: DataFrame, orders: DataFrame) -> DataFrame:
    """Per subscription its end and the start of its rank-1 cancellations.

    Rank 1 is all the classification asks for, and that is an aggregate: the
    greatest start, or no start at all if one is missing.
    """
    first = (
        _cancellations_after_end(subscriptions, orders)
        .groupBy("subscription_id")
        .agg(
            F.max("start_at").alias("top_start"),
            F.max(F.col("start_at").isNull()).alias("top_undated"),
        )
        .withColumnRenamed("subscription_id", "id")
    )
    return subscriptions.join(first, "id", "left")
