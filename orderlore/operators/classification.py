"""Why an order was canceled."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlore.functions.columns import within
from orderlore.operators.history import change_summary, crm_cancellations, latest_reminder, subscription_ends
from orderlore.operators.joins import left_join_nullable

SHORTLY = dt.timedelta(minutes=10)  # fixed value: a cause counts for ten minutes

TRASH_PREFIX = "trash"
ONE_TIME = "one-time"


def _cancel_type() -> Column:
    """First rule that holds. Labels and their conditions are fixed values."""
    canceled, ended = F.col("canceled_at"), F.col("deactivated_at")
    on_end_date = F.to_date(ended) == F.to_date(canceled)
    called = within(canceled, F.col("perform_at"), SHORTLY)
    answered = called & (F.col("status") == "success")
    latest_start = F.when(F.col("top_undated"), F.col("start_at").isNull()).otherwise(
        F.col("start_at") == F.col("top_start")
    )
    rules = [
        ("trash_autosubscr", (F.col("creation_mean") == "auto") & within(canceled, F.col("created_at"), SHORTLY)),
        ("ivr-auto", called & (F.col("status") == "failed")),
        ("ivr-user", answered & (F.col("result") == "order_canceled")),
        ("ivr-cc", answered & (F.col("result") == "handled_by_call_center")),
        (ONE_TIME, F.col("subscription_id").isNull()),
        ("subscr_cancel", on_end_date & (canceled >= ended) & latest_start),
        ("trash_subscr", on_end_date),
        ("part-subscr", ended.isNull() | (F.to_date(ended) > F.to_date(canceled))),
    ]
    label = F.when(rules[0][1], rules[0][0])
    for name, rule in rules[1:]:
        label = label.when(rule, name)
    return label.otherwise("unknown")


def _log_rows(changes: DataFrame, roles: DataFrame) -> DataFrame:
    """Rows per order that logged cancellations make once joined to their authors' roles."""
    several = roles.groupBy("user_id").agg(F.count("*").alias("roles")).where("roles > 1")
    logged = changes.where("cancellations > 0").select("order_id", "user_id", "cancellations")
    joined = left_join_nullable(logged, several.withColumnRenamed("user_id", "author"), "user_id", "author", "order_id")
    rows = F.col("cancellations") * F.coalesce("roles", F.lit(1))
    return joined.groupBy("order_id").agg(F.sum(rows).alias("log_rows"))


def classified_orders(tables, changes: DataFrame | None = None) -> DataFrame:
    """One row per canceled order: its cancel type and how many rows it stands for.

    Log entries, roles and CRM changes do not influence the type; joining them
    only repeats an order. Here they are counted per order before they meet the
    orders, and the product of the counts is kept as ``multiplicity``.

    All order-keyed inputs are aggregated to one row per order first, so the
    joins share one partitioning of the canceled orders.
    """
    orders = tables["orders"]
    canceled = orders.where(
        (F.col("workflow_state") == "canceled") & F.col("confirmed_at").isNotNull() & F.col("deal_id").isNull()
    ).select("id", "user_id", "subscription_id", "creation_mean", "created_at", "start_at", "canceled_at")
    ends = subscription_ends(tables["subscriptions"], orders)
    changes = change_summary(tables["deltas"]) if changes is None else changes
    crm = crm_cancellations(tables["diffs"]).groupBy("order_id").agg(F.count("*").alias("crm_rows"))

    facts = left_join_nullable(canceled, ends.withColumnRenamed("id", "ended_id"), "subscription_id", "ended_id", "id")
    facts = facts.withColumnRenamed("id", "order_id")
    for per_order in (latest_reminder(tables["order_reminders"]), _log_rows(changes, tables["users_roles"]), crm):
        facts = facts.join(per_order, "order_id", "left")
    multiplicity = F.coalesce("log_rows", F.lit(1)) * F.coalesce("crm_rows", F.lit(1))
    return facts.select(
        "order_id",
        _cancel_type().alias("cancel_type"),
        multiplicity.cast("long").alias("multiplicity"),
        "user_id",
        "start_at",
        "canceled_at",
    )


def classification_fanout(classified: DataFrame) -> DataFrame:
    """The classification in compact form: type and number of equal rows per order."""
    return classified.select("order_id", "cancel_type", "multiplicity")


_COPIES_PER_CHUNK = 4096


def explode_multiplicity(classified: DataFrame) -> DataFrame:
    """The classification as a table with repeated rows.

    Copies are made in chunks that are spread over all tasks first, so an order
    that stands for very many rows is neither one array nor one task's output.
    """
    size = F.lit(_COPIES_PER_CHUNK)
    last_chunk = F.floor((F.col("multiplicity") - 1) / size)
    chunks = classified.select(
        "order_id", "cancel_type", "multiplicity", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("chunk")
    ).repartition("order_id", "chunk")
    in_chunk = F.least(size, F.col("multiplicity") - F.col("chunk") * size).cast("int")
    copies = F.explode(F.sequence(F.lit(1), in_chunk)).alias("copy")
    return chunks.select("order_id", "cancel_type", copies).drop("copy")
