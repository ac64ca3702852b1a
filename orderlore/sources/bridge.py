"""The supplied star-schema tables in the shape of the order-history tables.

Only integer arithmetic on keys, so that the SQL check can repeat it. Fixed
values throughout: this is a definition, not logic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.sources.schemas import TABLE_SCHEMAS
from orderlore.sources.tables import Tables, conform


def _hours(time, n):
    return F.timestamp_add("HOUR", n, time)


def _minutes(time, n):
    return F.timestamp_add("MINUTE", n, time)


def orders(raw: DataFrame) -> DataFrame:
    k, user = F.col("o_orderkey"), F.col("o_custkey")
    day = F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")) % 240
    epoch = F.lit("2017-01-01 00:00:00").cast("timestamp_ntz")
    state = F.col("o_orderstatus")
    total = F.round(F.col("o_totalprice") * 100).cast("long")
    flags = {
        "refrigerator": 2,
        "oven": 3,
        "kitchen_cabinets": 5,
        "microwave": 9,
        "keys_delivery": 10,
        "consumables_and_equipment": 12,
        "shower": 14,
        "bedlinen": 15,
        "wardrobe": 16,
    }
    counts = {"windows": 4, "ironing": 5, "balconies": 6, "cat_litter_box": 8, "lustre": 10}
    base = raw.select(
        k.alias("id"),
        user.alias("user_id"),
        F.when(state == "F", "paid")
        .when(state == "O", "canceled")
        .otherwise(F.when(k % 4 == 0, "hidden").otherwise("scheduled"))
        .alias("workflow_state"),
        F.when(k % 19 == 0, k).alias("deal_id"),
        F.when(k % 3 != 0, user).alias("subscription_id"),
        F.when(k % 31 != 0, user).alias("address_id"),
        _hours(epoch, 24 * day + 7 + k % 12).alias("start_at"),
        _minutes(epoch, 1440 * day - (k * 37) % 20000).alias("created_at"),
        F.when((k * 7) % 5 == 0, "auto").otherwise("manual").alias("creation_mean"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "cash").otherwise("card").alias("payment_type"),
        total.alias("total_cents"),
        F.when(k % 97 == 0, F.lit(0).cast("long"))
        .when(k % 89 == 0, F.lit(None).cast("long"))
        .otherwise(total + (k % 7) * 1000)
        .alias("subtotal_cents"),
        (k % 11 == 0).alias("hot"),
        F.when(k % 13 == 1, "note").alias("notice"),
        F.when(k % 43 != 0, k % 7 == 0).alias("tableware"),
        *[(k % n == 0).alias(name) for name, n in flags.items()],
        *[(k % n).cast("int").alias(name) for name, n in counts.items()],
    )
    key, canceled, paid = F.col("id"), F.col("workflow_state") == "canceled", F.col("workflow_state") == "paid"
    dated = base.withColumns(
        {
            "confirmed_at": F.when(key % 23 != 0, F.col("created_at")),
            "checked_out_at": F.when(paid, _hours(F.col("start_at"), F.when(key % 7 == 0, key % 960).otherwise(3))),
            "canceled_at": F.when(canceled & (key % 6 < 2), _minutes(F.col("created_at"), (key * 11) % 14))
            .when(canceled, _hours(F.col("start_at"), -((key * 17) % 264)))
            .when(paid & (key % 41 == 0), _hours(F.col("start_at"), F.lit(-30))),
        }
    )
    return dated.select(*TABLE_SCHEMAS["orders"].names)


def subscriptions(customer: DataFrame, bridged: DataFrame) -> DataFrame:
    ends = (
        bridged.where(F.col("workflow_state") == "canceled")
        .where(F.col("subscription_id").isNotNull())
        .groupBy("subscription_id")
        .agg(F.max("canceled_at").alias("last_cancel"), F.min("canceled_at").alias("first_cancel"))
    )
    kind = F.col("c_custkey") % 4
    return customer.join(ends, F.col("c_custkey") == F.col("subscription_id"), "left").select(
        F.col("c_custkey").alias("id"),
        F.when(kind == 1, F.col("last_cancel"))
        .when(kind == 2, F.col("first_cancel"))
        .when(kind == 3, F.lit("2017-04-01 12:00:00").cast("timestamp_ntz"))
        .alias("deactivated_at"),
    )


def order_reminders(lineitem: DataFrame, bridged: DataFrame) -> DataFrame:
    times = bridged.select("id", F.coalesce("canceled_at", "start_at").alias("anchor"))
    # short codes meet the orders, so the texts are not shuffled
    coded = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_suppkey") % 29 != 0, 3 - F.col("l_partkey") % 25).cast("byte").alias("minutes"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2).cast("byte").alias("status"),
        F.coalesce(F.col("l_linestatus") == "F", F.lit(False)).alias("canceled"),
    )
    status, minutes = F.col("status"), F.col("minutes").cast("long")
    return coded.join(times, F.col("order_id") == F.col("id")).select(
        "order_id",
        _minutes(F.col("anchor"), minutes).alias("perform_at"),
        F.when(status == 0, "failed").when(status == 1, "success").otherwise("pending").alias("status"),
        F.when(F.col("canceled"), "order_canceled").otherwise("handled_by_call_center").alias("result"),
    )


def deltas(lineitem: DataFrame) -> DataFrame:
    moved = F.concat(F.lit('[{"name":"start_at","object":"'), F.col("l_partkey").cast("string"), F.lit('"}]'))
    document = (
        F.when(F.col("l_returnflag") == "N", F.lit("[]"))
        .when(F.col("l_returnflag") == "R", moved)
        .otherwise(F.lit('[{"name":"start_at","object":null},{"name":"workflow_state","object":"canceled"}]'))
    )
    return lineitem.select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_orderkey").alias("model_id"),
        F.when(F.col("l_linenumber") < 7, "Order").otherwise("User").alias("model_type"),
        document.alias("object"),
        F.col("l_shipdate").alias("created_at"),
    )


def diffs(lineitem: DataFrame) -> DataFrame:
    document = F.when(
        F.col("l_returnflag") == "A", F.lit('{"workflow_state":["paid","canceled"],"total_cents":[1,2]}')
    ).otherwise(F.lit('{"total_cents":[1,2]}'))
    return lineitem.where(F.col("l_linenumber") <= 2).select(
        F.col("l_orderkey").alias("subject_id"),
        F.when(F.col("l_suppkey") % 7 == 0, "User").otherwise("Order").alias("subject_type"),
        document.alias("differences"),
    )


def users_roles(supplier: DataFrame) -> DataFrame:
    copies = F.when(F.col("s_suppkey") % 5 == 0, 2).otherwise(1)
    return supplier.select(F.explode(F.array_repeat(F.col("s_suppkey"), copies)).alias("user_id"))


def addresses(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("id"),
        (F.lit(55.5) + (key % 1000).cast("double") / 1000).alias("lat"),
        (F.lit(37.3) + (key % 777).cast("double") / 1000).alias("lng"),
    )


def web_events(events: DataFrame) -> DataFrame:
    tracking = F.get_json_object("props", "$.k")
    return events.select(
        "user_id",
        F.when(F.col("event_type").isin("view", "click"), "web").otherwise("other").alias("app_id"),
        F.col("ts").alias("collector_tstamp"),
        F.to_json(F.struct(tracking.alias("tracking_id"))).alias("contexts"),
    )


def segment_uploads(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") != "error").select(
        F.get_json_object("props", "$.k").alias("tracking_id"),
        F.concat_ws(
            "/",
            "event_type",
            (F.col("event_id") % 50).cast("string"),
            (F.col("event_id") % 7).cast("string"),
        ).alias("segments"),
        F.col("ts").alias("date"),
    )


# fixed values: what counts as the web application in the bridged events, and since when
WEB_APP, WEB_SINCE = "web", "2024-01-10"


def bridge(spark: SparkSession, folder: str) -> Tables:
    """All nine order-history tables, derived from the Parquet files in ``folder``."""

    raw = {
        name: spark.read.parquet(f"{folder}/{name}.parquet")
        for name in ("orders", "customer", "lineitem", "supplier", "events")
    }
    bridged = conform(orders(raw["orders"]), "orders")
    return Tables.of(
        orders=bridged,
        subscriptions=subscriptions(raw["customer"], bridged),
        order_reminders=order_reminders(raw["lineitem"], bridged),
        deltas=deltas(raw["lineitem"]),
        diffs=diffs(raw["lineitem"]),
        users_roles=users_roles(raw["supplier"]),
        addresses=addresses(raw["customer"]),
        web_events=web_events(raw["events"]),
        segment_uploads=segment_uploads(raw["events"]),
    )
