"""What derivation and spread joins move: tables that are read, short codes, no guessed broadcasts."""

import datetime as dt

from pyspark.sql import functions as F

from orderlore.operators.joins import join_spread
from orderlore.plans import registry
from orderlore.sources import bridge
from orderlore.sources.tables import Tables

DAY = dt.datetime(2017, 1, 2)


def _plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_a_query_derives_only_the_tables_that_it_reads(spark, monkeypatch):
    derived = Tables.of(**{t: spark.range(1).select(F.lit(t).alias("name")) for t in ("orders", "web_events")})
    built = []
    monkeypatch.setattr(registry, "_stored", {})
    monkeypatch.setattr(registry, "bridge", lambda spark, folder: _Plain(derived))
    monkeypatch.setattr(registry, "fingerprint", lambda *a: "name")
    monkeypatch.setattr(registry, "reused", lambda spark, purpose, name, build: built.append(purpose) or build())
    monkeypatch.setattr("orderlore.sources.tables.conform", lambda df, name: df)
    tables = registry.tables_of(spark, "folder")
    assert set(tables) == {"orders", "web_events"} and built == []
    assert tables["orders"].first().name == "orders"
    assert registry.tables_of(spark, "folder")["orders"].first().name == "orders"
    assert built == ["table-orders"]


class _Plain(dict):
    """Tables without declared schemas."""

    def __init__(self, tables):
        super().__init__({t: opener() for t, opener in tables._openers.items()})


def test_reminders_shuffle_codes_and_keep_their_values(spark):
    lineitem = spark.createDataFrame(
        [
            (1, 30, 1, "A", "F"),
            (1, -24, 2, "R", "O"),
            (1, 7, 29, "N", None),
            (2, None, 1, None, "F"),
            (2, 3, None, "X", "f"),
            (9, 1, 1, "A", "F"),
            (None, 1, 1, "A", "F"),
        ],
        "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string",
    )
    orders = spark.createDataFrame(
        [(1, DAY, None), (2, DAY, DAY + dt.timedelta(hours=1)), (None, DAY, DAY)],
        "id long, start_at timestamp_ntz, canceled_at timestamp_ntz",
    )
    got = bridge.order_reminders(lineitem, orders)
    cc, minute = "handled_by_call_center", dt.timedelta(minutes=1)
    assert sorted(got.collect(), key=str) == sorted(
        [
            (1, DAY - 2 * minute, "failed", "order_canceled"),
            (1, DAY + 27 * minute, "success", cc),
            (1, None, "pending", cc),
            (2, None, "pending", "order_canceled"),
            (2, None, "pending", cc),
        ],
        key=lambda r: str(spark.createDataFrame([r], got.schema).first()),
    )
    above, below = _plan(got, "optimizedPlan").split("Join Inner", 1)
    assert "l_returnflag" in below and "l_returnflag" not in above and "l_linestatus" not in above


def test_copies_of_a_spread_join_are_not_broadcast(spark):
    entities = spark.range(50).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    facts = spark.range(1_000).select("id", (F.col("id") % 60).alias("key"))
    joined = join_spread(facts, entities, "key", "id")
    assert "BroadcastExchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    assert {tuple(r) for r in joined.select("id", "key", "value").collect()} == {
        (i, i % 60, 2 * (i % 60)) for i in range(1_000) if i % 60 < 50
    }
