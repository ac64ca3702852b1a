"""Small literal tables. Times are given as text, missing columns get defaults."""

from __future__ import annotations

import datetime as dt

from orderlore.sources.schemas import BOOLEAN_EXTRAS, COUNTED_EXTRAS, TABLE_SCHEMAS
from orderlore.sources.tables import Tables

ORDER = {
    "user_id": 1,
    "workflow_state": "paid",
    "deal_id": None,
    "confirmed_at": "2017-01-01 00:00:00",
    "created_at": "2017-01-01 00:00:00",
    "start_at": None,
    "checked_out_at": None,
    "canceled_at": None,
    "subscription_id": None,
    "address_id": None,
    "creation_mean": "manual",
    "payment_type": "card",
    "total_cents": 100,
    "subtotal_cents": 100,
    "hot": False,
    "notice": None,
    **{name: False for name in BOOLEAN_EXTRAS},
    **{name: 0 for name in COUNTED_EXTRAS},
}


def _value(value, kind):
    if isinstance(value, str) and kind == "timestamp_ntz":
        return dt.datetime.fromisoformat(value)
    return value


def table(spark, name: str, *rows: dict):
    schema = TABLE_SCHEMAS[name]
    defaults = ORDER if name == "orders" else {}
    data = [
        tuple(_value({**defaults, **row}.get(f.name), f.dataType.simpleString()) for f in schema) for row in rows
    ]
    return spark.createDataFrame(data, schema)


def tables(spark, **rows) -> Tables:
    """All nine tables, the unnamed ones empty."""
    return Tables.of(**{name: table(spark, name, *rows.get(name, [])) for name in TABLE_SCHEMAS})
