"""Table schemas, feature names, run windows, default parameters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# --- fixed values: input tables ---------------------------------------------

BOOLEAN_EXTRAS = [
    "refrigerator",
    "oven",
    "kitchen_cabinets",
    "tableware",
    "microwave",
    "keys_delivery",
    "consumables_and_equipment",
    "shower",
    "bedlinen",
    "wardrobe",
]
COUNTED_EXTRAS = ["windows", "ironing", "balconies", "cat_litter_box", "lustre"]


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _TEXT, _TIME = T.LongType(), T.StringType(), T.TimestampNTZType()

TABLE_SCHEMAS = {
    "orders": _struct(
        id=_LONG,
        user_id=_LONG,
        workflow_state=_TEXT,
        deal_id=_LONG,
        confirmed_at=_TIME,
        created_at=_TIME,
        start_at=_TIME,
        checked_out_at=_TIME,
        canceled_at=_TIME,
        subscription_id=_LONG,
        address_id=_LONG,
        creation_mean=_TEXT,
        payment_type=_TEXT,
        total_cents=_LONG,
        subtotal_cents=_LONG,
        hot=T.BooleanType(),
        notice=_TEXT,
        **{name: T.BooleanType() for name in BOOLEAN_EXTRAS},
        **{name: T.IntegerType() for name in COUNTED_EXTRAS},
    ),
    "order_reminders": _struct(order_id=_LONG, perform_at=_TIME, status=_TEXT, result=_TEXT),
    "deltas": _struct(user_id=_LONG, model_id=_LONG, model_type=_TEXT, object=_TEXT, created_at=_TIME),
    "diffs": _struct(subject_id=_LONG, subject_type=_TEXT, differences=_TEXT),
    "subscriptions": _struct(id=_LONG, deactivated_at=_TIME),
    "users_roles": _struct(user_id=_LONG),
    "addresses": _struct(id=_LONG, lat=T.DoubleType(), lng=T.DoubleType()),
    "web_events": _struct(user_id=_LONG, app_id=_TEXT, collector_tstamp=_TIME, contexts=_TEXT),
    "segment_uploads": _struct(tracking_id=_TEXT, segments=_TEXT, date=_TIME),
}

# --- fixed values: the feature matrix ---------------------------------------

_DOUBLE, _INT = T.DoubleType(), T.IntegerType()

MATRIX_SCHEMA = _struct(
    order_id=_LONG,
    total_cents=_LONG,
    subtotal_cents=_LONG,
    discount=_LONG,
    discount_prc=_DOUBLE,
    cash_flg=_INT,
    auto_flg=_INT,
    dow=_INT,
    hot=_INT,
    additionals_num=_INT,
    day_slot_flg=_INT,
    has_comment=_INT,
    subscription_flg=_INT,
    lat=_DOUBLE,
    lng=_DOUBLE,
    creation_start_hours=_DOUBLE,
    cancel=_INT,
    paid_all=_LONG,
    canceled_all_nt=_LONG,
    canceled_all_nt_share=_DOUBLE,
    paid_16d=_LONG,
    paid_30d=_LONG,
    paid_60d=_LONG,
    canceled_16d_nt=_LONG,
    canceled_30d_nt=_LONG,
    canceled_60d_nt=_LONG,
    shifts_num=_LONG,
    canceled_onetime_nt=_LONG,
    days_since_last_cancel_all_nt=_INT,
    days_since_last_cancel_onetime_nt=_INT,
    days_since_last_paid_order=_INT,
    dow_paid=_LONG,
    dow_canceled=_LONG,
    dow_paid_share=_DOUBLE,
    dow_all_paid_share=_DOUBLE,
)

ID_COLUMNS = ["order_id", "cancel", "dow"]  # dropped before fitting
FEATURES = [name for name in MATRIX_SCHEMA.names if name not in ID_COLUMNS]  # 32 names
MEAN_FILLED = ["shifts_num", "dow_paid_share"]  # filled with the column mean
TRAIN_FILL, SCORE_FILL = -999.0, 0.0  # what remains null in training / in scoring

POWER_COLUMNS = [
    "paid_all",
    "canceled_all_nt",
    "paid_16d",
    "paid_30d",
    "paid_60d",
    "canceled_16d_nt",
    "canceled_30d_nt",
    "canceled_60d_nt",
    "dow_paid",
    "dow_canceled",
]

# --- fixed values: history horizons, in days ---------------------------------

HORIZONS = [16, 30, 60]

# --- fixed values: run windows ------------------------------------------------


@dataclass(frozen=True)
class Window:
    """Half-open range of order start dates: ``start <= date < end``."""

    start: dt.date
    end: dt.date

    @classmethod
    def next_days(cls, as_of: dt.date | None = None, days: int = 8) -> "Window":
        """The scoring horizon: ``days`` days from ``as_of`` (when not given, today in the session's time zone)."""
        first = as_of or SparkSession.active().sql("SELECT current_date()").first()[0]
        return cls(first, first + dt.timedelta(days=days))


TRAIN = Window(dt.date(2017, 1, 1), dt.date(2017, 6, 20))
VALIDATION = Window(dt.date(2017, 6, 20), dt.date(2017, 7, 4))
SEGMENT_TRAIN = Window(dt.date(2017, 7, 7), dt.date(2017, 8, 8))
