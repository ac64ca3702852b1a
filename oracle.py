"""SQL texts for DuckDB that compute the registered queries independently.

Written from the definitions, in the plain form: pairs of orders, direct
distinct counts, literal fan-out joins. Each text is assembled from named
parts; a part lists the parts it reads.
"""

from __future__ import annotations

from orderlore.sources.schemas import BOOLEAN_EXTRAS, COUNTED_EXTRAS, FEATURES, MATRIX_SCHEMA

PARTS: dict[str, tuple[list[str], str]] = {}


def part(name: str, needs: str, text: str) -> None:
    PARTS[name] = (needs.split(), text)


def sql(needs: str, final: str) -> str:
    """The final statement after a WITH list of everything it needs, in order of need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in PARTS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in ordered) + "\n" + final


# --- the bridge: order-history tables from the supplied tables -----------------

_FLAGS = {
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
_COUNTS = {"windows": 4, "ironing": 5, "balconies": 6, "cat_litter_box": 8, "lustre": 10}

part(
    "keyed",
    "",
    """
    SELECT o_orderkey AS k, o_custkey AS u, o_orderstatus AS s, o_orderpriority AS p,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
           (CAST(o_orderdate AS DATE) - DATE '1995-01-01') % 240 AS day_no
    FROM orders""",
)
part(
    "undated",
    "keyed",
    f"""
    SELECT k AS id, u AS user_id,
           CASE s WHEN 'F' THEN 'paid' WHEN 'O' THEN 'canceled'
                  ELSE CASE k % 4 WHEN 0 THEN 'hidden' ELSE 'scheduled' END END AS workflow_state,
           CASE k % 19 WHEN 0 THEN k END AS deal_id,
           CASE WHEN k % 3 <> 0 THEN u END AS subscription_id,
           CASE WHEN k % 31 <> 0 THEN u END AS address_id,
           TIMESTAMP '2017-01-01' + to_hours(CAST(24 * day_no + 7 + k % 12 AS BIGINT)) AS start_at,
           TIMESTAMP '2017-01-01' + to_minutes(CAST(1440 * day_no - (k * 37) % 20000 AS BIGINT)) AS created_at,
           CASE (k * 7) % 5 WHEN 0 THEN 'auto' ELSE 'manual' END AS creation_mean,
           CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'cash' ELSE 'card' END AS payment_type,
           cents AS total_cents,
           CASE WHEN k % 97 = 0 THEN 0 WHEN k % 89 = 0 THEN NULL ELSE cents + (k % 7) * 1000 END AS subtotal_cents,
           k % 11 = 0 AS hot,
           CASE k % 13 WHEN 1 THEN 'note' END AS notice,
           CASE WHEN k % 43 <> 0 THEN k % 7 = 0 END AS tableware,
           {", ".join(f"k % {n} = 0 AS {name}" for name, n in _FLAGS.items())},
           {", ".join(f"k % {n} AS {name}" for name, n in _COUNTS.items())}
    FROM keyed""",
)
part(
    "b_orders",
    "undated",
    """
    SELECT *,
           CASE WHEN id % 23 <> 0 THEN created_at END AS confirmed_at,
           CASE WHEN workflow_state = 'paid'
                THEN start_at + to_hours(CASE id % 7 WHEN 0 THEN id % 960 ELSE 3 END) END AS checked_out_at,
           CASE WHEN workflow_state = 'canceled' AND id % 6 < 2 THEN created_at + to_minutes((id * 11) % 14)
                WHEN workflow_state = 'canceled' THEN start_at - to_hours((id * 17) % 264)
                WHEN workflow_state = 'paid' AND id % 41 = 0 THEN start_at - INTERVAL 30 HOUR END AS canceled_at
    FROM undated""",
)
part(
    "b_subscriptions",
    "b_orders",
    """
    SELECT c.c_custkey AS id,
           CASE c.c_custkey % 4 WHEN 1 THEN e.last_one WHEN 2 THEN e.first_one
                WHEN 3 THEN TIMESTAMP '2017-04-01 12:00:00' END AS deactivated_at
    FROM customer c LEFT JOIN (
        SELECT subscription_id, max(canceled_at) AS last_one, min(canceled_at) AS first_one
        FROM b_orders WHERE workflow_state = 'canceled' GROUP BY subscription_id
    ) e ON e.subscription_id = c.c_custkey""",
)
part(
    "b_reminders",
    "b_orders",
    """
    SELECT l.l_orderkey AS order_id,
           CASE WHEN l.l_suppkey % 29 <> 0
                THEN coalesce(o.canceled_at, o.start_at) + to_minutes(3 - l.l_partkey % 25) END AS perform_at,
           CASE l.l_returnflag WHEN 'A' THEN 'failed' WHEN 'R' THEN 'success' ELSE 'pending' END AS status,
           CASE l.l_linestatus WHEN 'F' THEN 'order_canceled' ELSE 'handled_by_call_center' END AS result
    FROM lineitem l JOIN b_orders o ON o.id = l.l_orderkey""",
)
part(
    "b_deltas",
    "",
    """
    SELECT l_suppkey AS user_id, l_orderkey AS model_id,
           CASE WHEN l_linenumber < 7 THEN 'Order' ELSE 'User' END AS model_type,
           CASE l_returnflag
                WHEN 'N' THEN '[]'
                WHEN 'R' THEN '[{"name":"start_at","object":"' || l_partkey || '"}]'
                ELSE '[{"name":"start_at","object":null},{"name":"workflow_state","object":"canceled"}]'
           END AS object,
           l_shipdate AS created_at
    FROM lineitem""",
)
part(
    "b_diffs",
    "",
    """
    SELECT l_orderkey AS subject_id,
           CASE l_suppkey % 7 WHEN 0 THEN 'User' ELSE 'Order' END AS subject_type,
           CASE l_returnflag WHEN 'A' THEN '{"workflow_state":["paid","canceled"],"total_cents":[1,2]}'
                ELSE '{"total_cents":[1,2]}' END AS differences
    FROM lineitem WHERE l_linenumber <= 2""",
)
part(
    "b_roles",
    "",
    """
    SELECT s_suppkey AS user_id FROM supplier
    UNION ALL SELECT s_suppkey FROM supplier WHERE s_suppkey % 5 = 0""",
)
part(
    "b_addresses",
    "",
    """
    SELECT c_custkey AS id,
           CAST(55.5 AS DOUBLE) + CAST(c_custkey % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
           CAST(37.3 AS DOUBLE) + CAST(c_custkey % 777 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lng
    FROM customer""",
)
part(
    "b_web",
    "",
    """
    SELECT user_id, CASE WHEN event_type IN ('view', 'click') THEN 'web' ELSE 'other' END AS app_id,
           ts AS collector_tstamp, props::JSON ->> 'k' AS tracking_id
    FROM events""",
)
part(
    "b_uploads",
    "",
    """
    SELECT props::JSON ->> 'k' AS tracking_id, ts AS "date",
           event_type || '/' || (event_id % 50) || '/' || (event_id % 7) AS segments
    FROM events WHERE event_type <> 'error'""",
)

# --- single facts ------------------------------------------------------------------

part(
    "calls",
    "b_reminders",
    """
    SELECT order_id, perform_at, status, result FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY perform_at DESC NULLS FIRST, status, result) AS n
        FROM b_reminders) WHERE n = 1""",
)
part(
    "changes",
    "b_deltas b_orders",
    """
    SELECT d.user_id, d.order_id, d.entry ->> 'name' AS field_name, d.entry ->> 'object' AS field_value, d.created_at
    FROM (SELECT user_id, model_id AS order_id, created_at, unnest(CAST(object::JSON AS JSON[])) AS entry
          FROM b_deltas WHERE model_type = 'Order') d
    SEMI JOIN (SELECT id FROM b_orders WHERE deal_id IS NULL AND workflow_state IN ('paid', 'canceled')) o
      ON o.id = d.order_id""",
)
part("logged", "changes", "SELECT * FROM changes WHERE field_name = 'workflow_state' AND field_value = 'canceled'")
part(
    "crm",
    "b_diffs",
    """
    SELECT d.subject_id AS order_id
    FROM b_diffs d, json_each(d.differences::JSON) entry
    WHERE d.subject_type = 'Order' AND entry.key = 'workflow_state' AND contains(entry.value::VARCHAR, 'canceled')""",
)
part(
    "ranked",
    "b_orders b_subscriptions",
    """
    SELECT o.id AS order_id, o.subscription_id,
           rank() OVER (PARTITION BY o.subscription_id ORDER BY o.start_at DESC NULLS FIRST) AS sub_cancel_num
    FROM b_orders o JOIN b_subscriptions s ON s.id = o.subscription_id AND s.deactivated_at <= o.canceled_at
    WHERE o.workflow_state = 'canceled'""",
)

# --- the classification, as the bag that literal joins give ----------------------------

part(
    "causes",
    "b_orders b_subscriptions calls ranked",
    """
    SELECT o.id AS order_id, o.subscription_id IS NULL AS single,
           o.creation_mean = 'auto' AND o.canceled_at BETWEEN o.created_at AND o.created_at + INTERVAL 10 MINUTE AS at_once,
           coalesce(o.canceled_at BETWEEN c.perform_at AND c.perform_at + INTERVAL 10 MINUTE, false) AS after_call,
           c.status, c.result,
           date_diff('day', CAST(o.canceled_at AS DATE), CAST(s.deactivated_at AS DATE)) AS days_to_end,
           s.deactivated_at IS NULL AS endless, r.sub_cancel_num
    FROM b_orders o
    LEFT JOIN b_subscriptions s ON s.id = o.subscription_id
    LEFT JOIN calls c ON c.order_id = o.id
    LEFT JOIN ranked r ON r.order_id = o.id
    WHERE o.workflow_state = 'canceled' AND o.confirmed_at IS NOT NULL AND o.deal_id IS NULL""",
)
part(
    "types",
    "causes",
    """
    SELECT order_id, CASE
        WHEN at_once THEN 'trash_autosubscr'
        WHEN after_call AND status = 'failed' THEN 'ivr-auto'
        WHEN after_call AND status = 'success' AND result = 'order_canceled' THEN 'ivr-user'
        WHEN after_call AND status = 'success' AND result = 'handled_by_call_center' THEN 'ivr-cc'
        WHEN single THEN 'one-time'
        WHEN days_to_end = 0 THEN CASE sub_cancel_num WHEN 1 THEN 'subscr_cancel' ELSE 'trash_subscr' END
        WHEN endless OR days_to_end > 0 THEN 'part-subscr'
        ELSE 'unknown' END AS cancel_type
    FROM causes""",
)
part(
    "bag",
    "types logged b_roles crm",
    """
    SELECT t.order_id, t.cancel_type
    FROM types t
    LEFT JOIN logged l ON l.order_id = t.order_id
    LEFT JOIN b_roles r ON r.user_id = l.user_id
    LEFT JOIN crm ON crm.order_id = t.order_id""",
)
part("fanout", "bag", "SELECT order_id, cancel_type, count(*) AS multiplicity FROM bag GROUP BY ALL")

# --- populations and matrices; {tag} keeps the three run windows apart -------------------

_WINDOWS = {
    "val": ("train", "2017-06-20", "2017-07-04"),
    "full": ("train", "2017-01-01", "2017-06-20"),
    "seg": ("train", "2017-07-07", "2017-08-08"),
    "pred": ("predict", "2017-07-10", "2017-07-18"),
    "day1": ("predict", "2017-07-06", "2017-07-14"),
    "day2": ("predict", "2017-07-07", "2017-07-15"),
    "day3": ("predict", "2017-07-08", "2017-07-16"),
    "day4": ("predict", "2017-07-09", "2017-07-17"),
}
_RUNS = ["day1", "day2", "day3", "day4", "pred"]
_EXTRAS = " + ".join(
    [f"coalesce(CAST({name} AS INTEGER), 0)" for name in BOOLEAN_EXTRAS]
    + [f"coalesce(CAST({name} > 0 AS INTEGER), 0)" for name in COUNTED_EXTRAS]
)
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def _typed(names: list[str]) -> str:
    return ", ".join(f"CAST({n} AS {_TYPES[MATRIX_SCHEMA[n].dataType.simpleString()]}) AS {n}" for n in names)


def _days(n: int, when: str) -> str:
    return f"start_day - CAST({when} AS DATE) < {n}"


for tag, (mode, first, last) in _WINDOWS.items():
    rule = (
        "workflow_state IN ('paid', 'canceled') AND "
        "coalesce(date_diff('day', CAST(canceled_at AS DATE), CAST(start_at AS DATE)) < 7, true)"
        if mode == "train"
        else "workflow_state NOT IN ('canceled', 'hidden')"
    )
    part(
        f"chosen_{tag}",
        "b_orders",
        f"""
    SELECT *, CAST(start_at AS DATE) AS start_day FROM b_orders
    WHERE start_at >= TIMESTAMP '{first}' AND start_at < TIMESTAMP '{last}'
      AND deal_id IS NULL AND confirmed_at IS NOT NULL AND {rule}""",
    )
    part(
        f"general_{tag}",
        f"chosen_{tag} b_addresses",
        f"""
    SELECT o.id AS order_id, o.user_id, o.total_cents, o.subtotal_cents, o.subtotal_cents - o.total_cents AS discount,
           CASE WHEN coalesce(o.subtotal_cents, 0) = 0 THEN CAST(1 AS DOUBLE)
                ELSE CAST(o.subtotal_cents - o.total_cents AS DOUBLE) / CAST(o.subtotal_cents AS DOUBLE) END AS discount_prc,
           coalesce(CAST(o.payment_type = 'cash' AS INTEGER), 0) AS cash_flg,
           coalesce(CAST(o.creation_mean = 'auto' AS INTEGER), 0) AS auto_flg,
           date_part('dow', o.start_at) AS dow,
           coalesce(CAST(o.hot AS INTEGER), 0) AS hot,
           {_EXTRAS} AS additionals_num,
           CAST(date_part('hour', o.start_at) IN (8, 9, 10, 11, 12) AS INTEGER) AS day_slot_flg,
           CAST(o.notice IS NOT NULL AS INTEGER) AS has_comment,
           CAST(o.subscription_id IS NOT NULL AS INTEGER) AS subscription_flg,
           a.lat, a.lng,
           round_even(epoch(o.start_at - o.created_at) / 3600, 0) AS creation_start_hours,
           CAST(o.canceled_at IS NOT NULL AS INTEGER) AS cancel
    FROM chosen_{tag} o LEFT JOIN b_addresses a ON a.id = o.address_id""",
    )
    part(
        f"pairs_{tag}",
        f"chosen_{tag} b_orders fanout",
        f"""
    SELECT c.id AS order_id, c.start_at AS now, c.start_day, p.id AS past_id, p.workflow_state AS state,
           p.start_at AS past_start, p.checked_out_at AS paid_at, p.canceled_at,
           f.cancel_type, f.cancel_type IS NOT NULL AND NOT starts_with(f.cancel_type, 'trash') AS counts,
           f.multiplicity,
           date_part('dow', p.start_at) = date_part('dow', c.start_at) AS same_dow
    FROM chosen_{tag} c
    JOIN b_orders p ON p.user_id = c.user_id AND p.start_at < c.start_at
    LEFT JOIN fanout f ON f.order_id = p.id
    WHERE p.deal_id IS NULL AND p.confirmed_at IS NOT NULL""",
    )
    part(
        f"history_{tag}",
        f"pairs_{tag}",
        f"""
    SELECT order_id,
           count(DISTINCT CAST(past_start AS DATE)) FILTER (state = 'paid' AND paid_at < now) AS paid_all,
           {", ".join(f"count(DISTINCT CAST(past_start AS DATE)) FILTER (state = 'paid' AND {_days(n, 'paid_at')}) AS paid_{n}d" for n in (16, 30, 60))},
           count(DISTINCT past_id) FILTER (counts AND canceled_at < now) AS canceled_all_nt,
           {", ".join(f"count(DISTINCT past_id) FILTER (counts AND {_days(n, 'canceled_at')}) AS canceled_{n}d_nt" for n in (16, 30, 60))},
           count(DISTINCT past_id) FILTER (cancel_type = 'one-time' AND canceled_at < now) AS canceled_onetime_nt,
           min(start_day - CAST(canceled_at AS DATE)) FILTER (counts AND canceled_at < now) AS days_since_last_cancel_all_nt,
           min(start_day - CAST(canceled_at AS DATE)) FILTER (cancel_type = 'one-time' AND canceled_at < now)
               AS days_since_last_cancel_onetime_nt,
           min(start_day - CAST(past_start AS DATE)) FILTER (state = 'paid') AS days_since_last_paid_order,
           min(CAST(past_start AS DATE)) FILTER (state = 'paid') AS first_order_dt,
           max(CAST(past_start AS DATE)) FILTER (state = 'paid') AS last_order_dt,
           count(*) FILTER (state = 'paid' AND paid_at < now AND same_dow) AS dow_paid,
           sum(multiplicity) FILTER (counts AND canceled_at < now AND same_dow) AS dow_canceled
    FROM pairs_{tag} GROUP BY order_id""",
    )
    part(
        f"shifts_{tag}",
        f"b_deltas chosen_{tag}",
        f"""
    SELECT model_id AS order_id, count(*) - 1 AS shifts_num
    FROM (SELECT model_id, unnest(CAST(object::JSON AS JSON[])) AS entry FROM b_deltas WHERE model_type = 'Order')
    WHERE entry ->> 'name' = 'start_at' AND model_id IN (SELECT id FROM chosen_{tag})
    GROUP BY model_id""",
    )
    part(
        f"joined_{tag}",
        f"general_{tag} history_{tag} shifts_{tag}",
        f"""
    SELECT g.*, s.shifts_num, h.* EXCLUDE (order_id, paid_all, canceled_all_nt, canceled_onetime_nt, dow_paid, dow_canceled,
               paid_16d, paid_30d, paid_60d, canceled_16d_nt, canceled_30d_nt, canceled_60d_nt),
           {", ".join(f"coalesce(h.{c}, 0) AS {c}" for c in ("paid_all", "canceled_all_nt", "canceled_onetime_nt", "dow_paid", "dow_canceled", "paid_16d", "paid_30d", "paid_60d", "canceled_16d_nt", "canceled_30d_nt", "canceled_60d_nt"))}
    FROM general_{tag} g LEFT JOIN history_{tag} h USING (order_id) LEFT JOIN shifts_{tag} s USING (order_id)""",
    )
    part(
        f"m_{tag}",
        f"joined_{tag}",
        f"""
    SELECT user_id, {_typed([n for n in MATRIX_SCHEMA.names if mode == "train" or n != "cancel"])}
    FROM (SELECT *,
              CASE WHEN canceled_all_nt = 0 THEN CAST(0 AS DOUBLE)
                   ELSE CAST(canceled_all_nt AS DOUBLE) / CAST(paid_all + canceled_all_nt AS DOUBLE) END AS canceled_all_nt_share,
              CAST(dow_paid AS DOUBLE) / nullif(CAST(dow_paid + dow_canceled AS DOUBLE), 0) AS dow_paid_share,
              CAST(dow_paid AS DOUBLE) / nullif(CAST(paid_all AS DOUBLE), 0) AS dow_all_paid_share
          FROM joined_{tag})""",
    )

# --- segments -----------------------------------------------------------------------------

part(
    "tracked",
    "b_web",
    """
    SELECT DISTINCT tracking_id, user_id FROM b_web
    WHERE app_id = 'web' AND collector_tstamp > TIMESTAMP '2024-01-10'
      AND user_id IS NOT NULL AND tracking_id IS NOT NULL""",
)
part(
    "uploaded",
    "b_uploads",
    """
    SELECT tracking_id, segments, "date" FROM (
        SELECT *, row_number() OVER (PARTITION BY tracking_id ORDER BY "date" DESC NULLS FIRST, segments) AS n
        FROM b_uploads) WHERE n = 1""",
)
part(
    "m_segments",
    "m_seg tracked uploaded",
    """
    SELECT m.* EXCLUDE (user_id), u.segments
    FROM m_seg m LEFT JOIN tracked t ON t.user_id = m.user_id LEFT JOIN uploaded u ON u.tracking_id = t.tracking_id""",
)
part(
    "m_tokens",
    "m_segments",
    """
    SELECT order_id, string_split(coalesce(segments, 'nan'), '/') AS tokens FROM m_segments""",
)
part("each_token", "m_tokens", "SELECT order_id, unnest(tokens) AS token FROM m_tokens")

_ORDER_HISTORY = [
    "paid_all",
    "paid_16d",
    "paid_30d",
    "paid_60d",
    "canceled_all_nt",
    "canceled_16d_nt",
    "canceled_30d_nt",
    "canceled_60d_nt",
    "canceled_onetime_nt",
]
_DAYS_SINCE = [
    "days_since_last_cancel_all_nt",
    "days_since_last_cancel_onetime_nt",
    "days_since_last_paid_order",
]


def _matrix(tag: str) -> str:
    return sql(f"m_{tag}", f"SELECT * EXCLUDE (user_id) FROM m_{tag}")


def data_queries() -> dict[str, str]:
    """Sources, single facts, classification, populations, history, matrices, segments."""
    counted = {
        "orders": ("b_orders", "id"),
        "order_reminders": ("b_reminders", "perform_at"),
        "deltas": ("b_deltas", "object"),
        "diffs": ("b_diffs", "differences"),
        "subscriptions": ("b_subscriptions", "deactivated_at"),
        "users_roles": ("b_roles", "user_id"),
        "addresses": ("b_addresses", "lat"),
        "web_events": ("b_web", "tracking_id"),
        "segment_uploads": ("b_uploads", "segments"),
    }
    scan = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, count({column}) AS filled FROM {source}"
        for name, (source, column) in counted.items()
    )
    return {
        "scan_tables": sql(" ".join(source for source, _ in counted.values()), scan),
        "latest_reminder": sql("calls", "SELECT * FROM calls"),
        "unpacked_deltas": sql("changes", "SELECT * FROM changes"),
        "logged_cancellations": sql("logged", "SELECT * FROM logged"),
        "crm_cancellations": sql("crm", "SELECT * FROM crm"),
        "subscription_cancel_rank": sql("ranked", "SELECT * FROM ranked"),
        "cancel_classification": sql("bag", "SELECT * FROM bag"),
        "classification_fanout": sql("fanout", "SELECT * FROM fanout"),
        "cancel_type_counts": sql(
            "fanout",
            "SELECT cancel_type, count(*) AS orders, CAST(sum(multiplicity) AS BIGINT) AS row_count FROM fanout GROUP BY cancel_type",
        ),
        "late_cancel_population": sql(
            "chosen_full chosen_val chosen_seg",
            " UNION ALL ".join(
                f"SELECT '{label}' AS run, id AS order_id, user_id, start_at FROM chosen_{tag}"
                for label, tag in (("train", "full"), ("validation", "val"), ("segments", "seg"))
            ),
        ),
        "predict_population": sql("chosen_pred", "SELECT id AS order_id, user_id, start_at FROM chosen_pred"),
        "user_history_join": sql(
            "chosen_val b_orders fanout",
            """
            SELECT c.id AS order_id, count(p.id) AS earlier_orders, count(f.order_id) AS classified_orders,
                   CAST(coalesce(sum(f.multiplicity), 0) AS BIGINT) AS classified_rows
            FROM chosen_val c LEFT JOIN b_orders p ON p.user_id = c.user_id AND p.start_at < c.start_at
            LEFT JOIN fanout f ON f.order_id = p.id
            GROUP BY c.id""",
        ),
        "orders_recency_info": sql(
            "chosen_val history_val",
            f"""
            SELECT c.user_id, c.id AS order_id,
                   {", ".join(f"coalesce(h.{n}, 0) AS {n}" for n in _ORDER_HISTORY)},
                   {", ".join(f"CAST(h.{n} AS INTEGER) AS {n}" for n in _DAYS_SINCE)},
                   h.first_order_dt, h.last_order_dt
            FROM chosen_val c LEFT JOIN history_val h ON h.order_id = c.id""",
        ),
        "orders_general_info": sql(
            "general_val",
            "SELECT "
            + _typed(MATRIX_SCHEMA.names[: MATRIX_SCHEMA.names.index("cancel") + 1])
            + " FROM general_val",
        ),
        "order_shifts": sql("shifts_val", "SELECT order_id, shifts_num FROM shifts_val"),
        "dow_cleanings": sql(
            "chosen_val history_val",
            """
            SELECT c.user_id, c.id AS order_id, CAST(date_part('dow', c.start_at) AS INTEGER) AS dow,
                   coalesce(h.dow_paid, 0) AS dow_paid, CAST(coalesce(h.dow_canceled, 0) AS BIGINT) AS dow_canceled
            FROM chosen_val c LEFT JOIN history_val h ON h.order_id = c.id""",
        ),
        "feature_matrix_train": _matrix("val"),
        "feature_matrix_train_window": _matrix("full"),
        "feature_matrix_predict": _matrix("pred"),
        "feature_matrix_daily": sql(
            " ".join(f"m_{tag}" for tag in _RUNS),
            " UNION ALL ".join(
                f"SELECT DATE '{_WINDOWS[tag][1]}' AS run_date, * EXCLUDE (user_id) FROM m_{tag}" for tag in _RUNS
            ),
        ),
        "csv_roundtrip": sql("m_segments", "SELECT * FROM m_segments"),
        "trackings": sql("tracked", "SELECT * FROM tracked"),
        "latest_segments": sql("uploaded", "SELECT tracking_id, segments FROM uploaded"),
        "feature_matrix_segments": sql("m_segments", "SELECT * FROM m_segments"),
        "feature_matrix_segments_latest": sql(
            "m_seg tracked uploaded",
            """
            SELECT m.* EXCLUDE (user_id), b.segments
            FROM m_seg m LEFT JOIN (
                SELECT user_id, segments, row_number() OVER (
                    PARTITION BY user_id
                    ORDER BY segments IS NULL, "date" DESC NULLS FIRST, segments, tracking_id) AS n
                FROM tracked LEFT JOIN uploaded USING (tracking_id)
            ) b ON b.user_id = m.user_id AND b.n = 1""",
        ),
    }


def _six(expression: str, name: str) -> str:
    """Six decimals and no negative zero."""
    return f"round({expression}, 6) + CAST(0 AS DOUBLE) AS {name}"


def _as_double(name: str) -> str:
    return f"CAST({name} AS DOUBLE)"


def prep_queries() -> dict[str, str]:
    """Preparation and evaluation on the validation matrix."""
    hours, means, payments = range(7, 19), ("auto", "manual"), ("card", "cash")
    powers = [
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
    mean_filled = {c: f"coalesce({_as_double(c)}, avg({c}) OVER ())" for c in ("shifts_num", "dow_paid_share")}
    filled = ", ".join(f"{mean_filled.get(c, f'coalesce({_as_double(c)}, 0)')} AS {c}" for c in FEATURES)
    tokens = [str(i) for i in range(50)] + ["click", "purchase", "signup", "view", "nan"]
    edges = [i / 10 for i in range(11)]
    bins = " ".join(
        f"WHEN score > CAST('{low}' AS DOUBLE) AND score <= CAST('{high}' AS DOUBLE) THEN '{10 * i}-{10 * i + 10}'"
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    )
    score = "SELECT order_id, cancel, canceled_all_nt_share AS score FROM m_val"
    code = "CAST(dense_rank() OVER (ORDER BY {0}) - 1 AS INTEGER) AS {0}"
    categories = "SELECT id AS order_id, creation_mean, payment_type, date_part('hour', start_at) AS start_hour FROM b_orders"

    def hot(column: str, values, quote: str = "") -> list[str]:
        return [f"CAST({column} = {quote}{v}{quote} AS DOUBLE) AS {column}{i}" for i, v in enumerate(values)]

    one_hot = hot("creation_mean", means, "'") + hot("payment_type", payments, "'") + hot("start_hour", hours)
    return {
        "dataset_profile": sql(
            "m_val",
            f"SELECT count(*) AS row_count, CAST({len(MATRIX_SCHEMA.names)} AS INTEGER) AS column_count FROM m_val",
        ),
        "fill_mean": sql(
            "m_val", f"SELECT order_id, {', '.join(_six(e, c) for c, e in mean_filled.items())} FROM m_val"
        ),
        "fill_constant": sql(
            "m_val",
            "SELECT "
            + ", ".join(
                f"CAST(coalesce({n}, -999) AS {_TYPES[MATRIX_SCHEMA[n].dataType.simpleString()]}) AS {n}"
                for n in MATRIX_SCHEMA.names
            )
            + " FROM m_val",
        ),
        "label_encode": sql(
            "b_orders",
            f"SELECT order_id, {', '.join(code.format(c) for c in ('creation_mean', 'payment_type', 'start_hour'))} "
            f"FROM ({categories})",
        ),
        "one_hot": sql("b_orders", f"SELECT order_id, {', '.join(one_hot)} FROM ({categories})"),
        "power_features": sql(
            "m_val",
            "SELECT order_id, "
            + ", ".join(
                [_six(f"{_as_double(c)} * {_as_double(c)}", f"{c}_sq") for c in powers]
                + [_six(f"sqrt({_as_double(c)})", f"{c}_sqrt") for c in powers]
            )
            + " FROM m_val",
        ),
        "segment_matrix": sql(
            "m_tokens",
            """
            SELECT order_id, token, CAST(len(list_filter(tokens, lambda t: t = token)) AS BIGINT) AS n
            FROM (SELECT order_id, tokens, unnest(list_distinct(tokens)) AS token FROM m_tokens)""",
        ),
        "segment_vocabulary": sql(
            "each_token", "SELECT token, count(*) AS total, count(*) >= 100 AS kept FROM each_token GROUP BY token"
        ),
        "segment_presence": sql(
            "m_tokens",
            "SELECT order_id, "
            + ", ".join(f"CASE WHEN list_contains(tokens, '{t}') THEN 1 END AS has_{t}" for t in tokens)
            + " FROM m_tokens",
        ),
        "drop_sparse_columns": sql(
            "m_val",
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, {_six(f'coalesce(sum({_as_double(c)}), 0)', 'total')}, "
                f"coalesce(sum({_as_double(c)}), 0) >= 100 AS kept FROM m_val"
                for c in FEATURES
            ),
        ),
        "standardize": sql(
            "m_val",
            "SELECT order_id, "
            + ", ".join(
                _six(
                    f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () "
                    "ELSE CAST(0 AS DOUBLE) END",
                    c,
                )
                for c in FEATURES
            )
            + f" FROM (SELECT order_id, {filled} FROM m_val)",
        ),
        "model_input": sql(
            "m_val",
            "SELECT order_id, "
            + ", ".join(
                _six(mean_filled[c], c) if c in mean_filled else f"coalesce({_as_double(c)}, -999) AS {c}"
                for c in FEATURES
            )
            + ", CAST(cancel AS DOUBLE) AS label FROM m_val",
        ),
        "kfold_split": sql(
            "chosen_full",
            """
            SELECT id AS order_id,
                   CAST((((id % 2147483647) * 48271 + 42) % 2147483647 * 69621) % 2147483647 % 5 AS INTEGER) AS fold
            FROM chosen_full""",
        ),
        "roc_auc": sql(
            "m_val",
            f"""
            SELECT {_six("(rank_sum - p * (p + 1) / 2) / (p * n)", "auc")}
            FROM (SELECT CAST(sum(place) FILTER (cancel = 1) AS DOUBLE) AS rank_sum,
                         CAST(count(*) FILTER (cancel = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (cancel = 0) AS DOUBLE) AS n
                  FROM (SELECT cancel, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS place
                        FROM ({score})))""",
        ),
        "logloss_accuracy": sql(
            "m_val",
            f"""
            SELECT {_six("avg(CASE cancel WHEN 1 THEN -ln(p) ELSE -ln(CAST(1 AS DOUBLE) - p) END)", "log_loss")},
                   {_six("avg(CAST((score > CAST('0.5' AS DOUBLE)) = (cancel = 1) AS DOUBLE))", "accuracy")}
            FROM (SELECT *, least(greatest(score, CAST('1e-7' AS DOUBLE)), CAST(1 AS DOUBLE) - CAST('1e-7' AS DOUBLE)) AS p
                  FROM ({score}))""",
        ),
        "score_bins": sql(
            "m_val", f"SELECT order_id, cancel AS y_true, score AS y_pred, CASE {bins} END AS bin FROM ({score})"
        ),
            "drop_columns": sql(
            "m_val",
            " UNION ALL ".join(
                f"SELECT order_id, '{c}' AS feature, {_as_double(c)} AS value FROM m_val "
                f"WHERE (SELECT coalesce(sum({_as_double(c)}), 0) FROM m_val) >= 100"
                for c in FEATURES
            ),
        ),
        "segment_numbers": sql(
            "each_token",
            """
            SELECT order_id, number, CAST(len(list_filter(tokens, lambda t: t = token)) AS BIGINT) AS n
            FROM (SELECT order_id, tokens, unnest(list_distinct(tokens)) AS token FROM m_tokens)
            JOIN (SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS INTEGER) AS number
                  FROM each_token GROUP BY token) USING (token)""",
        ),
        "segment_vectors": sql(
            "each_token",
            """
            , numbers AS (
              SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS INTEGER) AS number
              FROM each_token GROUP BY token HAVING count(*) >= 100),
            placed AS (SELECT row_number() OVER () AS row_no, order_id, tokens FROM m_tokens),
            counted AS (
              SELECT row_no, number, count(*) AS n
              FROM (SELECT row_no, unnest(tokens) AS token FROM placed) JOIN numbers USING (token) GROUP BY row_no, number)
            SELECT order_id, coalesce(string_agg(CAST(number AS VARCHAR), ',' ORDER BY number), '') AS numbers,
                   coalesce(string_agg(CAST(n AS VARCHAR), ',' ORDER BY number), '') AS counts
            FROM placed LEFT JOIN counted USING (row_no) GROUP BY row_no, order_id""",
        ),
        "encoder_roundtrip": sql(
            "b_orders",
            f"""
            SELECT id AS order_id, CAST(creation_mean = 'manual' AS INTEGER) AS creation_mean,
                   CAST(payment_type = 'card' AS DOUBLE) AS payment_type0,
                   CAST(payment_type = 'cash' AS DOUBLE) AS payment_type1,
                   {_six("coalesce(CAST(date_part('hour', canceled_at) AS DOUBLE), cancel_mean)", "cancel_hour")},
                   {_six("(date_part('hour', start_at) - start_mean) / start_dev", "start_hour")},
                   {_six("CAST(date_part('hour', start_at) AS DOUBLE) * date_part('hour', start_at)", "start_hour_sq")},
                   {_six("sqrt(date_part('hour', start_at))", "start_hour_sqrt")}
            FROM b_orders,
                 (SELECT avg(date_part('hour', canceled_at)) AS cancel_mean, avg(date_part('hour', start_at)) AS start_mean,
                         stddev_pop(date_part('hour', start_at)) AS start_dev
                  FROM b_orders WHERE start_at < DATE '2017-06-20')
            WHERE start_at >= DATE '2017-06-20' AND start_at < DATE '2017-07-04'""",
        ),
        "label_transform": sql(
            "b_orders",
            """
            SELECT id AS order_id, CAST(creation_mean = 'manual' AS INTEGER) AS creation_mean,
                   CAST(payment_type = 'cash' AS INTEGER) AS payment_type
            FROM b_orders WHERE start_at >= DATE '2017-06-20' AND start_at < DATE '2017-07-04'""",
        ),
    }


def model_queries() -> dict[str, str]:
    """What SQL can tell of the models: scored rows, settings, rounds, features."""
    scored = "SELECT order_id, cancel, true AS is_probability, true AS learned FROM m_val"

    def settings(fixed: list[str], folds: str) -> str:
        return " UNION ALL ".join(f"SELECT '{x}' AS setting{folds}, true AS auc_in_range" for x in fixed)

    stopping = [
        "one round is chosen",
        "it is better than all before",
        "none of the next ones is better",
        "growing ends after the patience",
        "and not before",
        "the model is that of the round",
        "the model has its trees",
    ]
    rules = " UNION ALL ".join(f"SELECT '{x}' AS rule, true AS holds" for x in stopping)
    grid = [
        f'{{"maxDepth": {d}, "maxIter": {n}, "stepSize": {rate}}}'
        for n in (10, 20, 30, 50, 100)
        for d in (3, 5, 6, 7)
        for rate in (0.001, 0.002, 0.1, 0.2, 0.5, 1.0)
    ]
    segments = [f'{{"maxDepth": {d}, "maxIter": {n}, "stepSize": 0.2}}' for n in (10, 20) for d in (5, 6)]
    sampled = [f'{{"maxDepth": 6, "minChildWeight": {n}}}' for n in (1, 3)]
    five = ", CAST(5 AS INTEGER) AS folds"
    features = ", ".join(f"'{c}'" for c in FEATURES)
    return {
        "train_gbt": sql("m_val", scored),
        "train_gbt_segments": sql(
            "m_segments", "SELECT order_id, segments, cancel, true AS is_probability, true AS learned FROM m_segments"
        ),
        "train_mlp": sql("m_val", scored),
        "cross_validate": settings(grid, five),
        "cross_validate_segments": settings(segments, five),
        "grid_search": settings(sampled, "").replace("true AS auc_in_range", "true AS auc_in_range, true AS fits_its_rows"),
        "early_stopping": rules,
        "early_stopping_segments": rules,
        "feature_importance": f"SELECT unnest([{features}]) AS feature, CAST(1 AS DOUBLE) AS total",
        "split_importance": "SELECT CAST(0 AS BIGINT) AS unknown_features, true AS has_splits",
        "model_roundtrip": sql("m_val", "SELECT order_id, true AS same FROM m_val"),
        "score_orders": sql("m_pred", "SELECT order_id, true AS is_probability, true AS varies FROM m_pred"),
    }
