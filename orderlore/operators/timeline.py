"""What was known about a user just before a moment, without pairing orders.

A measure over a user's earlier orders is usually written as a self-join: each
order meets every earlier order of its user. A user with many orders then
yields a quadratic number of pairs in one task. Here each past order becomes
a few dated events ("from now on one more", "from now on one less"), and a
measure at a moment is the running total of the events strictly before it.

Totals are built in two levels, so no task ever holds all events of a user:

* everything before the run window collapses into one opening row per user
  and weekday, inside the window into one row per exact time (both by
  aggregation, combined before the shuffle);
* totals per day are summed over earlier days of the window, which is at most
  seven rows per day and user;
* inside a single day the running total adds what happened earlier that day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlore.functions.columns import micros_between, midnight, weekday
from orderlore.operators.population import at_midnight
from orderlore.sources.schemas import Window

_POINT = "point"


def event(at: Column, measure: str, delta: Column | int = 1, day: Column | None = None) -> Column:
    """A dated change of a measure. A null time means that there is no such event."""
    return F.struct(
        at.alias("at"),
        F.lit(measure).alias("measure"),
        (F.lit(delta) if isinstance(delta, int) else delta).cast("long").alias("delta"),
        (F.lit(None) if day is None else day).cast("date").alias("day"),
    )


def events_of(rows: DataFrame, dow: Column, events: Sequence[Column]) -> DataFrame:
    """The events of each row, tagged with the row's user and weekday."""
    return rows.select("user_id", dow.alias("dow"), F.inline(F.array(*events))).where(F.col("at").isNotNull())


@dataclass(frozen=True)
class Measures:
    """What to total. Names are output columns; ``latest`` and ``earliest`` map
    an output to the measure whose event days are compared."""

    counts: Sequence[str] = ()
    weekday_counts: Sequence[str] = ()
    latest: Mapping[str, str] = field(default_factory=dict)
    earliest: Mapping[str, str] = field(default_factory=dict)

    def aggregates(self) -> dict[str, tuple[str, str, str]]:
        """Output column: its aggregate, the event column it reads, and of which measure."""
        return (
            {name: ("sum", "delta", name) for name in [*self.counts, *self.weekday_counts]}
            | {name: ("max", "day", source) for name, source in self.latest.items()}
            | {name: ("min", "day", source) for name, source in self.earliest.items()}
        )

    def from_events(self) -> list[Column]:
        return [
            F.expr(f"{merge}(CASE WHEN measure = '{source}' THEN {column} END) AS {name}")
            for name, (merge, column, source) in self.aggregates().items()
        ]

    def combined(self) -> list[Column]:
        return [F.expr(f"{merge}({name}) AS {name}") for name, (merge, _, _) in self.aggregates().items()]

    def running(self, prefix: str, partition: str, order: str) -> list[Column]:
        """Totals over strictly smaller values of ``order``; weekday counts within their weekday."""
        frame = f"ORDER BY {order} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        return [
            F.expr(
                f"{merge}({name}) OVER (PARTITION BY {partition}{', dow' if name in self.weekday_counts else ''} {frame})"
                f" AS {prefix}{name}"
            )
            for name, (merge, _, _) in self.aggregates().items()
        ]

    def merged(self, first: str, second: str) -> list[Column]:
        """Two partial values, in columns with these prefixes, made one."""
        both = {
            "sum": "coalesce({0}, 0L) + coalesce({1}, 0L)",
            "max": "greatest({0}, {1})",
            "min": "least({0}, {1})",
        }
        return [
            F.expr(both[merge].format(first + name, second + name) + f" AS {name}")
            for name, (merge, _, _) in self.aggregates().items()
        ]


def point_in_time(
    events: DataFrame, points: DataFrame, window: Window, measures: Measures, totals: DataFrame | None = None
) -> DataFrame:
    """Measures at each distinct ``(user_id, start_at)`` of ``points``.

    All points lie in the window. Users without a number get no row.
    ``totals`` are measures per user and weekday of further events, all of them before the window.
    """
    dated = events.where(F.col("user_id").isNotNull() & (F.col("at") < at_midnight(window.end)))
    marks = points.where(F.col("user_id").isNotNull()).select(
        "user_id", weekday(F.col("start_at")).alias("dow"), F.inline(F.array(event(F.col("start_at"), _POINT)))
    )
    opening = F.col("at") < at_midnight(window.start)
    # 0 before the window, 1 inside, 2 a moment that is asked for. Both readers of the
    # steps filter on this aggregate rather than on the day, which the optimizer would
    # push below the aggregation; so the steps are computed and shuffled once for both
    role = F.when(F.col("measure") == _POINT, 2).when(F.col("day_no") >= 0, 1).otherwise(0)
    steps = (
        dated.unionByName(marks)
        .select(
            "user_id",
            F.when(opening, -1).otherwise(F.datediff("at", F.lit(window.start))).alias("day_no"),
            F.when(~opening, F.col("at")).alias("start_at"),
            "dow",
            "measure",
            "delta",
            "day",
        )
        .groupBy("user_id", "day_no", "start_at", "dow")
        .agg(*measures.from_events(), F.max(role).alias("role"))
    )

    by_day = steps
    if totals is not None:
        before = totals.withColumns({"day_no": F.lit(-1), "role": F.lit(0)})
        by_day = steps.drop("start_at").unionByName(before)
    days = by_day.groupBy("user_id", "day_no", "dow").agg(*measures.combined(), F.max("role").alias("role"))
    # a day of the window has one weekday, so a day with points gives one row
    earlier_days = (
        days.select("user_id", "day_no", "role", *measures.running("before_", "user_id", "day_no"))
        .where("role = 2")
        .drop("role")
    )
    clock = micros_between(F.col("start_at"), midnight(F.to_date("start_at")))
    same_day = (
        steps.where("role > 0")
        .withColumn("clock", clock)
        .select("user_id", "day_no", "start_at", "role", *measures.running("today_", "user_id, day_no", "clock"))
        .where("role = 2")
    )
    return same_day.join(earlier_days, ["user_id", "day_no"], "left").select(
        "user_id", "start_at", *measures.merged("before_", "today_")
    )
