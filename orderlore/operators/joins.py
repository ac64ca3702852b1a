"""Joins that stay balanced when one key, or no key, holds much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = 1024
_PARTS = 8


def left_join_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str) -> DataFrame:
    """Left join that does not send all null keys of the left side to one task.

    The key gets a second part: 0 for real keys, a hash of ``spread_by`` for
    nulls. Null keys match nothing either way, so the result is the plain left
    join, but they now shuffle to many partitions. The right side's 0 is
    computed from its key; a literal would be folded out of the shuffle key.
    """
    part = F.when(F.col(left_key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD))).otherwise(F.lit(0))
    spread = left.withColumn("_part", part.cast("long"))
    keyed = right.withColumnRenamed(right_key, "_key").withColumn("_zero", F.pmod(F.xxhash64("_key"), F.lit(1)).cast("long"))
    joined = spread.join(keyed, (F.col(left_key) == F.col("_key")) & (F.col("_part") == F.col("_zero")), "left")
    return joined.drop("_part", "_zero", "_key")


def join_spread(facts: DataFrame, entities: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Inner join of many facts to one narrow row per key, before facts are aggregated by that key.

    A plain join would leave all facts of a key in one partition, and the
    aggregation after it would be content with that and run there. Here facts
    of a key go to several partitions and each meets a copy of the entity. The
    aggregation then has to shuffle partial results, and in between
    adaptive execution is free to split partitions that are still too large.

    The copies are sorted and merged, which spills: their size is guessed from the entities' files, so a well
    compressed table would be broadcast whole, eight times over, to every executor.
    """
    part = F.pmod(F.xxhash64(spread_by), F.lit(_PARTS)).cast("int")
    copies = entities.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
    return facts.withColumn("_part", part).join(copies.hint("merge"), [key, "_part"]).drop("_part")
