"""Audience segments: which ones a user has, and how they become features."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlore.operators.prep import category_classes
from orderlore.sources.tables import materialise

MISSING = "nan"  # fixed value: the token of a row without segments
SEPARATOR = "/"  # fixed value: between the tokens of a row
MIN_TOTAL = 100  # fixed value: columns with a smaller sum are dropped
MOST_COLUMNS = 10_000  # tokens that get a column of their own


def trackings(web_events: DataFrame, app_id: str, since: str | dt.date) -> DataFrame:
    """Distinct pairs of tracking id and user seen in one application after a time."""
    tracking = F.get_json_object("contexts", "$.tracking_id")
    after = F.col("collector_tstamp") > F.lit(str(since)).cast("timestamp_ntz")
    return (
        web_events.where(after & (F.col("app_id") == app_id) & F.col("user_id").isNotNull())
        .select(tracking.alias("tracking_id"), "user_id")
        .where(F.col("tracking_id").isNotNull())
        .distinct()
    )


def latest_segments(uploads: DataFrame) -> DataFrame:
    """The last uploaded segments per tracking id; a missing date counts as last."""
    newest = W.partitionBy("tracking_id").orderBy(F.desc_nulls_first("date"), "segments")
    return (
        uploads.select("tracking_id", "segments", "date")
        .withColumn("place", F.row_number().over(newest))
        .where("place = 1")
        .drop("place")
    )


def user_segments(tracked: DataFrame, latest: DataFrame, dedupe: str = "none") -> DataFrame:
    """Segments per user, through all tracking ids or only the most recent upload."""
    joined = tracked.join(latest, "tracking_id", "left")
    if dedupe == "none":
        return joined.select("user_id", "segments")
    if dedupe == "latest":
        has_segments = F.col("segments").isNotNull()
        newest = W.partitionBy("user_id").orderBy(
            has_segments.desc(), F.desc_nulls_first("date"), "segments", "tracking_id"
        )
        return joined.withColumn("place", F.row_number().over(newest)).where("place = 1").select("user_id", "segments")
    raise ValueError(f"dedupe is 'none' or 'latest', not {dedupe!r}")


def tokens(segments: Column | str) -> Column:
    """The tokens of a row, repetitions and empty ones included."""
    text = F.col(segments) if isinstance(segments, str) else segments
    return F.split(F.coalesce(text, F.lit(MISSING)), SEPARATOR)


def segment_counts(df: DataFrame, *keep: str) -> DataFrame:
    """Sparse multi-hot matrix as rows: each row's distinct tokens and how often it has them.

    Counted inside the row, so nothing is shuffled and no row key is needed: the
    sorted tokens change where a new one begins, and it lasts until the next beginning.
    """
    listed = df.select(*keep, F.array_sort(tokens("segments")).alias("_tokens"))
    begins = F.filter(
        F.sequence(F.lit(0), F.size("_tokens") - 1),
        lambda i: (i == 0) | (F.get("_tokens", i) != F.get("_tokens", i - 1)),
    )
    listed = listed.withColumn("_begins", begins)
    counted = F.transform(
        "_begins",
        lambda i, k: F.struct(
            F.get("_tokens", i).alias("token"),
            (F.coalesce(F.get("_begins", k + 1), F.size("_tokens")) - i).cast("long").alias("n"),
        ),
    )
    return listed.select(*keep, F.explode(counted).alias("_counted")).select(*keep, "_counted.token", "_counted.n")


def token_totals(df: DataFrame) -> DataFrame:
    """Occurrences of each token over all rows; combined before the shuffle."""
    return df.select(F.explode(tokens("segments")).alias("token")).groupBy("token").agg(F.count("*").alias("total"))


def vocabulary_table(df: DataFrame, min_total: int = 1) -> DataFrame:
    """(token, number, total) of the tokens that occur often enough, numbered from 0 in ascending order, stored.

    Tokens are numbered by ranges, so there may be any number of them; nothing returns to the driver.
    """
    totals = materialise(token_totals(df).where(F.col("total") >= min_total), "tokens")
    numbers = category_classes(totals, "token").select(F.col("value").alias("token"), F.col("code").alias("number"))
    return totals.join(numbers, "token").select("token", "number", "total")


def numbered_segments(df: DataFrame, vocabulary: DataFrame, *keep: str) -> DataFrame:
    """Sparse multi-hot matrix over a vocabulary table: (the kept columns, number, n); other tokens are left out.

    A frequent token has one row in the vocabulary, so the join can be split or broadcast by its size.
    """
    return segment_counts(df, *keep).join(vocabulary.select("token", "number"), "token").select(*keep, "number", "n")


def numbered_vectors(df: DataFrame, vocabulary: DataFrame, *keep: str) -> DataFrame:
    """One row per row of ``df`` with the numbers of its tokens, rising, and how often it has each: the sparse
    vectors of the matrix, without the vocabulary in any one place."""
    rows = df.select(*keep, "segments").withColumn("_row", F.monotonically_increasing_id())
    rows = materialise(rows, "segment-rows")
    held = numbered_segments(rows, vocabulary, "_row").groupBy("_row")
    held = held.agg(F.array_sort(F.collect_list(F.struct("number", "n"))).alias("_cells"))
    empty = F.expr("array()")
    return rows.join(held, "_row", "left").select(
        *keep,
        F.coalesce(F.col("_cells.number"), empty.cast("array<int>")).alias("numbers"),
        F.coalesce(F.col("_cells.n"), empty.cast("array<bigint>")).alias("counts"),
    )


def segment_vocabulary(df: DataFrame, min_total: int = 1, most: int = MOST_COLUMNS) -> list[str]:
    """Tokens in ascending order, rare ones left out, for matrices with a column per token: part of the model, so they
    return to the driver. More than ``most`` of them are an error; ``vocabulary_table`` has no bound."""
    frequent = token_totals(df).where(F.col("total") >= min_total).select("token")
    found = sorted(r.token for r in frequent.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"more than {most} tokens; use vocabulary_table")
    return found


def segment_vector(df: DataFrame, vocabulary: list[str], output: str = "segment_vector") -> DataFrame:
    """Token counts as a sparse vector over a vocabulary; other tokens are left out."""
    listed = df.withColumn("_tokens", tokens("segments"))
    model = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_tokens", outputCol=output)
    return model.transform(listed).drop("_tokens")


def segment_presence(df: DataFrame, vocabulary: list[str], *keep: str, prefix: str = "") -> DataFrame:
    """One column per token: 1 where the row has it, null elsewhere.

    Each token of a row is looked at once: it goes to its column when the tokens are gathered per row again.
    """
    numbered = df.select(*keep, tokens("segments").alias("_tokens")).withColumn("_row", F.monotonically_increasing_id())
    each = numbered.select("_row", *keep, F.explode("_tokens").alias("_token"))
    wide = each.groupBy("_row", *keep).pivot("_token", vocabulary).agg(F.max(F.lit(1)))
    return wide.select(*keep, *[F.col(f"`{t}`").alias(prefix + t) for t in vocabulary])
