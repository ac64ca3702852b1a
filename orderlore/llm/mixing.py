"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlore.llm.common import WORD, fresh
from orderlore.sources.tables import materialise

#: Expected copies are kept as integers of this unit, so that prefix sums are exact and reruns agree.
UNIT = 1 << 24


def word_count(text: str = "text") -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: float = 3.0) -> DataFrame:
    """Share the total size among sources by weight; no source above ``most`` times its size.

    ``sizes`` has source_size (long) and weight (long > 0). What a source cannot take is reshared by weight among
    the others until none is above its limit: a target is the lesser of the limit and weight times one level, and
    the level is found by a few passes over the sources. Adds target (double). Sources of size 0 get 0; an empty
    table stays empty.
    """
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("source_size") * F.lit(most)
        if full < 0:
            above = F.lit(False)
        row = sizes.agg(
            F.count_if(above),
            F.sum(F.when(above, F.col("source_size")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if row[0] == full or not row[2]:
            break
        full, level = row[0], (total - most * row[1]) / row[2]
    return sizes.withColumn("target", F.least(F.col("source_size") * F.lit(most), F.col("weight") * F.lit(level)))


def systematic_copies(docs: DataFrame, rates: DataFrame, order: list[Column], size: str, seed: str) -> DataFrame:
    """Add copies (long): how often each document is taken.

    ``docs`` has src (never null), cell (short text, spreads equal sizes) and the size column; ``rates`` has src and
    rate, the expected copies in UNITs. Within a source documents stand in the order of size, cell and ``order``.
    Their expected copies are summed up from the front, one random offset is added, and a document is emitted once
    for each whole number that its own part of the sum crosses. As neighbours have like sizes, the words that are
    taken stay near the expected number.

    The position of a document is its rank in a small cell (source, size, cell) plus totals of cells and of size
    bands before it, so that no source, however large, is one task.
    """
    band = F.when(F.col(size) < 64, F.col(size)).otherwise(
        F.floor(F.log2(F.col(size).cast("double")) * 64).cast("long") + 64
    )
    cells = docs.groupBy("src", size, "cell").agg(F.count("*").alias("n")).withColumn("band", band)
    bands = cells.groupBy("src", "band").agg(F.sum("n").alias("n"))
    ahead = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bands = bands.select("src", "band", ahead(Window.partitionBy("src").orderBy("band")).alias("before_band"))
    cells = cells.withColumn("before_cell", ahead(Window.partitionBy("src", "band").orderBy(size, "cell")))
    cells = cells.join(bands, ["src", "band"]).join(rates, "src")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("src"))), 1, 6), 16, 10).cast("long")
    cells = cells.select(
        "src", size, "cell", "rate", (F.col("before_band") + F.col("before_cell")).alias("before"), offset.alias("offset")
    )
    rank = F.row_number().over(Window.partitionBy("src", size, "cell").orderBy(*order))
    crossed = lambda i: F.shiftright(i * F.col("rate") + F.col("offset"), 24)
    position = F.col("before") + F.col("rank")
    copies = crossed(position) - crossed(position - 1)
    return docs.withColumn("rank", rank).join(cells, ["src", size, "cell"]).withColumn("copies", copies)


def mix(docs: DataFrame, weights: DataFrame | None = None, most: float = 3.0, seed: str = "mix") -> DataFrame:
    """How often each document of ``docs`` (doc_id, text, source) enters a mix of all sources.

    Returns one row per document: doc_id, source, size (words), source_size, target (words of its source in the
    mix), copies, taken (size times copies). The mix is as large as the corpus. ``weights`` has source and weight
    (whole numbers above 0; sources without a row weigh 1); by default sources by code point, null last, weigh
    1, 2, 3, 1, 2, 3, ... No document is taken more than ``most`` times, rounded up.

    Null source: a source of its own. Null or wordless text: size 0, taken 0. Null ids and repeated rows are
    documents of their own; ties of size are ordered by a hash of id and seed. Empty tables give empty results;
    other columns are ignored.
    """
    sized = docs.select("doc_id", "source", word_count().alias("size"))
    sized = sized.withColumn("src", F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))))
    sized = sized.withColumn("hash", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    sized = materialise(sized, "sizes")
    sources = sized.groupBy("src", "source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        turn = (F.row_number().over(Window.orderBy("src")) - 1) % 3 + 1
        sources = sources.withColumn("weight", turn.cast("long"))
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("long").alias("weight"))
        sources = sources.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
        sources = sources.withColumn("weight", F.coalesce("weight", F.lit(1)))
    sources = materialise(targets(materialise(sources, "sources"), most), "targets")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0)
    rates = sources.select("src", "source_size", "target", rate.cast("long").alias("rate"))
    keyed = sized.withColumn("cell", F.substring("hash", 1, 3))
    taken = systematic_copies(keyed, rates.select("src", "rate"), [F.col("hash"), F.col("doc_id")], "size", seed)
    return taken.join(rates.select("src", "source_size", "target"), "src").select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    names, row, many = docs.columns, fresh(docs, "row"), fresh(docs, "copies")
    keyed = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    plan = mix(keyed.select(F.col(row).alias("doc_id"), "text", "source"), seed=seed)
    picked = plan.where("copies > 0").select(F.col("doc_id").alias(row), F.col("copies").cast("int").alias(many))
    return keyed.join(picked, row).withColumn(many, F.explode(F.sequence(F.lit(1), many))).select(*names)
