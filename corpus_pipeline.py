"""The training-data pipeline: documents through five stages, each stored and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.llm import lines, mixing, neardup, packing, quality
from orderlore.llm.queries import tokenizer_file
from orderlore.sources.tables import discard, materialise_at, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It is fitted on the labelled ones among ``docs``, without those
    whose id has the held-out remainder."""
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(quality.remainder("doc_id", 4) != 2)
    model = quality.fit(docs, labels, "quality")
    return quality.score(docs, model).where(f"score >= {quality.KEEP}").select(*COLUMNS)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat another one. All documents stay, with what is left of their text."""
    cut = lines.without_repeated_lines(docs.select(*COLUMNS))
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length.cast("long")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.without_near_duplicates(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the mixed documents are packed into."""
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("lines", cut_lines),
    ("near duplicates", keep_one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A learned score and similarities of signatures cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of the folder. What a stage leaves behind goes when the next one is written;
    the last one's rows stay."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs, path = materialise_at(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            keep(path)
        if before:
            discard(spark, before)
        before = path
    return docs
