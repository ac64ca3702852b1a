import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return helpers.documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The documents with further columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    from orderlore.sources.tables import materialise

    df = spark.createDataFrame(rows, helpers.SCHEMA).repartition(3, "text")
    clashing = ("row", "file", "at", "copies", "removed", "size", "n_lines", "score", "rid", "node", "comp", "label", "key")
    return materialise(df.withColumns({c: F.lit(c) for c in clashing}), "test")


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("false")
