"""Registered queries against their SQL, and the pipeline against the rules of its stages."""

import corpus_pipeline
import pytest
from compare import connect, differences

from orderlore.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(spark, db, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), db, queries.ORACLE_SQL[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    from orderlore.sources.tables import materialise

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, FOLDER), "test")
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append(docs.count())
    assert kept[0] <= 200 and kept[1] == kept[0] and kept[2] <= kept[1]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.where("start = 0").count() == kept[3]


def test_pipeline_leaves_its_result_alone(spark):
    """Of all that the stages write, the rows of the last one stay."""
    from orderlore.sources.tables import shared_folder

    root = shared_folder(spark, "x").rsplit("/", 1)[0]
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = lambda: {f.getPath().getName() for f in files.listStatus(place)} if files.exists(place) else set()
    before = names()
    rows = corpus_pipeline.run(spark, FOLDER)
    left = names() - before
    assert len(left) == 1 and next(iter(left)).startswith("packing-") and rows.count() > 0
