"""Preparation and evaluation on hand-computed rows."""

import math
import random

import pytest
from factory import table
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from orderlore.operators import metrics as me
from orderlore.operators import prep as pr
from orderlore.operators import segments as sg
from orderlore.sources.files import read_matrix, write_csv
from orderlore.sources.schemas import MATRIX_SCHEMA
from orderlore.sources.tables import Tables, materialise, shared_folder


def test_fills(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (2, None, None), (3, 3, 7.0)], "order_id long, shifts_num long, lat double")
    filled = pr.fill_constant(pr.fill_mean(df, ["shifts_num"]), -999)
    assert [(r.shifts_num, r.lat) for r in filled.orderBy("order_id").collect()] == [(1.0, 5.0), (2.0, -999.0), (3.0, 7.0)]
    stored = pr.fill_mean(df, ["shifts_num"], {"shifts_num": 9.0})
    assert [r.shifts_num for r in stored.orderBy("order_id").collect()] == [1.0, 9.0, 3.0]
    empty = pr.fill_mean(df.where("order_id = 2"), ["shifts_num"])
    assert empty.first().shifts_num is None


def test_standardize_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    assert sorted(tuple(r) for r in pr.standardize(df, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]
    other = pr.standardize(df, ["a", "b"], {"a": (0.0, 2.0), "b": (0.0, 0.0)})
    assert sorted(tuple(r) for r in other.collect()) == [(0.5, 0.0), (1.5, 0.0)]


def test_codes_follow_the_order_of_values(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (10, "a")], "hour int, kind string")
    encoded, classes = pr.label_encode(df, "hour")
    assert sorted((r.value, r.code) for r in classes.collect()) == [(9, 0), (10, 1)]
    assert sorted((r.kind, r.hour) for r in encoded.collect()) == [("a", 0), ("a", 1), ("b", 1)]
    hot, classes = pr.one_hot(df, "kind")
    assert hot.columns == ["hour", "kind0", "kind1"]
    assert sorted(tuple(r) for r in hot.collect()) == [(9, 1, 0), (10, 0, 1), (10, 1, 0)]
    other, _ = pr.label_encode(spark.createDataFrame([(1, "b")], "hour int, kind string"), "kind", classes)
    assert [r.kind for r in other.collect()] == [1]
    for value in ("c", None):
        unseen = spark.createDataFrame([(1, value)], "hour int, kind string")
        with pytest.raises(PySparkException):
            pr.label_encode(unseen, "kind", classes)[0].collect()
        with pytest.raises(PySparkException):
            pr.one_hot(unseen, "kind", classes)[0].collect()


def test_codes_of_very_many_values(spark):
    df = spark.range(150_000).select((F.col("id") * 7 % 150_000).alias("id"))
    encoded, _ = pr.label_encode(df.withColumn("value_", F.col("id")), "id")
    row = encoded.agg(F.count("*"), F.count_if(F.col("id") != F.col("value_"))).first()
    assert tuple(row) == (150_000, 0)


def test_powers_and_sparse_columns(spark):
    df = spark.createDataFrame([(4, -1.0), (9, None)], "a long, b double")
    row = pr.power_features(df, ["a", "b"]).first()
    assert (row.a_sq, row.a_sqrt, row.b_sq) == (16.0, 2.0, 1.0) and math.isnan(row.b_sqrt)
    assert {r.feature: r.total for r in pr.column_totals(df, ["a", "b"]).collect()} == {"a": 13.0, "b": -1.0}
    assert pr.drop_sparse_columns(df, ["a", "b"], 13).columns == ["a"]


def test_segment_tokens(spark):
    df = spark.createDataFrame([(1, "a/b/a"), (2, None), (3, "a//")], "order_id long, segments string")
    counts = {(r.order_id, r.token): r.n for r in sg.segment_counts(df, "order_id").collect()}
    assert counts == {(1, "a"): 2, (1, "b"): 1, (2, "nan"): 1, (3, "a"): 1, (3, ""): 2}
    assert sg.segment_vocabulary(df) == ["", "a", "b", "nan"] and sg.segment_vocabulary(df, 2) == ["", "a"]
    vectors = sg.segment_vector(df, ["a", "b"]).orderBy("order_id").collect()
    assert [list(r.segment_vector.toArray()) for r in vectors] == [[2, 1], [0, 0], [1, 0]]
    presence = sg.segment_presence(df, ["a", "nan"], "order_id").orderBy("order_id").collect()
    assert [tuple(r) for r in presence] == [(1, 1, None), (2, None, 1), (3, 1, None)]


def test_bins_are_closed_on_the_right(spark):
    scores = [0.0, 0.1, 0.10001, 0.3, 1.0, 1.5]
    df = spark.createDataFrame([(i, 1, s) for i, s in enumerate(scores)], "order_id long, y int, p double")
    bins = [r.bin for r in me.score_bins(df, "y", "p").orderBy("order_id").collect()]
    assert bins == [None, "0-10", "10-20", "20-30", "90-100", None]


def _auc(spark, pairs):
    return me.roc_auc(spark.createDataFrame(pairs, "y int, p double"), "y", "p").first().auc


def test_auc_refuses_what_is_no_score(spark):
    for pair in ((0, None), (0, float("nan")), (None, 0.5)):
        with pytest.raises(PySparkException):
            _auc(spark, [(1, 0.9), (0, 0.1), pair])


def test_auc_of_counted_rows(spark):
    """Rows that stand for several give the AUC of the several."""
    rows = [(1, 0.9, 2), (0, 0.9, 1), (0, 0.4, 3), (1, 0.4, 1), (1, 0.7, 4)]
    counted = spark.createDataFrame(rows, "y int, p double, n long")
    single = spark.createDataFrame([(y, p) for y, p, n in rows for _ in range(n)], "y int, p double")
    assert me.roc_auc(counted, "y", "p", rows="n").first().auc == me.roc_auc(single, "y", "p").first().auc


def test_auc(spark):
    assert _auc(spark, [(0, 0.1), (1, 0.4), (0, 0.4), (1, 0.8)]) == 0.875
    assert _auc(spark, [(1, 0.1), (1, 0.4)]) is None
    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.4), round(rng.uniform(-2, 3), 3)) for _ in range(400)]
    wins = [(a > b) + (a == b) / 2 for y, a in pairs if y for z, b in pairs if not z]
    assert _auc(spark, pairs) == pytest.approx(sum(wins) / len(wins), abs=1e-12)
    monotone = [(y, 1 / (1 + math.exp(-p))) for y, p in pairs]
    assert _auc(spark, monotone) == pytest.approx(_auc(spark, pairs), abs=1e-12)
    grouped = spark.createDataFrame([(g, y, p) for g in (1, 2) for y, p in pairs if g == 1 or p > 0], "g int, y int, p double")
    both = {r.g: r.auc for r in me.roc_auc(grouped, "y", "p", "g").collect()}
    assert both[1] == pytest.approx(_auc(spark, pairs)) and both[2] == pytest.approx(_auc(spark, [x for x in pairs if x[1] > 0]))


def test_logloss_and_accuracy(spark):
    row = me.logloss_accuracy(spark.createDataFrame([(1, 0.8), (0, 0.0), (1, 0.5)], "y int, p double"), "y", "p").first()
    assert row.log_loss == pytest.approx((-math.log(0.8) - math.log(1 - 1e-7) - math.log(0.5)) / 3)
    assert row.accuracy == pytest.approx(2 / 3)


def test_folds_are_stable_and_even(spark):
    ids = spark.range(10000).withColumnRenamed("id", "order_id")
    one = {r.order_id: r.fold for r in me.kfold_split(ids, 5).collect()}
    two = {r.order_id: r.fold for r in me.kfold_split(ids.repartition(7), 5).collect()}
    assert one == two
    sizes = [list(one.values()).count(f) for f in range(5)]
    assert sum(sizes) == 10000 and max(sizes) - min(sizes) < 300


def test_matrix_files(spark):
    values = {n: 1 for n in MATRIX_SCHEMA.names} | {"lat": None, "discount_prc": 0.1 + 0.2}
    row = tuple(float(v) if v is not None and MATRIX_SCHEMA[n].dataType.simpleString() == "double" else v for n, v in values.items())
    matrix = spark.createDataFrame([row], MATRIX_SCHEMA)
    path = shared_folder(spark, "test")
    write_csv(matrix, path)
    assert [tuple(r) for r in read_matrix(spark, path).collect()] == [row]
    without = shared_folder(spark, "test")
    write_csv(matrix.drop("cancel"), without, sep=";")
    assert len(read_matrix(spark, without, target=False, sep=";").first()) == 34


def test_tables_from_views_and_buckets(spark):
    table(spark, "orders", {"id": 1}, {"id": 2, "user_id": 5}).createOrReplaceTempView("t_orders")
    assert Tables.catalog(spark, "t_")["orders"].count() == 2
    kept = materialise(spark.range(3), "test")
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2]


def test_stages_are_saved_with_what_they_learned(spark):
    from pyspark.ml import Pipeline, PipelineModel

    from orderlore.operators import encoders as en
    from orderlore.sources.tables import shared_folder

    schema = "id long, kind string, n int, x double, y double"
    train = spark.createDataFrame([(1, "b", 10, 1.0, 4.0), (2, "a", 2, None, 0.0), (3, "b", 2, 3.0, 2.0)], schema)
    stages = [
        en.CategoryEncoder(inputCols=["kind"]),
        en.CategoryEncoder(inputCols=["n"], oneHot=True),
        en.MeanFiller(inputCols=["x"]),
        en.ConstantFiller(inputCols=["y"], value=-1.0),
        en.PowerFeatures(inputCols=["y"]),
        en.Scaler(inputCols=["x"]),
    ]
    path = shared_folder(spark, "test")
    fitted = Pipeline(stages=stages).fit(train)
    fitted.write().overwrite().save(path)
    again = PipelineModel.load(path)
    other = spark.createDataFrame([(7, "a", 10, None, None), (8, "b", 2, 2.0, 9.0)], schema)
    got = [tuple(r) for r in again.transform(other).orderBy("id").select("id", "kind", "n0", "n1", "x", "y", "y_sq").collect()]
    assert got == [(7, 0, 0.0, 1.0, 0.0, -1.0, 1.0), (8, 1, 1.0, 0.0, 0.0, 9.0, 81.0)]
    assert sorted(again.transform(train).collect(), key=str) == sorted(fitted.transform(train).collect(), key=str)
    for unseen in ((9, "c", 2, 1.0, 1.0), (9, "a", 3, 1.0, 1.0), (9, None, 2, 1.0, 1.0)):
        with pytest.raises(Exception, match="without a code|has no code"):
            again.transform(spark.createDataFrame([unseen], schema)).collect()
    assert again.transform(other.where("false")).count() == 0


def test_near_scores_are_spread(spark):
    """Scores within a millionth of each other go to all ranges, and the area is exact."""
    n = 200_000
    score = F.lit(0.1) + (F.col("id") * 7919 % n) * 5e-12
    rows = spark.range(n).select(score.alias("p"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # small ranges are joined else
    spark.conf.set(coalesce, "false")
    try:
        counts = me.score_ranges(rows.groupBy(F.col("p").alias("score")).count())
    finally:
        spark.conf.unset(coalesce)
    sizes = [r["count"] for r in counts.groupBy("cell").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * n / 8
    by_score = sorted(((r.p, r.y) for r in rows.collect()))
    won = below = 0
    for _, y in by_score:
        won, below = (won + below, below) if y else (won, below + 1)
    pos = sum(y for _, y in by_score)
    assert me.roc_auc(rows, "y", "p").first().auc == pytest.approx(won / (pos * (n - pos)), abs=1e-12)


def test_vocabulary_of_any_size(spark):
    n = 200_000
    rows = spark.range(n).select("id", F.concat_ws("/", F.concat(F.lit("t"), F.lpad("id", 7, "0")), F.lit("hot")).alias("segments"))
    table_ = sg.vocabulary_table(rows)
    assert table_.count() == n + 1
    first = {r.token: (r.number, r.total) for r in table_.where("number IN (0, 1, 199999, 200000)").collect()}
    assert first == {"hot": (0, n), "t0000000": (1, 1), "t0199998": (n - 1, 1), "t0199999": (n, 1)}
    cells = sg.numbered_segments(rows, table_, "id")
    assert cells.agg(F.count("*"), F.sum("number"), F.count_if(F.col("number") == 0)).first()[:] == (2 * n, n * (n + 1) // 2, n)
    with pytest.raises(ValueError, match="vocabulary_table"):
        sg.segment_vocabulary(rows)


def test_sparse_vectors(spark):
    rows = [(1, "a/b/a"), (1, None), (2, ""), (3, "zz"), (1, "a/b/a"), (4, "b//nan")]
    df = spark.createDataFrame(rows, "order_id long, segments string")
    vocabulary = sg.vocabulary_table(df, 2)  # '', a, b, nan
    got = sorted((r.order_id, r.numbers, r.counts) for r in sg.numbered_vectors(df, vocabulary, "order_id").collect())
    assert got == [(1, [1, 2], [2, 1]), (1, [1, 2], [2, 1]), (1, [3], [1]), (2, [0], [1]), (3, [], []), (4, [0, 2, 3], [1, 1, 1])]
