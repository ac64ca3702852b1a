"""The registered queries: each operator applied to the bridged test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlore.operators import classification as cl
from orderlore.operators import encoders as en
from orderlore.operators import history as hi
from orderlore.operators import metrics as me
from orderlore.operators import population as po
from orderlore.operators import prep as pr
from orderlore.operators import recency as re
from orderlore.operators import segments as sg
from orderlore.operators import state as st
from orderlore.plans import models as mo
from orderlore.plans.features import feature_matrix, feature_matrix_segments
from orderlore.sources.bridge import WEB_APP, WEB_SINCE, bridge
from orderlore.sources.files import read_matrix, write_csv
from orderlore.sources.schemas import (
    FEATURES,
    MEAN_FILLED,
    POWER_COLUMNS,
    SCORE_FILL,
    SEGMENT_TRAIN,
    TRAIN,
    TRAIN_FILL,
    VALIDATION,
    Window,
)
from orderlore.sources.tables import Tables, fingerprint, materialise, reused, shared_folder

AS_OF = dt.date(2017, 7, 10)  # fixed value: the run date of the scoring queries
DAILY_RUNS = 5  # run dates of the query of daily runs, the last one is AS_OF

Query = Callable[[SparkSession, str], DataFrame]


_stored: dict[tuple[str, str, str], DataFrame | Tables] = {}


def tables_of(spark: SparkSession, folder: str) -> Tables:
    """The order-history tables of a folder, each derived and written once, when it is first read, also for later
    sessions: the queries then start from stored tables, as they would in production."""
    key = (spark.sparkContext.applicationId, folder, "tables")
    if key not in _stored:
        derived, name = bridge(spark, folder), fingerprint(spark, [folder], "tables", folder)
        _stored[key] = Tables({t: (lambda t=t: reused(spark, f"table-{t}", name, lambda: derived[t])) for t in derived})
    return _stored[key]


def _kept(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A result for queries that start from it, written once for the files of a folder and read by later sessions."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stored:
        _stored[key] = reused(spark, name, fingerprint(spark, [folder], name, folder), build)
    return _stored[key]


def _on_tables(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(tables_of(spark, folder))


def scan_tables(tables: Tables) -> DataFrame:
    """Rows of each input table and how many fill one chosen column."""
    filled = {
        "orders": "id",
        "order_reminders": "perform_at",
        "deltas": "object",
        "diffs": "differences",
        "subscriptions": "deactivated_at",
        "users_roles": "user_id",
        "addresses": "lat",
        "web_events": "contexts",
        "segment_uploads": "segments",
    }
    counted = [
        tables[name].agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.count(column).alias("filled")
        )
        for name, column in filled.items()
    ]
    union = counted[0]
    for more in counted[1:]:
        union = union.unionByName(more)
    return union


def late_cancel_population(tables: Tables) -> DataFrame:
    runs = {"train": TRAIN, "validation": VALIDATION, "segments": SEGMENT_TRAIN}
    parts = [
        po.population(tables["orders"], "train", window).select(
            F.lit(run).alias("run"), F.col("id").alias("order_id"), "user_id", "start_at"
        )
        for run, window in runs.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def changes_of(spark: SparkSession, folder: str) -> DataFrame:
    """The change summary, stored: classification and shift counts both read it."""
    return _kept(spark, folder, "changes", lambda: hi.change_summary(tables_of(spark, folder)["deltas"]))


def classified_of(spark: SparkSession, folder: str) -> DataFrame:
    """The classification, computed once and stored, as all history measures start from it."""
    return _kept(
        spark, folder, "classified", lambda: cl.classified_orders(tables_of(spark, folder), changes_of(spark, folder))
    )


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return re.order_history(tables_of(spark, folder)["orders"], classified_of(spark, folder), "train", VALIDATION)


def _inputs(spark: SparkSession, folder: str) -> dict:
    return {"classified": classified_of(spark, folder), "changes": changes_of(spark, folder)}


def training_matrix(spark: SparkSession, folder: str, window: Window = TRAIN) -> DataFrame:
    return feature_matrix(tables_of(spark, folder), "train", window, **_inputs(spark, folder))


def scoring_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return feature_matrix(tables_of(spark, folder), "predict", Window.next_days(AS_OF), **_inputs(spark, folder))


def daily_matrices(spark: SparkSession, folder: str) -> DataFrame:
    """The scoring matrices of consecutive run dates, each from the state that the run before left."""
    tables, inputs = tables_of(spark, folder), _inputs(spark, folder)
    path, days = shared_folder(spark, "history"), []
    for back in range(DAILY_RUNS - 1, -1, -1):
        date = AS_OF - dt.timedelta(days=back)
        state = st.advance_state(spark, path, tables["orders"], inputs["classified"], date)
        matrix = feature_matrix(tables, "predict", Window.next_days(date), state=state, **inputs)
        days.append(materialise(matrix.select(F.lit(date).alias("run_date"), "*"), "day"))
    return reduce(DataFrame.unionByName, days)


def segment_matrix_rows(spark: SparkSession, folder: str, dedupe: str = "none") -> DataFrame:
    return feature_matrix_segments(
        tables_of(spark, folder), SEGMENT_TRAIN, WEB_APP, WEB_SINCE, dedupe, **_inputs(spark, folder)
    )


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    write_csv(segment_matrix_rows(spark, folder), path)
    return read_matrix(spark, path, segments=True)


DATA_QUERIES: dict[str, Query] = {
    "scan_tables": _on_tables(scan_tables),
    "latest_reminder": _on_tables(lambda t: hi.latest_reminder(t["order_reminders"])),
    "unpacked_deltas": _on_tables(lambda t: hi.unpacked_deltas(t["deltas"], t["orders"])),
    "logged_cancellations": _on_tables(lambda t: hi.logged_cancellations(t["deltas"], t["orders"])),
    "crm_cancellations": _on_tables(lambda t: hi.crm_cancellations(t["diffs"])),
    "subscription_cancel_rank": _on_tables(lambda t: hi.subscription_cancel_rank(t["subscriptions"], t["orders"])),
    "cancel_classification": _on_tables(lambda t: cl.explode_multiplicity(cl.classified_orders(t))),
    "classification_fanout": _on_tables(lambda t: cl.classification_fanout(cl.classified_orders(t))),
    "cancel_type_counts": _on_tables(
        lambda t: cl.classified_orders(t)
        .groupBy("cancel_type")
        .agg(F.count("*").alias("orders"), F.sum("multiplicity").alias("row_count"))
    ),
    "late_cancel_population": _on_tables(late_cancel_population),
    "predict_population": _on_tables(
        lambda t: po.population(t["orders"], "predict", Window.next_days(AS_OF)).select(
            F.col("id").alias("order_id"), "user_id", "start_at"
        )
    ),
    "user_history_join": lambda spark, folder: re.history_size(
        tables_of(spark, folder)["orders"], classified_of(spark, folder), "train", VALIDATION
    ),
    "orders_recency_info": lambda spark, folder: re.orders_recency_info(_history(spark, folder)),
    "orders_general_info": _on_tables(
        lambda t: po.orders_general_info(t["orders"], t["addresses"], "train", VALIDATION)
    ),
    "order_shifts": _on_tables(
        lambda t: po.order_shifts(
            hi.change_summary(t["deltas"]),
            po.population(t["orders"], "train", VALIDATION).select(F.col("id").alias("order_id")),
        )
    ),
    "dow_cleanings": lambda spark, folder: re.dow_cleanings(_history(spark, folder)),
    "feature_matrix_train": lambda spark, folder: training_matrix(spark, folder, VALIDATION),
    "feature_matrix_train_window": training_matrix,
    "feature_matrix_predict": scoring_matrix,
    "feature_matrix_daily": daily_matrices,
    "csv_roundtrip": csv_roundtrip,
    "trackings": _on_tables(lambda t: sg.trackings(t["web_events"], WEB_APP, WEB_SINCE)),
    "latest_segments": _on_tables(lambda t: sg.latest_segments(t["segment_uploads"]).drop("date")),
    "feature_matrix_segments": segment_matrix_rows,
    "feature_matrix_segments_latest": lambda spark, folder: segment_matrix_rows(spark, folder, "latest"),
}


# --- preparation and evaluation, on stored matrices -------------------------------------

def _train(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(spark, folder, "train", lambda: training_matrix(spark, folder))


def _validation(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(spark, folder, "validation", lambda: training_matrix(spark, folder, VALIDATION))


def _segment_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(spark, folder, "segments", lambda: segment_matrix_rows(spark, folder))


def store_matrices(spark: SparkSession, folder: str) -> None:
    """The stored matrices that preparation and model queries start from."""
    for build in (_train, _validation, _segment_rows):
        build(spark, folder)


def _rounded(name: str):
    """Six decimals, without a negative zero: sums of doubles depend on their order."""
    return (F.round(name, 6) + F.lit(0.0)).alias(name)


def _mean_filled(spark: SparkSession, folder: str) -> DataFrame:
    filled = pr.fill_mean(_validation(spark, folder), MEAN_FILLED)
    return filled.withColumns({c: _rounded(c) for c in MEAN_FILLED})


def _categories(tables: Tables) -> DataFrame:
    return tables["orders"].select(
        F.col("id").alias("order_id"), "creation_mean", "payment_type", F.hour("start_at").alias("start_hour")
    )


def label_encode(tables: Tables) -> DataFrame:
    encoded = _categories(tables)
    for column in ("creation_mean", "payment_type", "start_hour"):
        encoded, _ = pr.label_encode(encoded, column)
    return encoded


def one_hot(tables: Tables) -> DataFrame:
    encoded = _categories(tables)
    for column in ("creation_mean", "payment_type", "start_hour"):
        encoded, _ = pr.one_hot(encoded, column)
    return encoded


def power_features(spark: SparkSession, folder: str) -> DataFrame:
    powers = pr.power_features(_validation(spark, folder), POWER_COLUMNS)
    names = [f"{c}_{kind}" for kind in ("sq", "sqrt") for c in POWER_COLUMNS]
    return powers.select("order_id", *[_rounded(n) for n in names])


def standardize(spark: SparkSession, folder: str) -> DataFrame:
    filled = pr.fill_mean(_validation(spark, folder), MEAN_FILLED).na.fill(SCORE_FILL)
    return pr.standardize(filled, FEATURES).select("order_id", *[_rounded(c) for c in FEATURES])


def drop_sparse_columns(spark: SparkSession, folder: str) -> DataFrame:
    totals = pr.column_totals(_validation(spark, folder), FEATURES)
    return totals.select("feature", _rounded("total"), (F.col("total") >= sg.MIN_TOTAL).alias("kept"))


def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The matrix without its sparse columns, as rows of order, column, value."""
    matrix = pr.drop_sparse_columns(_validation(spark, folder), FEATURES, sg.MIN_TOTAL)
    kept = [c for c in FEATURES if c in matrix.columns]
    values = matrix.select("order_id", *[F.col(c).cast("double") for c in kept])
    return values.unpivot("order_id", kept, "feature", "value")


def label_transform(tables: Tables) -> DataFrame:
    """Codes fitted on the orders before the validation window, applied to those in it."""
    rows = _categories(tables).join(tables["orders"].select(F.col("id").alias("order_id"), "start_at"), "order_id")
    day = F.to_date("start_at")
    fitted = rows.where(day < F.lit(VALIDATION.start))
    applied = rows.where((day >= F.lit(VALIDATION.start)) & (day < F.lit(VALIDATION.end)))
    for column in ("creation_mean", "payment_type"):
        applied, _ = pr.label_encode(applied, column, pr.category_classes(fitted, column))
    return applied.select("order_id", "creation_mean", "payment_type")


def encoder_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Stages fitted on the orders before the validation window, saved, loaded, and applied to those in it."""
    orders = tables_of(spark, folder)["orders"]
    rows = orders.select(
        F.col("id").alias("order_id"), "start_at", "creation_mean", "payment_type", F.hour("start_at").alias("start_hour"),
        F.hour("canceled_at").alias("cancel_hour"),
    )
    stages = [
        en.CategoryEncoder(inputCols=["creation_mean"]),
        en.CategoryEncoder(inputCols=["payment_type"], oneHot=True),
        en.MeanFiller(inputCols=["cancel_hour"]),
        en.PowerFeatures(inputCols=["start_hour"]),
        en.Scaler(inputCols=["start_hour"]),
    ]
    day, path = F.to_date("start_at"), shared_folder(spark, "encoders")
    Pipeline(stages=stages).fit(rows.where(day < F.lit(VALIDATION.start))).write().overwrite().save(path)
    window = rows.where((day >= F.lit(VALIDATION.start)) & (day < F.lit(VALIDATION.end)))
    numbers = ["cancel_hour", "start_hour", "start_hour_sq", "start_hour_sqrt"]
    return PipelineModel.load(path).transform(window).select(
        "order_id", "creation_mean", "payment_type0", "payment_type1", *[_rounded(c) for c in numbers]
    )


def score_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Bins written as a file and read back."""
    path = shared_folder(spark, "bins")
    bins = me.score_bins(_share_as_score(spark, folder), "cancel", "score")
    write_csv(bins, path)
    return spark.read.csv(path, header=True, schema=bins.schema)


def segment_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    totals = sg.token_totals(_segment_rows(spark, folder))
    return totals.select("token", "total", (F.col("total") >= sg.MIN_TOTAL).alias("kept"))


def segment_presence(spark: SparkSession, folder: str) -> DataFrame:
    known = sg.segment_vocabulary(tables_of(spark, folder)["segment_uploads"])
    return sg.segment_presence(_segment_rows(spark, folder), [*known, sg.MISSING], "order_id", prefix="has_")


def segment_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The matrix over the vocabulary of the rows, as numbers."""
    rows = _segment_rows(spark, folder)
    return sg.numbered_segments(rows, sg.vocabulary_table(rows), "order_id")


def segment_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The same over frequent tokens, a row per row, as text for comparison."""
    rows = _segment_rows(spark, folder)
    vectors = sg.numbered_vectors(rows, sg.vocabulary_table(rows, sg.MIN_TOTAL), "order_id")
    return vectors.select("order_id", *[F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) for c in ("numbers", "counts")])


def _share_as_score(spark: SparkSession, folder: str) -> DataFrame:
    """A column of the matrix in the place of a model's score, so that SQL can repeat the evaluation."""
    return _validation(spark, folder).select("order_id", "cancel", F.col("canceled_all_nt_share").alias("score"))


PREP_QUERIES: dict[str, Query] = {
    "dataset_profile": lambda spark, folder: pr.dataset_profile(_validation(spark, folder)),
    "fill_mean": lambda spark, folder: _mean_filled(spark, folder).select("order_id", *MEAN_FILLED),
    "fill_constant": lambda spark, folder: pr.fill_constant(_validation(spark, folder), TRAIN_FILL),
    "label_encode": _on_tables(label_encode),
    "one_hot": _on_tables(one_hot),
    "power_features": power_features,
    "segment_matrix": lambda spark, folder: sg.segment_counts(_segment_rows(spark, folder), "order_id"),
    "segment_vocabulary": segment_vocabulary,
    "segment_presence": segment_presence,
    "segment_numbers": segment_numbers,
    "segment_vectors": segment_vectors,
    "drop_sparse_columns": drop_sparse_columns,
    "standardize": standardize,
    "model_input": lambda spark, folder: pr.model_input(pr.fill_constant(_mean_filled(spark, folder), TRAIN_FILL)),
    "kfold_split": _on_tables(
        lambda t: me.kfold_split(
            po.population(t["orders"], "train", TRAIN).select(F.col("id").alias("order_id")), mo.FOLDS, mo.FOLD_SEED
        )
    ),
    "roc_auc": lambda spark, folder: me.roc_auc(_share_as_score(spark, folder), "cancel", "score").select(
        _rounded("auc")
    ),
    "logloss_accuracy": lambda spark, folder: me.logloss_accuracy(
        _share_as_score(spark, folder), "cancel", "score"
    ).select(_rounded("log_loss"), _rounded("accuracy")),
    "score_bins": score_bins,
    "drop_columns": drop_columns,
    "label_transform": _on_tables(label_transform),
    "encoder_roundtrip": encoder_roundtrip,
}


# --- models ---------------------------------------------------------------------------------
# Learned numbers cannot be told in SQL, so the queries return what can: the rows that a model scores, whether each score
# is a probability, and whether a search or a stopping rule did what it says. The functions of models.py return the values.

def _is_probability() -> Column:
    return F.col("will_cancel").between(0, 1).alias("is_probability")


def _learned(model: mo.Scorer, rows: DataFrame, least: float) -> Column:
    """Whether a model ranks the rows that it was fitted on better than ``least``; chance gives 0.5, one score for all too."""
    auc = me.roc_auc(model.score(rows, training=True), "cancel", "will_cancel").first().auc
    return F.lit(auc is not None and auc > least).alias("learned")


def final_model(spark: SparkSession, folder: str) -> tuple[mo.CancellationModel, str]:
    """The published final model, fitted once per session and folder and loaded from where it is stored."""
    key = (spark.sparkContext.applicationId, folder, "final-model")
    if key not in _stored:
        path = shared_folder(spark, "model")
        mo.train_gbt(_train(spark, folder)).save(path)
        _stored[key] = path
    return mo.CancellationModel.load(spark, _stored[key]), _stored[key]


def train_gbt(spark: SparkSession, folder: str) -> DataFrame:
    model = final_model(spark, folder)[0]
    scored = model.score(_validation(spark, folder), training=True)
    return scored.select("order_id", "cancel", _is_probability(), _learned(model, _train(spark, folder), 0.75))


def train_gbt_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Features and segment counts together; rare segments are left out before vectors are built."""
    rows = _segment_rows(spark, folder)
    preparation = mo.Preparation(train_fill=SCORE_FILL, vocabulary=sg.segment_vocabulary(rows, sg.MIN_TOTAL))
    model = mo.train_gbt(rows, preparation)
    scored = model.score(rows, training=True)
    return scored.select("order_id", "segments", "cancel", _is_probability(), _learned(model, rows, 0.75))


def train_mlp(spark: SparkSession, folder: str) -> DataFrame:
    """The published network, all epochs."""
    model = mo.train_network(_train(spark, folder))
    scored = model.score(_validation(spark, folder))
    return scored.select("order_id", "cancel", _is_probability(), _learned(model, _train(spark, folder), 0.55))


def _auc_in_range() -> Column:
    return F.col("auc").between(0, 1).alias("auc_in_range")


def cross_validate(spark: SparkSession, folder: str) -> DataFrame:
    """The published grid, 120 settings in 5 folds."""
    folded = me.kfold_split(_train(spark, folder), mo.FOLDS, mo.FOLD_SEED)
    table = mo.cross_validate(folded, mo.settings_of(mo.GRID))
    return table.select("setting", "folds", _auc_in_range())


def cross_validate_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The published grid of the segment model."""
    rows = _segment_rows(spark, folder)
    preparation = mo.Preparation(train_fill=SCORE_FILL, vocabulary=sg.segment_vocabulary(rows, sg.MIN_TOTAL))
    folded = materialise(me.kfold_split(rows, mo.FOLDS, mo.FOLD_SEED), "folded")
    table = mo.cross_validate(folded, mo.settings_of(mo.SEGMENT_GRID), preparation)
    return table.select("setting", "folds", _auc_in_range())


def grid_search(spark: SparkSession, folder: str) -> DataFrame:
    """The published search, 6 fits of 1000 trees, and the best setting fitted on everything."""
    folded = me.kfold_split(_train(spark, folder), mo.SAMPLED_FOLDS, mo.FOLD_SEED)
    model, table = mo.grid_search(folded, mo.SAMPLED, mo.SAMPLED_GRID)
    scores = model.score(_train(spark, folder), training=True)
    learned = me.roc_auc(scores, "cancel", "will_cancel").select((F.col("auc") > 0.9).alias("fits_its_rows"))
    return table.join(learned).select("setting", _auc_in_range(), "fits_its_rows")  # one row


def _holdout(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    folded = me.kfold_split(matrix, mo.FOLDS, mo.FOLD_SEED)
    return folded.where("fold <> 0"), folded.where("fold = 0")


def _stopped(spark: SparkSession, model: mo.BoostedModel, curve: DataFrame, validation: DataFrame, rounds: int) -> DataFrame:
    """Whether each part of the stopping rule holds, and whether the model that is returned has the chosen round's AUC."""
    best = curve.where("chosen").select(F.col("round").alias("best"), F.col("auc").alias("best_auc"))
    own = me.roc_auc(model.score(validation, training=True), "cancel", "will_cancel").select(F.col("auc").alias("own"))
    sums = curve.join(best).agg(  # one row
        F.max("round").alias("grown"), F.max("best").alias("best"), F.max("best_auc").alias("best_auc"),
        F.count_if("chosen").alias("chosen"),
        F.max(F.when(F.col("round") < F.col("best"), F.col("auc"))).alias("before"),
        F.max(F.when(F.col("round").between(F.col("best") + 1, F.col("best") + mo.PATIENCE), F.col("auc"))).alias("after"),
    ).join(own)
    rules = {
        "one round is chosen": F.col("chosen") == 1,
        "it is better than all before": F.coalesce(F.col("before") < F.col("best_auc"), F.lit(True)),
        "none of the next ones is better": F.coalesce(F.col("after") <= F.col("best_auc"), F.lit(True)),
        "growing ends after the patience": F.col("grown") <= F.least(F.col("best") + 2 * mo.PATIENCE, F.lit(rounds)),
        "and not before": F.col("grown") >= F.least(F.col("best") + mo.PATIENCE, F.lit(rounds)),
        "the model is that of the round": F.abs(F.col("own") - F.col("best_auc")) < 1e-9,
        "the model has its trees": F.col("best") == len(model.trees.rounds),
    }
    told = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("holds")) for k, v in rules.items()])).alias("x")
    return sums.select(told).select("x.rule", F.coalesce("x.holds", F.lit(False)).alias("holds"))


def early_stopping(spark: SparkSession, folder: str) -> DataFrame:
    train, held = _holdout(_train(spark, folder))
    model, curve = mo.early_stopping(train, held)
    return _stopped(spark, model, curve, held, mo.EARLY["maxIter"])


def early_stopping_segments(spark: SparkSession, folder: str) -> DataFrame:
    """On segment counts alone, at the published depth and rounds."""
    rows = _segment_rows(spark, folder)
    vocabulary = sg.segment_vocabulary(rows, sg.MIN_TOTAL)
    preparation = mo.Preparation(columns=[], mean_filled=[], vocabulary=vocabulary)
    train, held = _holdout(rows)
    model, curve = mo.early_stopping(train, held, preparation, mo.PATIENCE, **mo.EARLY_SEGMENTS)
    return _stopped(spark, model, curve, held, mo.EARLY_SEGMENTS["maxIter"])


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Written and read back as a file: every feature, and the sum of all importances."""
    path = shared_folder(spark, "importance")
    write_csv(mo.feature_importance(final_model(spark, folder)[0]), path)
    table = spark.read.csv(path, header=True, schema="feature string, importance double")
    return table.select("feature", F.round(F.sum("importance").over(W.partitionBy(F.lit(1))), 6).alias("total"))


def split_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Splits of features that the model does not have, and whether there are any splits."""
    table = mo.split_importance(final_model(spark, folder)[0])
    return table.agg(
        F.count_if(~F.col("feature").isin(FEATURES)).alias("unknown_features"), (F.sum("splits") > 0).alias("has_splits")
    )


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of a model and of the same model after saving and loading it."""
    model, path = final_model(spark, folder)[0], shared_folder(spark, "model")
    model.save(path)
    matrix = _validation(spark, folder)
    before = mo.score_orders(model, matrix).withColumnRenamed("will_cancel", "before")
    after = mo.score_orders(mo.CancellationModel.load(spark, path), matrix).withColumnRenamed("will_cancel", "after")
    return before.join(after, "order_id").select("order_id", (F.col("before") == F.col("after")).alias("same"))


def score_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job: a stored model, the scoring matrix, scores written as CSV."""
    output = shared_folder(spark, "scores")
    mo.score_files(
        spark,
        final_model(spark, folder)[1],
        lambda: scoring_matrix(spark, folder),
        lambda scores: write_csv(scores, output),
    )
    scores = spark.read.csv(output, header=True, schema="order_id bigint, will_cancel double")
    low, high = scores.agg(F.min("will_cancel"), F.max("will_cancel")).first()
    return scores.select("order_id", _is_probability(), F.lit(low < high).alias("varies"))


MODEL_QUERIES: dict[str, Query] = {
    "train_gbt": train_gbt,
    "train_gbt_segments": train_gbt_segments,
    "train_mlp": train_mlp,
    "cross_validate": cross_validate,
    "cross_validate_segments": cross_validate_segments,
    "grid_search": grid_search,
    "early_stopping": early_stopping,
    "early_stopping_segments": early_stopping_segments,
    "feature_importance": feature_importance,
    "split_importance": split_importance,
    "model_roundtrip": model_roundtrip,
    "score_orders": score_orders,
}
