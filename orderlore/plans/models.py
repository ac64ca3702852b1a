"""Training, tuning, storing and applying the cancellation model."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.operators.metrics import roc_auc
from orderlore.operators.prep import column_means, column_scales, fill_constant, fill_mean, standardize
from orderlore.operators.segments import segment_vector
from orderlore.plans import boosting, network
from orderlore.sources.schemas import FEATURES, MEAN_FILLED, SCORE_FILL, TRAIN_FILL
from orderlore.sources.tables import leaving_nothing, materialise, shared_folder

# --- fixed values: parameters of the published experiments ---------------------------

FINAL = {"maxIter": 70, "maxDepth": 5, "stepSize": 0.2, "seed": 241}
GRID = {
    "maxIter": [10, 20, 30, 50, 100],
    "maxDepth": [3, 5, 6, 7],
    "stepSize": [0.001, 0.002, 0.1, 0.2, 0.5, 1.0],
}
SEGMENT_GRID = {"maxIter": [10, 20], "maxDepth": [5, 6], "stepSize": [0.2]}
SAMPLED = {"maxIter": 1000, "stepSize": 0.2, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 0}
SAMPLED_GRID = {"maxDepth": [6], "minChildWeight": [1, 3]}
SAMPLED_FOLDS = 3
EARLY = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.2}
EARLY_SEGMENTS = {"maxIter": 300, "maxDepth": 30, "stepSize": 0.2}
PATIENCE = 10
NETWORK = {"hidden": [64, 64], "maxIter": 30, "blockSize": 128}
UNITS, PENALTY, EPOCHS, BATCH = (64, 64), 0.01, 30, 128
FOLDS, FOLD_SEED = 5, 42

_SEGMENT_VECTOR = "segment_vector"


@dataclass
class Preparation:
    """How rows become model input. Stored with the model.

    ``means``/``scales`` are given when the statistics of the training data are
    to be used everywhere; left out, every data set is filled and scaled
    with its own.
    """

    columns: list[str] = field(default_factory=lambda: list(FEATURES))
    mean_filled: list[str] = field(default_factory=lambda: list(MEAN_FILLED))
    train_fill: float = TRAIN_FILL
    score_fill: float = SCORE_FILL
    means: dict[str, float | None] | None = None
    scaled: bool = False
    scales: dict[str, tuple[float, float]] | None = None
    vocabulary: list[str] | None = None

    @classmethod
    def fitted(cls, train: DataFrame, scaled: bool = False, **settings) -> "Preparation":
        """Fill and scale with the statistics of the training data from now on."""
        prep = cls(scaled=scaled, **settings)
        prep.means = column_means(train, prep.mean_filled)
        if scaled:
            filled = fill_constant(fill_mean(train, prep.mean_filled, prep.means), prep.train_fill)
            prep.scales = column_scales(filled, prep.columns)
        return prep

    def apply(self, df: DataFrame, training: bool) -> DataFrame:
        """Features as doubles without nulls; key and other columns stay."""
        doubles = df.withColumns({c: F.col(c).cast("double") for c in self.columns})
        filled = fill_mean(doubles, [c for c in self.mean_filled if c in self.columns], self.means)
        filled = filled.na.fill(self.train_fill if training else self.score_fill, subset=self.columns)
        if self.scaled:
            filled = standardize(filled, self.columns, self.scales)
        if self.vocabulary:
            filled = segment_vector(filled, self.vocabulary, _SEGMENT_VECTOR)
        return filled

    def assembler(self) -> VectorAssembler:
        """Dense features and, as it is, the sparse segment vector."""
        extra = [_SEGMENT_VECTOR] if self.vocabulary else []
        return VectorAssembler(inputCols=[*self.columns, *extra], outputCol="features")

    def feature_names(self) -> list[str]:
        return [*self.columns, *(self.vocabulary or [])]


@dataclass
class CancellationModel:
    """A fitted pipeline with its preparation."""

    pipeline: PipelineModel
    preparation: Preparation

    def score(self, df: DataFrame, training: bool = False) -> DataFrame:
        """Adds ``will_cancel``, the probability of the order being canceled."""
        scored = self.pipeline.transform(self.preparation.apply(df, training))
        return scored.withColumn("will_cancel", vector_to_array("probability")[1])

    @property
    def booster(self) -> GBTClassificationModel:
        return self.pipeline.stages[-1]

    def save(self, path: str) -> None:
        """A folder with the Spark pipeline and the preparation as JSON text."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        text = json.dumps({"preparation": asdict(self.preparation)})
        spark = SparkSession.active()
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/preparation")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CancellationModel":
        stored = json.loads(spark.read.text(f"{path}/preparation", wholetext=True).first().value)
        return cls(PipelineModel.load(f"{path}/pipeline"), Preparation(**stored["preparation"]))


# --- fitting -------------------------------------------------------------------------


def _labelled(df: DataFrame, preparation: Preparation) -> DataFrame:
    return preparation.apply(df, training=True).withColumn("label", F.col("cancel").cast("double"))


def _boosting(preparation: Preparation, parameters: Mapping) -> Pipeline:
    return Pipeline(stages=[preparation.assembler(), GBTClassifier(**{**FINAL, **parameters})])


def train_gbt(train: DataFrame, preparation: Preparation | None = None, **parameters) -> CancellationModel:
    """Boosted trees. Fitting reads the data several times: give a stored matrix."""
    preparation = preparation or Preparation()
    return CancellationModel(_boosting(preparation, parameters).fit(_labelled(train, preparation)), preparation)


def train_mlp(train: DataFrame, preparation: Preparation | None = None, **parameters) -> CancellationModel:
    """Feed-forward network on standardised features.

    Spark's perceptron has sigmoid hidden layers, no weight penalty and a
    quasi-Newton optimiser; layer sizes, iterations and block size are kept.
    """
    preparation = preparation or Preparation(scaled=True, train_fill=SCORE_FILL)
    settings = {**NETWORK, "seed": 0, **parameters}
    layers = [len(preparation.feature_names()), *settings.pop("hidden"), 2]
    network = MultilayerPerceptronClassifier(layers=layers, **settings)
    pipeline = Pipeline(stages=[preparation.assembler(), network])
    return CancellationModel(pipeline.fit(_labelled(train, preparation)), preparation)


@dataclass
class NetworkModel:
    """Weights of a network with rectified units, and the preparation."""

    weights: network.Weights
    preparation: Preparation

    def score(self, df: DataFrame, training: bool = False) -> DataFrame:
        """Adds ``will_cancel``, the probability of the order being canceled."""
        rows = boosting.features(self.preparation.apply(df, training), self.preparation.columns)
        return network.score(rows, self.weights, "will_cancel")

    def save(self, path: str) -> None:
        """A folder with the table of layers and the preparation as JSON text."""
        spark = SparkSession.active()
        network.table(spark, self.weights).write.mode("overwrite").parquet(f"{path}/layers")
        text = json.dumps({"preparation": asdict(self.preparation)})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/preparation")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "NetworkModel":
        stored = json.loads(spark.read.text(f"{path}/preparation", wholetext=True).first().value)
        return cls(network.read(spark.read.parquet(f"{path}/layers")), Preparation(**stored["preparation"]))


#: Models that add will_cancel to rows.
Scorer = CancellationModel | NetworkModel


@leaving_nothing
def train_network(
    train: DataFrame, preparation: Preparation | None = None, plan: network.Plan | None = None, block: int | None = None
) -> NetworkModel:
    """The published network: two layers of rectified units, a penalty on the first one, mini-batches, steps scaled by
    a running mean of squares, on standardised features."""
    preparation = preparation or Preparation(scaled=True, train_fill=SCORE_FILL)
    plan = plan or network.Plan(UNITS, PENALTY, EPOCHS, BATCH)
    rows = boosting.features(_labelled(train, preparation), preparation.columns)
    rows = materialise(rows.select(F.xxhash64("order_id").alias("key"), "label", "x"), "search")
    return NetworkModel(network.train(rows, plan, block), preparation)


# --- tuning -----------------------------------------------------------------------------


def settings_of(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of a grid, the last parameter changing fastest."""
    combinations: list[dict] = [{}]
    for name, values in grid.items():
        combinations = [{**c, name: v} for c in combinations for v in values]
    return combinations


def _rows_of(folded: DataFrame, preparation: Preparation) -> DataFrame:
    """What a search grows on: key, label, fold, x. Rows with equal order ids are sampled together."""
    prepared = boosting.features(
        _labelled(folded, preparation), preparation.columns, _SEGMENT_VECTOR if preparation.vocabulary else None
    )
    return prepared.select(F.xxhash64("order_id").alias("key"), "label", F.col("fold").cast("int").alias("fold"), "x")


def _binned(rows: DataFrame, preparation: Preparation) -> boosting.Binning:
    values = [F.col("x")[i].alias(c) for i, c in enumerate(preparation.columns)]
    return boosting.binning(rows.select(*values), preparation.columns, len(preparation.vocabulary or []))


def _mean_aucs(margins: DataFrame) -> dict[tuple[int, int], float | None]:
    """AUC of each fit and round."""
    return {(r["fit"], r["round"]): r.auc for r in roc_auc(margins, "label", "margin", "fit", "round", rows="n").collect()}


@leaving_nothing
def cross_validate(
    folded: DataFrame, settings: Iterable[dict], preparation: Preparation | None = None, block: int | None = None
) -> DataFrame:
    """Mean AUC over folds of each setting.

    ``folded`` has a ``fold`` column. Settings that differ in the number of rounds alone are one fit per fold: the
    first rounds of the longest one. All fits grow together, level by level (see ``boosting``).
    """
    preparation = preparation or Preparation()
    settings = list(settings)
    rows = materialise(_rows_of(folded, preparation), "search")
    folds = sorted(r.fold for r in rows.select("fold").distinct().collect())
    bodies = [json.dumps({k: v for k, v in s.items() if k != "maxIter"}, sort_keys=True) for s in settings]
    longest = {b: max(s["maxIter"] for s, own in zip(settings, bodies) if own == b) for b in bodies}
    fits = [
        (b, boosting.Fit(boosting.Setting.of({**json.loads(b), "maxIter": n}), fold)) for b, n in longest.items() for fold in folds
    ]
    growth = boosting.Growth(rows, _binned(rows, preparation), [f for _, f in fits], block=block)
    aucs = _mean_aucs(growth.run(max(longest.values()), {s["maxIter"] for s in settings}))
    growth.close()
    out = []
    for setting, body in zip(settings, bodies):
        own = [aucs.get((k, setting["maxIter"])) for k, (b, _) in enumerate(fits) if b == body]
        known = [x for x in own if x is not None]
        out.append((json.dumps(setting, sort_keys=True), len(own), sum(known) / len(known) if known else None))
    return folded.sparkSession.createDataFrame(out, "setting string, folds int, auc double")


@dataclass
class BoostedModel:
    """Trees of a search with their preparation."""

    trees: boosting.Trees
    preparation: Preparation

    def score(self, df: DataFrame, training: bool = False) -> DataFrame:
        """Adds ``will_cancel``, the probability of the order being canceled."""
        prepared = self.preparation.apply(df, training)
        vector = _SEGMENT_VECTOR if self.preparation.vocabulary else None
        rows = boosting.features(prepared, self.preparation.columns, vector)
        return self.trees.score(rows.drop(_SEGMENT_VECTOR), "will_cancel")

    def split_counts(self) -> DataFrame:
        """How many splits use each feature, most first."""
        spark, names = SparkSession.active(), self.preparation.feature_names()
        named = spark.createDataFrame(list(enumerate(names)), "column int, feature string")
        counts = self.trees.nodes(spark).where("column >= 0").groupBy("column").agg(F.count("*").alias("splits"))
        return counts.join(named, "column").select("feature", "splits").orderBy(F.desc("splits"), "feature")

    def save(self, path: str) -> None:
        """A folder with the table of nodes and the preparation as JSON text."""
        spark = SparkSession.active()
        self.trees.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        text = json.dumps({"preparation": asdict(self.preparation)})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/preparation")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedModel":
        stored = json.loads(spark.read.text(f"{path}/preparation", wholetext=True).first().value)
        return cls(boosting.Trees.read(spark.read.parquet(f"{path}/nodes")), Preparation(**stored["preparation"]))


@leaving_nothing
def train_boosted(
    train: DataFrame, preparation: Preparation | None = None, block: int | None = None, **parameters
) -> BoostedModel:
    """Second-order boosted trees on all rows, with a least Hessian sum per child."""
    preparation = preparation or Preparation()
    rows = materialise(_rows_of(train.withColumn("fold", F.lit(0)), preparation), "search")
    bins, setting = _binned(rows, preparation), boosting.Setting.of(parameters)
    growth = boosting.Growth(rows, bins, [boosting.Fit(setting)], keep=True, block=block)
    growth.run(setting.rounds)
    growth.close()
    return BoostedModel(boosting.Trees.of(growth.trees[0], bins), preparation)


def grid_search(
    folded: DataFrame,
    base: Mapping = SAMPLED,
    grid: Mapping[str, Sequence] = SAMPLED_GRID,
    preparation: Preparation | None = None,
    block: int | None = None,
) -> tuple[BoostedModel, DataFrame]:
    """Cross-validated search that refits the best setting on everything.

    The fold column comes with the data. Rows and columns are subsampled per tree; a child has at least the
    setting's sum of Hessians. Of settings with equal AUC the first one is the best.
    """
    combinations = settings_of(grid)
    table = cross_validate(folded, [{**base, **s} for s in combinations], preparation, block)
    aucs = {r.setting: r.auc for r in table.collect()}
    found = [aucs[json.dumps({**base, **s}, sort_keys=True)] for s in combinations]
    best = max(range(len(found)), key=lambda i: (found[i] is not None, found[i] or 0.0, -i))
    model = train_boosted(folded.drop("fold"), preparation, block, **{**base, **combinations[best]})
    rows = [(json.dumps(s, sort_keys=True), auc) for s, auc in zip(combinations, found)]
    return model, folded.sparkSession.createDataFrame(rows, "setting string, auc double")


def stop_early(curve: Sequence[tuple[int, float]], patience: int) -> int:
    """Best round before ``patience`` rounds bring no better value."""
    best_round, best = 0, float("-inf")
    for number, value in sorted(curve):
        if value is not None and value > best:
            best_round, best = number, value
        elif number - best_round >= patience:
            break
    return best_round


@leaving_nothing
def early_stopping(
    train: DataFrame,
    validation: DataFrame,
    preparation: Preparation | None = None,
    patience: int = PATIENCE,
    block: int | None = None,
    **parameters,
) -> tuple[BoostedModel, DataFrame]:
    """Boosted trees cut at the round chosen by validation AUC, and the curve (round, auc, chosen) of the rounds grown.

    ``patience`` rounds grow at a time, with the exact AUC after each; growing ends as soon as so many rounds have
    brought no better value, so at most twice as many rounds grow behind the chosen one as the rule needs. Without both
    classes in the validation data nothing can be chosen, and all rounds stay.
    """
    preparation = preparation or Preparation()
    setting = boosting.Setting.of({**EARLY, **parameters})
    both = [_rows_of(df.withColumn("fold", F.lit(fold)), preparation) for fold, df in ((1, train), (0, validation))]
    rows = materialise(both[0].unionByName(both[1]), "search")
    bins = _binned(rows.where("fold = 1"), preparation)
    growth = boosting.Growth(rows, bins, [boosting.Fit(setting, 0)], keep=True, block=block)
    values: list[tuple[int, float | None]] = []
    while growth.done < setting.rounds:
        ahead = range(growth.done + 1, min(growth.done + patience, setting.rounds) + 1)
        aucs = _mean_aucs(growth.run(len(ahead), ahead))
        values += [(n, aucs.get((0, n))) for n in ahead]
        best = stop_early(values, patience)
        if best and growth.done - best >= patience:
            break
    growth.close()
    best = stop_early(values, patience) if any(v is not None for _, v in values) else 0
    trees = growth.trees[0][: best or len(growth.trees[0])]
    marked = train.sparkSession.createDataFrame([(n, v, n == best) for n, v in values], "round int, auc double, chosen boolean")
    return BoostedModel(boosting.Trees.of(trees, bins), preparation), marked



# --- inspection -----------------------------------------------------------------------------


def feature_importance(model: CancellationModel) -> DataFrame:
    """Importance of each feature, highest first."""
    values = model.pipeline.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(model.preparation.feature_names(), values)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def nodes(model: CancellationModel) -> DataFrame:
    """The trees of a boosted model as a table: (round, node, feature, left, right, output, rows); feature -1 is a leaf.

    Read from the nodes that the model writes when it is saved.
    """
    spark, path = SparkSession.active(), shared_folder(SparkSession.active(), "trees")
    model.booster.save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    return stored.select(
        (F.col("treeID") + 1).alias("round"), F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("prediction").alias("output"),
        F.col("rawCount").alias("rows"),
    )


def split_importance(model: CancellationModel) -> DataFrame:
    """How many splits of a boosted model use each feature, most first."""
    names = list(enumerate(model.preparation.feature_names()))
    named = SparkSession.active().createDataFrame(names, "feature_number int, feature string")
    counts = nodes(model).where("feature >= 0").groupBy(F.col("feature").alias("feature_number")).agg(F.count("*").alias("splits"))
    return counts.join(named, "feature_number").select("feature", "splits").orderBy(F.desc("splits"), "feature")


# --- scoring ----------------------------------------------------------------------------------


def score_orders(model: CancellationModel, matrix: DataFrame) -> DataFrame:
    """``(order_id, will_cancel)`` for each row of a scoring matrix."""
    return model.score(matrix).select("order_id", "will_cancel")


def score_files(
    spark: SparkSession, model_path: str, read: Callable[[], DataFrame], write: Callable[[DataFrame], None]
) -> None:
    """The batch job: load the stored model, read rows, write their scores.

    The rows are stored first, since filling and scoring both read them.
    """
    write(score_orders(CancellationModel.load(spark, model_path), materialise(read(), "to-score")))
