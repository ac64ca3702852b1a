"""Models on a planted signal: scores, storage, tuning, early stopping."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlore.operators.metrics import kfold_split, roc_auc
from orderlore.plans import boosting, network, registry
from orderlore.plans import models as mo
from orderlore.sources.files import write_csv
from orderlore.sources.schemas import FEATURES, MATRIX_SCHEMA, MEAN_FILLED
from orderlore.sources.tables import materialise, shared_folder


@pytest.fixture(scope="module")
def matrix(spark):
    """Canceling depends on two columns; a few values are missing."""
    noise = {c: F.floor(F.rand(i) * 5) for i, c in enumerate(MATRIX_SCHEMA.names)}
    rows = spark.range(600).select(
        *[noise[f.name].cast(f.dataType).alias(f.name) for f in MATRIX_SCHEMA if f.name not in ("order_id", "cancel")],
        F.col("id").alias("order_id"),
    )
    likely = F.col("canceled_all_nt") * 2 - F.col("paid_all") + F.rand(99) * 2 > 2
    planted = rows.withColumn("cancel", likely.cast("int")).withColumns(
        {c: F.when(F.col("order_id") % 7 != 0, F.col(c)) for c in [*MEAN_FILLED, "lat"]}
    )
    return materialise(planted.select(*MATRIX_SCHEMA.names), "test")


def _auc(scored):
    return roc_auc(scored, "cancel", "will_cancel").first().auc


def test_boosted_trees_store_and_score(spark, matrix):
    folded = kfold_split(matrix, 5)
    train, test = folded.where("fold > 0"), folded.where("fold = 0")
    model = mo.train_gbt(train, maxIter=5, maxDepth=3)
    scored = model.score(test)
    low, high = scored.agg(F.min("will_cancel"), F.max("will_cancel")).first()
    assert 0 <= low < high <= 1 and _auc(scored) > 0.8
    path = shared_folder(spark, "test")
    model.save(path)
    again = mo.CancellationModel.load(spark, path)
    assert again.preparation == model.preparation
    assert mo.score_orders(again, test).exceptAll(mo.score_orders(model, test)).count() == 0
    top = mo.feature_importance(model).first().feature
    assert top in ("canceled_all_nt", "paid_all")
    splits = {r.feature: r.splits for r in mo.split_importance(again).collect()}
    assert set(splits) <= set(FEATURES) and splits["canceled_all_nt"] > 0
    trees = mo.nodes(again).collect()
    for number, tree in enumerate(model.booster.trees, 1):
        own = {r.node: r for r in trees if r["round"] == number}
        leaves = [r.output for r in sorted(own.values(), key=lambda r: r.node) if r.feature < 0]
        assert len(own) == tree.numNodes and len(leaves) == (tree.numNodes + 1) // 2
        assert [float(x.split("Predict: ")[1]) for x in tree.toDebugString.split("\n") if "Predict" in x] == leaves
    output = shared_folder(spark, "test")
    mo.score_files(spark, path, lambda: test.drop("cancel"), lambda scores: write_csv(scores, output))
    assert spark.read.csv(output, header=True).columns == ["order_id", "will_cancel"]


def test_stored_statistics(spark, matrix):
    own, stored = mo.Preparation(), mo.Preparation.fitted(matrix, scaled=True)
    part = matrix.where("order_id < 50")
    assert own.apply(part, True).where("shifts_num IS NULL").count() == 0
    assert stored.means is not None and set(stored.scales) == set(FEATURES)
    mean = stored.apply(matrix, True).agg(F.avg("paid_all")).first()[0]
    assert abs(mean) < 1e-9 and abs(stored.apply(part, True).agg(F.avg("paid_all")).first()[0]) > 1e-9
    fills = [own.apply(matrix, training).agg(F.min("lat")).first()[0] for training in (True, False)]
    assert fills == [-999.0, 0.0]


def test_network(matrix):
    model = mo.train_mlp(matrix, maxIter=30)
    assert _auc(model.score(matrix)) > 0.8


def test_gradient_of_the_network():
    rng = np.random.default_rng(4)
    plan = network.Plan(hidden=(5, 4), penalty=0.03, seed=2)
    weights = network.Weights.start(6, plan)
    x, y = rng.standard_normal((20, 6)), rng.integers(0, 2, 20).astype(float)
    flat = weights.flat()
    assert (weights.like(flat).flat() == flat).all()
    total = network.gradient_sum(weights, x, y) / 20
    total[: weights.layers[0][0].size] += 2 * plan.penalty * weights.layers[0][0].ravel()
    for i in range(len(flat)):
        ahead, behind = flat.copy(), flat.copy()
        ahead[i] += 1e-6
        behind[i] -= 1e-6
        slope = (network.loss(weights.like(ahead), x, y, plan) - network.loss(weights.like(behind), x, y, plan)) / 2e-6
        assert total[i] == pytest.approx(slope, abs=1e-7)
    steps = network.Steps(weights, plan)
    steps.take(network.gradient_sum(weights, x, y), 20)
    square = 0.1 * total**2
    assert steps.weights.flat() == pytest.approx(flat - plan.rate * total / (np.sqrt(square) + plan.least), abs=1e-12)


def test_published_network(spark, matrix):
    folded = kfold_split(matrix, 5)
    train, held = folded.where("fold > 0").drop("fold"), folded.where("fold = 0").drop("fold")
    model = mo.train_network(train)
    scored = model.score(held)
    assert [w.shape for w, _ in model.weights.layers] == [(32, 64), (64, 64), (64, 1)]
    assert _auc(scored) >= _auc(mo.train_mlp(train, maxIter=30).score(held)) - 0.02 and _auc(scored) > 0.8
    path = shared_folder(spark, "test")
    model.save(path)
    again = mo.NetworkModel.load(spark, path).score(held)
    assert again.select("order_id", "will_cancel").exceptAll(scored.select("order_id", "will_cancel")).count() == 0


def test_network_over_several_blocks(matrix):
    """Steps of several mini-batches: the sum over blocks is the gradient of the rows together, and the signal is learned."""
    plan = network.Plan(hidden=(16,), epochs=6, batch=32, rate=0.02)
    model = mo.train_network(matrix, plan=plan, block=200)
    assert _auc(model.score(matrix)) > 0.8
    whole = network.Plan(hidden=(4,), epochs=3, batch=10_000)
    one, many = (mo.train_network(matrix, plan=whole, block=b).weights.flat() for b in (16_384, 150))
    assert one == pytest.approx(many, abs=1e-9)


def test_network_does_not_depend_on_the_size(monkeypatch, matrix):
    """A table that several tasks cut, whose epochs are jobs of their own, has the steps and the weights of a small one."""
    plan = network.Plan(hidden=(8,), epochs=3, batch=32)
    small = mo.train_network(matrix, plan=plan).weights.flat()
    monkeypatch.setattr(network, "WHOLE_ROWS", 100)
    monkeypatch.setattr(network, "BLOCK", 100)
    taken = []
    monkeypatch.setattr(network, "_in_steps", lambda *a: taken.append(a))
    assert (mo.train_network(matrix, plan=plan).weights.flat() == small).all() and not taken


def test_steps_of_the_network_one_by_one(spark):
    """Rows in the order of their hashes, cut into mini-batches that come in another order in each epoch; the last one is short."""
    rng = np.random.default_rng(5)
    rows = [(i, float(i % 3 == 0), [float(v) for v in rng.integers(-2, 3, 2)]) for i in range(50)]
    df = spark.createDataFrame([*rows, rows[0]], "key long, label double, x array<double>").repartition(3)
    plan = network.Plan(hidden=(3,), epochs=4, batch=8)
    steps = network.Steps(network.Weights.start(2, plan), plan)
    own = [(r.label, r.x) for r in df.orderBy(F.xxhash64("x", "label", "key")).collect()]
    y, x = np.array([a for a, _ in own]), np.array([b for _, b in own])
    for epoch in range(plan.epochs):
        for k in np.random.default_rng([plan.seed, epoch]).permutation(7):
            part = slice(8 * k, 8 * k + 8)
            steps.take(network.gradient_sum(steps.weights, x[part], y[part]), len(y[part]))
    assert network.train(df, plan).flat() == pytest.approx(steps.weights.flat(), abs=1e-12)


def test_tuning(matrix):
    folded = kfold_split(matrix, 3)
    table = mo.cross_validate(folded, mo.settings_of({"maxIter": [1, 4], "maxDepth": [3], "stepSize": [0.2]})).collect()
    assert len(table) == 2 and all(r.folds == 3 and r.auc > 0.7 for r in table)
    best, table = mo.grid_search(folded, {**mo.SAMPLED, "maxIter": 4}, {"maxDepth": [1, 4], "minChildWeight": [1, 3]})
    aucs = [r.auc for r in table.collect()]
    assert len(aucs) == 4 and _auc(best.score(matrix)) > 0.7
    assert len(mo.settings_of(mo.GRID)) == 120 and len(mo.settings_of(mo.SEGMENT_GRID)) == 4


def test_shorter_runs_are_the_first_rounds_of_longer_ones(matrix):
    folded = kfold_split(matrix, 3)
    together = mo.cross_validate(folded, mo.settings_of({"maxIter": [2, 3, 6], "maxDepth": [2, 4], "stepSize": [0.1, 0.5]}))
    for r in together.where("setting LIKE '%0.5%'").collect():
        alone = mo.cross_validate(folded, [json.loads(r.setting)]).first()
        assert alone.auc == pytest.approx(r.auc, abs=1e-12)


def test_early_stopping(spark, matrix):
    folded = kfold_split(matrix, 5)
    train, held = folded.where("fold > 0"), folded.where("fold = 0")
    setting = {"maxIter": 30, "maxDepth": 3}
    model, curve = mo.early_stopping(train, held, patience=2, **setting)
    rows = curve.collect()
    _, full = mo.early_stopping(train, held, patience=30, **setting)
    all_rounds = [(r["round"], r.auc) for r in full.collect()]
    assert len(all_rounds) == 30 and [(r["round"], r.auc) for r in rows] == all_rounds[: len(rows)]
    (chosen,) = [r for r in rows if r.chosen]
    assert chosen["round"] == mo.stop_early(all_rounds, 2) == len(model.trees.rounds)
    assert chosen["round"] + 2 <= len(rows) <= min(chosen["round"] + 4, 30) and len(rows) < 30
    assert _auc(model.score(held, training=True)) == pytest.approx(chosen.auc, abs=1e-9)
    last = mo.train_boosted(train, **{**mo.EARLY, "maxIter": 3, "maxDepth": 3})
    assert _auc(last.score(held, training=True)) == pytest.approx(rows[2].auc, abs=1e-9)
    path = shared_folder(spark, "test")
    model.save(path)
    again = mo.BoostedModel.load(spark, path)
    key = lambda m: sorted((r.order_id, r.will_cancel) for r in m.score(held).select("order_id", "will_cancel").collect())
    assert again.preparation == model.preparation and key(again) == key(model)
    splits = {r.feature: r.splits for r in again.split_counts().collect()}
    assert splits["canceled_all_nt"] > 0 and set(splits) <= set(FEATURES)
    one_class = held.withColumn("cancel", F.lit(1))
    assert len(mo.early_stopping(train, one_class, patience=2, maxIter=5, maxDepth=2)[0].trees.rounds) == 5


def _plain_boosting(x, y, setting):
    """Margins after each round of exact second-order boosting on few distinct values, in plain Python."""
    margins, out = [0.0] * len(y), []
    for _ in range(setting.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g, h = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]

        def grow(rows, depth, g=g, h=h):
            total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
            score = lambda a, b: a * a / (b + setting.penalty)
            best = (boosting.LEAST_GAIN, None)
            if depth < setting.depth:
                for j in range(len(x[0])):
                    for cut in sorted({x[i][j] for i in rows})[:-1]:
                        left = [i for i in rows if x[i][j] <= cut]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        if min(hl, total_h - hl) < setting.child:
                            continue
                        gain = score(gl, hl) + score(total_g - gl, total_h - hl) - score(total_g, total_h)
                        if gain > best[0] + abs(best[0]) * 1e-9:
                            best = (gain, (j, cut))
            if best[1] is None:
                for i in rows:
                    margins[i] -= setting.rate * total_g / (total_h + setting.penalty)
                return
            j, cut = best[1]
            grow([i for i in rows if x[i][j] <= cut], depth + 1)
            grow([i for i in rows if x[i][j] > cut], depth + 1)

        grow(list(range(len(y))), 0)
        out.append(list(margins))
    return out


@pytest.mark.parametrize("block", [1 << 14, 120])
def test_trees_equal_plain_ones(spark, block):
    """In one block and in several, level by level; child weights that forbid splits; tokens among the columns."""
    rng = random.Random(1)
    x = [[rng.randint(0, 6), rng.randint(0, 3), rng.randint(0, 20), rng.choice([0, 0, 0, 1, 2])] for _ in range(500)]
    y = [int(a[0] - a[1] + a[3] + rng.random() * 4 > 4) for a in x]
    rows = [(i, float(b), i % 2, [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "key long, label double, fold int, x array<double>").repartition(3)
    bins = boosting.binning(df.select(*[F.col("x")[i].alias(f"c{i}") for i in range(3)]), ["c0", "c1", "c2"], 1)
    settings = [boosting.Setting(4, 3, 0.3, child, penalty) for child, penalty in ((1.0, 1.0), (8.0, 1.0), (0.0, 0.5))]
    growth = boosting.Growth(df, bins, [boosting.Fit(s) for s in settings], keep=True, block=block)
    assert (growth.blocks == 1) == (block > 500)
    growth.run(2)
    growth.run(2)
    growth.close()
    for k, setting in enumerate(settings):
        want = _plain_boosting(x, y, setting)[-1]
        got = boosting.Trees.of(growth.trees[k], bins).margins(np.array(x, float))
        assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("stored", [1 << 28, 0])
def test_fits_grow_in_tasks_over_several_blocks(spark, monkeypatch, stored):
    """A table of several blocks needs no job per round: each fit's blocks pass in one task, from its memory or its file, and the
    trees and margins are those of one block, also where growing goes on from stored margins."""
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 7, 900), rng.integers(0, 40, 900), rng.integers(0, 3, 900) * (rng.random(900) < 0.4)])
    y = (x[:, 0] + x[:, 2] + rng.random(900) * 5 > 5).astype(float)
    rows = [(i, float(b), i % 3, [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "key long, label double, fold int, x array<double>").repartition(3)
    bins = boosting.binning(df.select(*[F.col("x")[i].alias(f"c{i}") for i in range(2)]), ["c0", "c1"], 1)
    settings = [boosting.Setting(4, 3, 0.3), boosting.Setting(3, 4, 0.1, rows=0.7, columns=0.7, seed=3), boosting.Setting(4, 0, 0.3)]
    fits = [boosting.Fit(s, fold) for s in settings for fold in (0, 1, 2, None)]
    monkeypatch.setattr(boosting, "STORED", stored)
    monkeypatch.setattr(boosting, "SENT", 7)
    found = {}
    for blocks in (1, 6):
        if blocks > 1:
            monkeypatch.setattr(boosting, "BLOCK_ROWS", (150, 150))
            monkeypatch.setattr(boosting, "WHOLE_ROWS", 150)
            monkeypatch.setattr(boosting.Growth, "_level_by_level", None)
        growth = boosting.Growth(df, bins, fits, keep=True)
        assert growth.blocks == blocks
        seen = [r for n in (2, 2) for r in materialise(growth.run(n, {1, 4}), "test").collect()]
        growth.close()
        margins = {}
        for r in seen:
            margins.setdefault((r.fit, r["round"], r.label), []).extend([r.margin] * r.n)
        found[blocks] = growth.trees, {k: sorted(v) for k, v in margins.items()}
    assert [[t.column for t in own] for own in found[1][0]] == [[t.column for t in own] for own in found[6][0]]
    assert [len(own) for own in found[6][0]] == [4] * 4 + [3] * 4 + [4] * 4
    assert found[1][1].keys() == found[6][1].keys() and {k[0] for k in found[6][1]} == {k for k, f in enumerate(fits) if f.held is not None}
    for key, values in found[1][1].items():
        assert values == pytest.approx(found[6][1][key], abs=1e-9)
    assert sum(len(v) for k, v in found[6][1].items() if k[0] == 0) == 2 * 300
    one = boosting.Trees.of(found[6][0][0], bins).margins(x.astype(float))[np.arange(900) % 3 == 0]
    assert sorted(one) == pytest.approx(sorted(found[6][1][0, 4, 0.0] + found[6][1][0, 4, 1.0]), abs=1e-9)


def test_sums_of_bundled_columns():
    """Columns that are summed together give the sums of each column, also over chosen rows."""
    rng = np.random.default_rng(3)
    edges = [list(range(k)) for k in (4, 31, 1, 1, 20, 0)]
    bins = boosting.Binning([[float(v) for v in e] for e in edges], 2)
    x = np.hstack([rng.integers(0, 33, (400, 6)), rng.integers(0, 3, (400, 2)) * (rng.random((400, 2)) < 0.4)]).astype(float)
    cells = bins.bins(x)
    row = {"n": 400, "bins": cells.tobytes(), "labels": bytes(400), "folds": bytes(1600), "keys": b"", "margins": bytes(3200)}
    bundles = boosting.Bundles(bins)
    assert len(bundles.columns) < 6 and max(bundles.sizes) <= boosting.JOINT
    block = boosting._Block(row, bins, 1, bundles)
    slot, g, h = rng.integers(-1, 3, 400), rng.standard_normal(400), rng.random(400) * (rng.random(400) < 0.8)
    total = boosting.sums(block, bins, slot, 3, g, h)
    for k, weights in enumerate((g, h)):
        for s in range(3):
            own = np.flatnonzero((slot == s) & (h > 0))
            for j, (a, b) in enumerate(zip(bins.offsets(), bins.offsets()[1:])):
                want = np.bincount(cells[own, j], weights[own], b - a)
                assert total[k, s, a:b] == pytest.approx(want, abs=1e-9)
            assert total[k, s, -1] == pytest.approx(weights[own].sum(), abs=1e-9)


def test_sizes_of_blocks(spark):
    """A table that a task can hold is one block; larger ones are blocks of bounded rows, cells and margins."""
    assert boosting.block_rows(300_000, 32, 12) == 300_000 and boosting.block_rows(0, 32, 12) == 1
    assert boosting.block_rows(18_000_000, 32, 12) == 131_072 and boosting.block_rows(600_000, 32, 12) == 25_000
    assert boosting.block_rows(300_000, 10_000, 12) == 16_384
    assert network.block_rows(300_000, 32) == 300_000 and network.block_rows(600_000, 32) == network.BLOCK
    assert network.block_rows(300_000, 1_000) == network.BLOCK
    rows = spark.range(20_000).selectExpr("id key", "double(id % 2) label", "0 fold", "array(double(id % 5)) x")
    bins = boosting.Binning([[0.5, 1.5, 2.5, 3.5]])
    growth = boosting.Growth(rows, bins, [boosting.Fit(boosting.Setting(1, 2, 0.1))])
    assert growth.blocks == 1
    growth.close()
    many = [boosting.Fit(boosting.Setting(1, 2, 0.1, seed=k)) for k in range(300)]
    growth = boosting.Growth(rows, bins, many, block=10_000)
    assert growth.blocks == 2 and max(len(p) for p in growth.parts) * 10_000 * 8 <= boosting.MARGINS
    growth.close()


def test_a_step_of_the_network_is_one_stage(spark):
    """Tasks' sums of gradients return without an exchange."""
    plan = network.Plan(hidden=(3,), batch=4)
    x = np.arange(16.0).reshape(8, 2)
    rows = [(k, k, x[4 * k : 4 * k + 4].tobytes(), np.array([0.0, 1, 1, 0]).tobytes()) for k in range(2)]
    batches = spark.createDataFrame(rows, "block int, step int, x binary, y binary")
    start = network.Weights.start(2, plan)
    found = network._gradients(batches, 1, start)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    total = sum(np.frombuffer(r.total) for r in found.collect())
    assert total == pytest.approx(network.gradient_sum(start, x[4:], np.array([0.0, 1, 1, 0])), abs=1e-12)


def test_subsamples_do_not_depend_on_blocks(spark, matrix):
    folded = kfold_split(matrix, 3)
    settings = [{**mo.SAMPLED, "maxIter": 3, "maxDepth": 3, "minChildWeight": 1}]
    one, many = (mo.cross_validate(folded, settings, block=b).first().auc for b in (1 << 14, 150))
    assert one == pytest.approx(many, abs=1e-9)
    setting = boosting.Setting.of(settings[0])
    assert sum(boosting.allowed_columns(setting, 1, 32)) == 26
    assert list(boosting.allowed_columns(setting, 1, 32)) != list(boosting.allowed_columns(setting, 2, 32))


def test_patience():
    assert mo.stop_early([(1, 0.5), (2, 0.6), (3, 0.55), (4, 0.58), (5, 0.9)], 2) == 2
    assert mo.stop_early([(1, 0.5), (2, 0.6), (3, 0.55), (4, 0.7)], 2) == 4
    assert mo.stop_early([(1, 0.5), (2, 0.5)], 10) == 1


def test_segments_beside_features(matrix):
    rows = matrix.withColumn("segments", F.when(F.col("cancel") == 1, "x/y").otherwise("y"))
    preparation = mo.Preparation(columns=[], mean_filled=[], vocabulary=["x", "y"])
    model = mo.train_gbt(rows, preparation, maxIter=1, maxDepth=1)
    assert _auc(model.score(rows)) == 1.0
    assert mo.feature_importance(model).first().feature == "x"


def test_registered_at_published_size(matrix, monkeypatch):
    """What the registered searches ask for; nothing is fitted."""
    asked = {}

    def noted(name, *result):
        def run(*args, **named):
            asked[name] = (args, named)
            return result if len(result) > 1 else result[0]

        return run

    spark = matrix.sparkSession
    table = spark.createDataFrame([("{}", 1, 0.5, 1.0)], "setting string, folds int, auc double, seconds double")
    curve = spark.createDataFrame([(1, 0.5, True)], "round int, auc double, chosen boolean")
    model = mo.BoostedModel(boosting.Trees([]), mo.Preparation())
    rows = matrix.withColumn("segments", F.lit("x"))
    monkeypatch.setattr(registry, "_train", lambda *_: matrix)
    monkeypatch.setattr(registry, "_segment_rows", lambda *_: rows)
    monkeypatch.setattr(mo, "cross_validate", noted("cross_validate", table))
    monkeypatch.setattr(mo, "grid_search", noted("grid_search", model, table))
    monkeypatch.setattr(mo, "early_stopping", noted("early_stopping_segments", model, curve))
    for name in ("cross_validate", "grid_search", "early_stopping_segments"):
        registry.MODEL_QUERIES[name](spark, "")
    assert asked["cross_validate"][0][1] == mo.settings_of(mo.GRID)
    assert asked["grid_search"][0][1:] == (mo.SAMPLED, mo.SAMPLED_GRID)
    assert asked["early_stopping_segments"][0][3:] == (mo.PATIENCE,)
    assert asked["early_stopping_segments"][1] == mo.EARLY_SEGMENTS
