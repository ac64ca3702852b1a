"""A feed-forward network with rectified units, trained on mini-batches whose gradients Spark adds up.

A step takes one mini-batch and starts from the weights that the step before has left, however many rows there are.
Rows are put in a fixed random order and cut into mini-batches by many tasks; for each epoch Spark sorts the mini-batches by
their turn, and they stream through one task, which holds one at a time. Small tables pass several epochs in one job.

Where the caller names the rows of a block, a step takes one mini-batch of every block instead: tasks return the sums of
gradients, and the driver, which adds one sum per task, moves the weights: a step is one job without an exchange.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.sources.tables import discard, shared_folder

BLOCK = 16_384  # rows that are cut together where a table is cut by several tasks, about
WHOLE_ROWS = 524_288  # rows that one task cuts or that pass in one job, at most, but for one epoch
WHOLE_VALUES = 1 << 24  # inputs of rows that one task cuts, at most, but for those of BLOCK rows
PACKING = "zstd"  # how the inputs of a mini-batch are stored, column by column
CLIP = 1e-7  # probabilities are kept this far from 0 and 1 in the loss


@dataclass(frozen=True)
class Plan:
    """Units of the hidden layers, penalty of squared weights of the first layer, passes over the rows, rows of a
    mini-batch, and the rate, memory and least divisor of the steps."""

    hidden: tuple[int, ...] = (64, 64)
    penalty: float = 0.01
    epochs: int = 30
    batch: int = 128
    rate: float = 0.001
    memory: float = 0.9
    least: float = 1e-7
    seed: int = 0


@dataclass
class Weights:
    """Per layer a matrix and a row of offsets."""

    layers: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def start(cls, inputs: int, plan: Plan) -> "Weights":
        """Uniform within the root of 6 by the units on both sides; offsets 0."""
        rng = np.random.default_rng(plan.seed)
        sizes = [inputs, *plan.hidden, 1]
        bound = [(6 / (a + b)) ** 0.5 for a, b in zip(sizes, sizes[1:])]
        return cls([(rng.uniform(-r, r, (a, b)), np.zeros(b)) for a, b, r in zip(sizes, sizes[1:], bound)])

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for layer in self.layers for x in layer])

    def like(self, flat: np.ndarray) -> "Weights":
        """Weights of the same shape from their numbers."""
        layers, at = [], 0
        for w, b in self.layers:
            layers.append((flat[at : at + w.size].reshape(w.shape), flat[at + w.size : at + w.size + b.size]))
            at += w.size + b.size
        return Weights(layers)

    def outputs(self, x: np.ndarray) -> list[np.ndarray]:
        """What enters each layer, and the probabilities."""
        out = [x]
        for w, b in self.layers[:-1]:
            out.append(np.maximum(out[-1] @ w + b, 0.0))
        w, b = self.layers[-1]
        out.append(1 / (1 + np.exp(-np.clip(out[-1] @ w + b, -500, 500))))
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self.outputs(x)[-1][:, 0]


def loss(weights: Weights, x: np.ndarray, y: np.ndarray, plan: Plan) -> float:
    """Mean cross-entropy, and the penalty of the first layer."""
    p = np.clip(weights.probabilities(x), CLIP, 1 - CLIP)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + plan.penalty * (weights.layers[0][0] ** 2).sum())


def gradient_sum(weights: Weights, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum over the rows of the gradient of the cross-entropy."""
    inputs = weights.outputs(x)
    back, parts = inputs[-1] - y[:, None], []
    for k in range(len(weights.layers) - 1, -1, -1):
        parts[:0] = [inputs[k].T @ back, back.sum(axis=0)]
        if k:
            back = (back @ weights.layers[k][0].T) * (inputs[k] > 0)
    return np.concatenate([x.ravel() for x in parts])


class Steps:
    """Weights that move against gradients scaled by a running mean of their squares."""

    def __init__(self, weights: Weights, plan: Plan):
        self.weights, self.plan, self.square = weights, plan, np.zeros(len(weights.flat()))

    def take(self, total: np.ndarray, rows: int) -> None:
        gradient = total / rows
        first = self.weights.layers[0][0]
        gradient[: first.size] += 2 * self.plan.penalty * first.ravel()
        self.square = self.plan.memory * self.square + (1 - self.plan.memory) * gradient**2
        moved = self.weights.flat() - self.plan.rate * gradient / (np.sqrt(self.square) + self.plan.least)
        self.weights = self.weights.like(moved)


def _order(steps: Sequence[int], epoch: int, plan: Plan) -> list[int]:
    return np.random.default_rng([plan.seed, epoch]).permutation(sorted(steps)).tolist()


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray]:
    y = np.frombuffer(row["y"])
    return np.frombuffer(row["x"]).reshape(len(y), -1), y


def _dealt(rows: DataFrame, blocks: int, plan: Plan, path: str) -> None:
    """Mini-batches (block, x, y), in folders by their number within the block."""

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("order")
        y = table.column("label").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        parts = [slice(a, a + plan.batch) for a in range(0, len(y), plan.batch)]
        return pa.Table.from_arrays(
            [
                pa.array(range(len(parts)), pa.int32()),
                pa.array([key[0].as_py()] * len(parts), pa.int32()),
                pa.array([x[p].tobytes() for p in parts], pa.binary()),
                pa.array([y[p].tobytes() for p in parts], pa.binary()),
            ],
            ["step", "block", "x", "y"],
        )

    order = F.xxhash64("x", "label", "key")
    dealt = rows.withColumns({"order": order, "block": F.pmod(F.xxhash64(order), F.lit(blocks)).cast("int")})
    cuts = dealt.groupBy("block").applyInArrow(cut, "step int, block int, x binary, y binary")
    cuts.write.partitionBy("step").parquet(path)


def block_rows(rows: int, inputs: int) -> int:
    """How many rows one task cuts: all of them, as far as a task holds them."""
    return max(1, rows) if rows <= max(BLOCK, min(WHOLE_ROWS, WHOLE_VALUES // max(1, inputs))) else BLOCK


def train(rows: DataFrame, plan: Plan = Plan(), block: int | None = None) -> Weights:
    """Weights for ``rows`` (key, label 0 or 1 as double, x array<double> without nulls).

    All rows are seen once in each epoch, ``plan.batch`` of them in a step. Only if ``block`` is given and the table has
    more rows, a step sees as many of each block, and there are fewer steps.
    """
    spark = rows.sparkSession
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        raise ValueError("no rows to train on")
    start = Weights.start(first.n, plan)
    count = rows.count()
    path = shared_folder(spark, "batches")
    if block and count > block:
        _dealt(rows, -(-count // block), plan, path)
        weights = _in_steps(spark.read.schema("block int, x binary, y binary, step int").parquet(path), start, plan)
    else:
        _pieces(rows, -(-count // block_rows(count, first.n)), plan).write.parquet(path)
        weights = _in_turn(spark.read.schema(_PIECE).parquet(path), count, start, plan)
    discard(spark, path)
    return weights


_PIECE = "step long, first long, x binary, y binary"


def _pieces(rows: DataFrame, cells: int, plan: Plan) -> DataFrame:
    """Mini-batches of the rows in the order of their hashes. The rows are dealt to ranges of hashes, each cut by one task,
    so a mini-batch may come in pieces, of which ``first`` tells the order."""
    order = F.xxhash64("x", "label", "key")
    cell = F.least(F.lit(cells - 1), F.floor((order / F.lit(float(1 << 64)) + 0.5) * cells)).cast("int")
    dealt = rows.withColumn("order", order).withColumn("cell", cell)
    sizes = {r.cell: r["count"] for r in dealt.groupBy("cell").count().collect()}
    before = dict(zip(range(cells), np.cumsum([0, *(sizes.get(c, 0) for c in range(cells))]).tolist()))

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("order")
        y = table.column("label").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        start, codec = before[key[0].as_py()], pa.Codec(PACKING)
        ends = [*range(plan.batch - start % plan.batch, len(y), plan.batch), len(y)]
        parts = [slice(a, b) for a, b in zip([0, *ends], ends)]
        return pa.Table.from_arrays(
            [
                pa.array([(start + p.start) // plan.batch for p in parts], pa.int64()),
                pa.array([start + p.start for p in parts], pa.int64()),
                pa.array([codec.compress(x[p].T.tobytes(), asbytes=True) for p in parts], pa.binary()),
                pa.array([y[p].tobytes() for p in parts], pa.binary()),
            ],
            ["step", "first", "x", "y"],
        )

    return dealt.groupBy("cell").applyInArrow(cut, _PIECE)


def _turns(pieces: DataFrame, epochs: Sequence[int], steps: int, plan: Plan) -> DataFrame:
    """The pieces once for each epoch, in one partition, sorted by the turn of their mini-batch."""

    def placed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for k, epoch in enumerate(epochs):
                place = np.empty(steps, np.int64)
                place[_order(range(steps), epoch, plan)] = np.arange(k * steps, (k + 1) * steps)
                turn = pa.array(place[batch.column("step").to_numpy()])
                yield pa.RecordBatch.from_arrays([turn, *(batch.column(c) for c in ("first", "x", "y"))], ["turn", "first", "x", "y"])

    turned = pieces.mapInArrow(placed, "turn long, first long, x binary, y binary")
    return turned.repartition(1).sortWithinPartitions("turn", "first")


def _whole(found: Iterator[pa.RecordBatch], inputs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Mini-batches of sorted pieces."""
    codec, turn, xs, ys = pa.Codec(PACKING), None, [], []
    for batch in found:
        for i in range(batch.num_rows):
            own, y = batch.column(0)[i].as_py(), np.frombuffer(batch.column(3)[i].as_buffer())
            if own != turn and xs:
                yield np.concatenate(xs), np.concatenate(ys)
                xs, ys = [], []
            packed = codec.decompress(batch.column(2)[i].as_buffer(), decompressed_size=8 * inputs * len(y))
            xs.append(np.frombuffer(packed).reshape(inputs, -1).T)
            ys.append(y)
            turn = own
    if xs:
        yield np.concatenate(xs), np.concatenate(ys)


def _in_turn(pieces: DataFrame, count: int, start: Weights, plan: Plan) -> Weights:
    """One step after the other over all mini-batches, in each epoch in another order."""
    inputs, steps, moved = start.layers[0][0].shape[0], -(-count // plan.batch), Steps(start, plan)
    together = max(1, WHOLE_ROWS // count)
    for epoch in range(0, plan.epochs, together):
        epochs = range(epoch, min(epoch + together, plan.epochs))

        def run(found: Iterator[pa.RecordBatch], moved: Steps = moved) -> Iterator[pa.RecordBatch]:
            for x, y in _whole(found, inputs):
                moved.take(gradient_sum(moved.weights, x, y), len(y))
            left = [moved.weights.flat().tobytes(), moved.square.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in left], ["weights", "square"])

        left = _turns(pieces, epochs, steps, plan).mapInArrow(run, "weights binary, square binary").first()
        moved = Steps(start.like(np.frombuffer(left.weights)), plan)
        moved.square = np.frombuffer(left.square)
    return moved.weights


def _gradients(batches: DataFrame, step: int, weights: Weights) -> DataFrame:
    """Each task's sum of gradients over the mini-batches of a step, and its rows."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for batch in found:
            for row in batch.to_pylist():
                x, y = _arrays(row)
                total, n = total + gradient_sum(weights, x, y), n + len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["total", "n"])

    return batches.where(F.col("step") == step).mapInArrow(run, "total binary, n long")


def _in_steps(batches: DataFrame, start: Weights, plan: Plan) -> Weights:
    steps = Steps(start, plan)
    numbers = [r.step for r in batches.select("step").distinct().collect()]
    for epoch in range(plan.epochs):
        for k in _order(numbers, epoch, plan):
            parts = _gradients(batches, k, steps.weights).collect()
            steps.take(sum(np.frombuffer(r.total) for r in parts), sum(r.n for r in parts))
    return steps.weights


def score(rows: DataFrame, weights: Weights, output: str) -> DataFrame:
    """``rows`` (x array<double>, any others) with the probability of class 1 in place of x."""
    names = [c for c in rows.columns if c != "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                p = pa.array(weights.probabilities(x))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), p], [*names, output])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), f"`{output}` double"])
    return rows.select(*names, "x").mapInArrow(run, schema)


def table(spark: SparkSession, weights: Weights) -> DataFrame:
    """One row per layer: (layer, inputs, units, weights, offsets)."""
    rows = [(k, *w.shape, w.ravel().tolist(), b.tolist()) for k, (w, b) in enumerate(weights.layers)]
    return spark.createDataFrame(rows, "layer int, inputs int, units int, weights array<double>, offsets array<double>")


def read(layers: DataFrame) -> Weights:
    rows = layers.orderBy("layer").collect()
    return Weights([(np.array(r.weights).reshape(r.inputs, r.units), np.array(r.offsets)) for r in rows])
