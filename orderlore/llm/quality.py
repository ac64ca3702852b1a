"""Quality of texts by a linear model on n-gram indicators that are scaled by naive Bayes ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlore.llm.common import _LOWER, in_chunks, located, mixed, span_hashes, text_bytes, words_of
from orderlore.sources.tables import materialise

BITS = 18  # n-grams are hashed to 2 ** BITS indicators
PER_CLASS = 5_000  # labelled rows of each class that weights are fitted on, at most
COUNTED = 100_000  # labelled rows of each class that indicators are counted in, at most; their places are broadcast
CHUNK = 1 << 20  # bytes of text that a task hashes at once
COST = 0.1  # upper bound of a row's dual weight
MOST_INDICATORS = 32_000_000  # indicators of the sample, at most: 128 MB
PART = 4_000_000  # of which about so many are fetched at a time
PASSES = 12  # passes of the dual ascent over its rows
KEEP = 0.7  # least score of good quality


# --- features ---------------------------------------------------------------------------

def _counted(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def shapes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A number for how each word looks: case, digits, symbols, last sign, length, whether it repeats the one before."""
    upper = _counted((data >= 65) & (data <= 90), starts, ends)
    lower = _counted(((data >= 97) & (data <= 122)) | (data >= 128), starts, ends)
    digit = _counted((data >= 48) & (data <= 57), starts, ends)
    length = ends - starts
    other = length - upper - lower - digit
    last = np.zeros(256, np.int64)
    last[np.frombuffer(b".,!?;:", np.uint8)] = [1, 2, 3, 4, 5, 5]
    last[np.frombuffer(b"#*$%&|<>=_~^@+/\\", np.uint8)] = 6
    case = np.where(upper == 0, 0, np.where(lower == 0, 3, np.where((data[starts] >= 65) & (data[starts] <= 90), 1, 2)))
    same = np.zeros(len(words), np.int64)
    same[1:] = words[1:] == words[:-1]
    shape = case
    for part, size in (
        (np.minimum(digit, 1), 2), (np.minimum(other, 3), 4), (last[data[ends - 1]], 7),
        (np.searchsorted([4, 8, 13, 30], length), 5), (same, 2),
    ):
        shape = shape * size + part
    return shape.astype(np.uint64)


def _salted(values: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(values * np.uint64(31) + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int32)


def indicators(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The hashed n-grams that each text has: four bytes; one and two words; one to three word shapes."""
    n = len(data)
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    grams = wide[:n] | wide[1 : n + 1] << np.uint32(8) | wide[2 : n + 2] << np.uint32(16) | wide[3:] << np.uint32(24)
    grams = ((grams * np.uint32(0x9E3779B1)) ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BITS)
    grams = grams.astype(np.int32)
    starts, ends, at = words_of(data, offsets)
    lowered = span_hashes(_LOWER[data], starts, ends)
    shapes = shapes_of(data, starts, ends, lowered)
    two = lambda x: x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:]
    kinds = [(1, lowered, 1), (2, two(lowered), 2), (3, shapes, 1), (4, two(shapes), 2), (5, two(two(shapes)), 3)]
    hashed = [(_salted(x, kind), width) for kind, x, width in kinds]
    there = np.zeros(1 << BITS, bool)
    for i in range(len(offsets) - 1):
        there[grams[offsets[i] : max(offsets[i + 1] - 3, offsets[i])]] = True
        for values, width in hashed:
            there[values[at[i] : max(at[i + 1] - width + 1, at[i])]] = True
        found = np.flatnonzero(there)
        there[found] = False
        yield found


# --- model ------------------------------------------------------------------------------

@dataclass
class QualityModel:
    """weights of the indicators, an offset, and the slope and offset of the logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum()) / max(len(found), 1) ** 0.5 + self.bias

    def score(self, found: np.ndarray) -> float:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30)))


@dataclass
class Rows:
    """The indicators of several texts behind each other, where each text's begin (one more for the end), their labels."""

    found: np.ndarray
    begins: np.ndarray
    labels: np.ndarray

    def __getitem__(self, i: int) -> np.ndarray:
        return self.found[self.begins[i] : self.begins[i + 1]]

    def __len__(self) -> int:
        return len(self.labels)


def log_count_ratios(counts: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Logarithm of how much more frequent each indicator is in class 1 than in class 0, from the texts of each class
    (rows) that have it (columns)."""
    shares = counts + smooth
    shares = shares / shares.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_ascent(rows: Rows, scale: np.ndarray, cost: np.ndarray, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Hinge loss on scaled indicators, one dual weight at a time: (weights of the plain indicators, offset).

    A text's indicators count as ``scale`` over the root of their number. The weights kept are those of the plain
    indicators, so a visit reads them once and a step adds squares of the scale; no scaled copy of the rows is made.
    """
    weights, bias, square = np.zeros(len(scale)), 0.0, scale * scale
    roots = np.sqrt(np.maximum(np.diff(rows.begins), 1))
    norms = np.array([float(square[rows[i]].sum()) for i in range(len(rows))]) / roots**2 + 1.0
    dual = np.zeros(len(rows))
    own, rng = np.flatnonzero(cost > 0), np.random.default_rng(0)
    for _ in range(passes):
        for i in own[rng.permutation(len(own))]:
            sign = 1.0 if rows.labels[i] else -1.0
            found = rows[i]
            slack = sign * (float(weights[found].sum()) / roots[i] + bias) - 1
            moved = min(max(dual[i] - slack / norms[i], 0.0), cost[i])
            if moved != dual[i]:
                step = (moved - dual[i]) * sign
                weights[found] += step / roots[i] * square[found]
                bias += step
                dual[i] = moved
    return weights, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit of labels to margins, by Newton steps with a little shrinkage."""
    slope, shift = 1.0, 0.0
    goal = np.where(labels == 1, 0.995, 0.005)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        error, bend = weight * (p - goal), weight * np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([(error * margins).sum() + 1e-3 * slope, error.sum() + 1e-3 * shift])
        second = np.array([[(bend * margins**2).sum(), (bend * margins).sum()], [(bend * margins).sum(), bend.sum()]])
        step = np.linalg.solve(second + 1e-3 * np.eye(2), gradient)
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in in_chunks(batches, "text", CHUNK):
        rows = [found.astype(np.int32) for found in indicators(*text_bytes(chunk.column("text")))]
        yield pa.RecordBatch.from_arrays(
            [
                *(chunk.column(c) for c in ("label", "place", "turn")),
                pa.array([len(x) for x in rows], pa.int64()),
                pa.array([x.tobytes() for x in rows], pa.binary()),
            ],
            ["label", "place", "turn", "size", "found"],
        )


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that have each indicator, summed up within the task."""
    total = np.zeros((2, 1 << BITS), np.int64)
    for chunk in in_chunks(batches, "text", CHUNK):
        labels = chunk.column("label").to_pylist()
        for found, label in zip(indicators(*text_bytes(chunk.column("text"))), labels, strict=True):
            total[label, found] += 1
    some = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(total[0, some]), pa.array(total[1, some])], ["found", "n0", "n1"]
    )


def class_counts(rows: DataFrame) -> np.ndarray:
    """For each class and indicator the texts of ``rows`` (text, label) that have it, summed up by Spark."""
    counted = rows.select("text", "label").mapInArrow(_class_counts, "found int, n0 long, n1 long")
    got = counted.groupBy("found").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    counts = np.zeros((2, 1 << BITS), np.int64)
    counts[:, got["found"]] = got[["n0", "n1"]].to_numpy().T
    return counts


def remainder(ids: str, of: int) -> Column:
    """CRC-32 of the id as text, modulo ``of``; null stays null."""
    return F.crc32(F.col(ids).cast("string").cast("binary")) % of


@dataclass
class Labelled:
    """counts: how many rows of each class there are. texts: (text, label, place, turn) of those that counts are taken
    from, place a hash of the id and turn the order in the class; sample: the first ones, with doc_id."""

    counts: dict[int, int]
    sample: DataFrame
    texts: DataFrame


def _first_by_hash(placed: DataFrame, label: int, count: int, most: int) -> DataFrame:
    """Of a class the ``most`` rows with the least hashes. What cannot be among them is left out before sorting."""
    rows = placed.where(F.col("label") == label)
    if count > most:
        share = min(1.0, 1.1 * most / count + 10 * most**0.5 / count)
        rows = rows.where(F.col("place") < int(share * (1 << 64)) - (1 << 63)) if share < 1 else rows
    return rows.orderBy("place", "file", "at").limit(most)


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int, counted: int = COUNTED) -> Labelled:
    """The rows of ``docs`` that ``labels`` (doc_id and the label column, 0 or 1) knows: at most ``counted`` of each class,
    and the first ``per_class`` of them as a sample.

    Other labels, null ids and ids that are labelled both 0 and 1 are left out. All rows with a labelled id count. Rows
    are taken in the order of a hash of the id, then of their place in the files. As their number is bounded, their places are
    sent to the documents, whose texts are not shuffled.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"), F.min(label).cast("int").alias("least"))
    known = known.where("label = least").select("doc_id", "label")
    rows, file, at = located(docs.select("doc_id", "text"))
    placed = rows.select("doc_id", F.col(file).alias("file"), F.col(at).alias("at")).join(known, "doc_id")
    placed = placed.withColumn("place", F.xxhash64("doc_id", F.lit("sample"))).select("file", "at", "label", "place")
    placed = materialise(placed, "labelled")
    counts = {r["label"]: r["count"] for r in placed.groupBy("label").count().collect()}
    parts = [_first_by_hash(placed, x, counts.get(x, 0), max(counted, per_class)) for x in (0, 1)]
    turn = F.row_number().over(Window.partitionBy("label").orderBy("place", "file", "at")).alias("turn")
    picked = materialise(parts[0].unionAll(parts[1]).select("file", "at", "label", "place", turn), "picked")
    named = rows.select(F.col(file).alias("file"), F.col(at).alias("at"), "doc_id", "text")
    sent = lambda some: named.join(F.broadcast(some), ["file", "at"]).drop("file", "at")
    return Labelled(counts, sent(picked.where(F.col("turn") <= per_class)), sent(picked).drop("doc_id"))


def _fetched(sample: DataFrame, most: int) -> tuple[Rows, np.ndarray]:
    """The indicators of the sample's rows in their order, as one array, and the rows' places. Of rows with more than
    ``most`` indicators in all, as many of each class as come first and have up to half of them."""
    packed = sample.select("label", "place", "turn", "text").mapInArrow(
        _packed, "label int, place long, turn int, size long, found binary"
    )
    packed = materialise(packed, "indicators")
    sizes = packed.select("label", "place", "turn", "size").toPandas().sort_values(["turn", "label"], ignore_index=True)
    sizes = sizes[sizes.groupby("label")["size"].cumsum() <= most // 2].reset_index(drop=True)
    begins = np.concatenate([[0], np.cumsum(sizes["size"])]).astype(np.int64)
    rows = Rows(np.zeros(begins[-1], np.int32), begins, sizes["label"].to_numpy())
    number = {x: i for i, x in enumerate(zip(sizes["label"], sizes["turn"], strict=True))}
    # rows stream in, a part at a time held by the JVM and a batch by Python, so that the array is the only copy
    some = packed.select("label", "turn", "found").repartition(int(begins[-1] // PART) + 1)
    for label, turn, found in some.toLocalIterator():
        if (label, turn) in number:
            i = number[label, turn]
            rows.found[begins[i] : begins[i + 1]] = np.frombuffer(found, np.int32)
    return rows, sizes["place"].to_numpy()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = PER_CLASS,
    most: int = MOST_INDICATORS,
    counted: int = COUNTED,
) -> QualityModel:
    """Fit on the labelled rows of ``docs``; a quarter of them, by a hash of the id, makes the logistic curve.

    The log count ratios come from at most ``counted`` other rows of each class, by a sum over them in Spark. The linear weights and the curve
    come from at most ``per_class`` rows of each class with at most ``most`` indicators together, the first ones by the
    hash; those of the curve count as often as their class is found among all labelled rows. Without rows of both classes the score is
    the share of class 1, or 0.5. See ``labelled`` for repeated ids, null ids and labels that contradict each other.
    """
    known = labelled(docs, labels, label, per_class, counted)
    counts = known.counts
    if not (counts.get(0) and counts.get(1)):
        share = float(1 in counts) if counts else 0.5
        return QualityModel(np.zeros(1 << BITS), 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    in_curve = F.pmod("place", F.lit(4)) == 3
    rows, places = _fetched(known.sample, most)
    held = places % 4 == 3
    train = ~held if len(set(rows.labels[~held].tolist())) == 2 else np.ones(len(rows), bool)
    curve = held if len(set(rows.labels[held].tolist())) == 2 else np.ones(len(rows), bool)
    scale = log_count_ratios(class_counts(known.texts if train.all() else known.texts.where(~in_curve)))
    size = np.bincount(rows.labels[train], minlength=2)
    cost = np.where(train, COST * (size.sum() / 2 / np.maximum(size, 1))[rows.labels], 0.0)
    weights, bias = dual_ascent(rows, scale, cost)
    model = QualityModel(weights.astype(np.float32), bias, 1.0, 0.0)
    own = rows.labels[curve]
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(curve)])
    n = np.maximum(np.bincount(own, minlength=2), 1)
    weight = np.array([counts[0] / n[0], counts[1] / n[1]])[own]
    model.slope, model.shift = logistic_curve(margins, own, weight / weight.mean())
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Add score (double, 0 to 1, higher for class 1) to the rows of ``docs``; the text alone decides.

    Null text counts as empty and gets the score of a text without indicators. Empty tables stay empty; other
    columns pass through, unless called score, which is replaced.
    """
    docs = docs.drop("score")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "text", CHUNK):
            scores = [model.score(found) for found in indicators(*text_bytes(chunk.column("text")))]
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(scores, pa.float64())], [*names, "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "score double"])
    return docs.mapInArrow(run, schema)
