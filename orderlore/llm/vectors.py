"""Near-duplicate vectors by a tiled comparison in the order of principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlore.llm.common import components
from orderlore.sources.tables import materialise

COSINE = 0.98  # least cosine of a link
TILE = 512  # classes of a tile, about
SLOTS = 256  # steps of the next component by which a cell is cut into tiles
STEP = 16  # dimensions that are added at a time
LEADING = 2  # components that make up the cells
UNSURE = 1e-9  # nearer to the threshold than this, cosines are taken from the vectors themselves


def _matrix(column) -> np.ndarray:
    """Vectors of equal length from their stored bytes."""
    return np.stack([np.frombuffer(x, np.float64) for x in column])


def scaled(vectors: DataFrame, vec: str, label: str) -> DataFrame:
    """(vec_id, label, unit) of all rows; unit holds the bytes of the vector scaled to length 1.

    It is null where nothing links: null labels, null, empty and zero vectors, null or non-finite components.
    """

    def unit(label: object, value: object) -> bytes | None:
        if label is None or value is None or not len(value) or any(x is None for x in value):
            return None
        v = np.asarray(value, np.float64)
        if not np.isfinite(v).all() or not v.any():
            return None
        v = v / np.abs(v).max()  # no square over- or underflows
        return (v / np.sqrt(v @ v)).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            labels, values = rows.column("label").to_pylist(), rows.column("vector").to_pylist()
            units = [unit(x, v) for x, v in zip(labels, values, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), pa.array(units, pa.binary())], ["vec_id", "label", "unit"]
            )

    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col(label).cast("string").alias("label"),
        F.col(vec).cast("array<double>").alias("vector"),
    )
    return rows.mapInArrow(run, "vec_id long, label string, unit binary")


def principal_axes(units: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the principal axes as columns, by falling variance, from the sums over all vectors.

    A task sums the products of its vectors; equal places are summed by Spark, so one square matrix comes back.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for size, part in rows.groupby(rows["unit"].str.len() // 8):
                x = np.hstack([np.ones((len(part), 1)), _matrix(part["unit"])])
                sums[size] = sums.get(size, 0) + x.T @ x
        for size, m in sums.items():
            i, j = np.indices(m.shape)
            yield pd.DataFrame({"size": size, "i": i.ravel(), "j": j.ravel(), "value": m.ravel()})

    schema = "size int, i int, j int, value double"
    got = units.select("unit").mapInPandas(run, schema).groupBy("size", "i", "j").agg(F.sum("value").alias("value"))
    axes = {}
    for size, part in got.toPandas().groupby("size"):
        m = np.zeros((size + 1, size + 1))
        m[part["i"], part["j"]] = part["value"]
        mean = m[0, 1:] / m[0, 0]
        axes[int(size)] = np.linalg.eigh(m[1:, 1:] / m[0, 0] - np.outer(mean, mean))[1][:, ::-1].copy()
    return axes


def _turned(classes: DataFrame, axes: dict[int, np.ndarray], width: float) -> DataFrame:
    """Classes with their coordinates on the axes, the cell of the leading ones and a slot of the next one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for size, part in rows.groupby(rows["unit"].str.len() // 8):
                turned = _matrix(part["unit"]) @ axes[size]
                cell = np.floor(turned[:, :LEADING] / width).astype(np.int32)
                yield part.assign(
                    size=np.int32(size), turned=[x.tobytes() for x in turned], cell=[x.tolist() for x in cell],
                    slot=np.floor(turned[:, min(LEADING, size - 1)] * SLOTS).astype(np.int32),
                )

    schema = "rid long, n long, label string, unit binary, size int, turned binary, cell array<int>, slot int"
    return classes.select("rid", "n", "label", "unit").mapInPandas(run, schema)


def _tiles(turned: DataFrame) -> DataFrame:
    """Add tile: up to about TILE classes of a cell that follow each other in the next component.

    Slots are counted first; slots are filled into tiles in their order, and a slot of more than TILE classes is split
    by a hash.
    """
    cell = ["label", "size", "cell"]
    slots = turned.groupBy(*cell, "slot").agg(F.count("*").alias("m"))
    before = Window.partitionBy(*cell).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("run", F.floor(F.coalesce(F.sum("m").over(before), F.lit(0)) / TILE))
    part = F.pmod(F.xxhash64("rid"), F.ceil(F.col("m") / TILE))
    own = F.when(F.col("m") > TILE, F.xxhash64(*cell, "slot", part)).otherwise(F.xxhash64(*cell, "run"))
    return turned.join(slots, [*cell, "slot"]).withColumn("tile", own).drop("slot", "m", "run")


def _boxes(tiles: DataFrame) -> DataFrame:
    """The bounding box of each tile along all axes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(rows["turned"])
        first = rows.iloc[:1]
        return first[["tile", "label", "size", "cell"]].assign(low=[x.min(axis=0)], high=[x.max(axis=0)])

    schema = "tile long, label string, size int, cell array<int>, low array<double>, high array<double>"
    return tiles.select("tile", "label", "size", "cell", "turned").groupBy("tile").applyInPandas(run, schema)


def _near_tiles(boxes: DataFrame, width: float) -> DataFrame:
    """Pairs (a, b) of tiles, a <= b, in neighbouring cells, whose boxes are at most ``width`` apart."""
    steps = [[]]
    for _ in range(LEADING):
        steps = [[*s, d] for s in steps for d in (-1, 0, 1)]
    around = F.array(*[F.array(*[F.lit(d) for d in s]) for s in steps])
    near = boxes.withColumn("step", F.explode(around))
    near = near.withColumn("cell", F.zip_with("cell", F.slice("step", 1, F.size("cell")), lambda c, d: c + d))
    near = near.select("label", "size", "cell", F.col("tile").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"))
    pairs = near.join(boxes.withColumnRenamed("tile", "b"), ["label", "size", "cell"]).where("a <= b")
    gap = F.zip_with(
        F.zip_with("la", "high", lambda x, y: x - y), F.zip_with("low", "ha", lambda x, y: x - y),
        lambda p, q: F.greatest(p, q, F.lit(0.0)),
    )
    apart = F.aggregate(gap, F.lit(0.0), lambda total, g: total + g * g)
    return pairs.where(apart <= width * width + 1e-9).select("a", "b").distinct()


def _compare(a: pd.DataFrame, b: pd.DataFrame, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the linked pairs of two tiles.

    Products of the leading dimensions are summed up STEP by STEP; after each step a pair stays only if its sum plus the
    product of both suffix norms, the most that the rest can add, reaches the threshold.
    """
    x, y = _matrix(a["turned"]), _matrix(b["turned"])
    tails = [np.sqrt(np.maximum(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1], 0)) for m in (x, y)]
    size = x.shape[1]
    first = min(STEP, size)
    partial = x[:, :first] @ y[:, :first].T
    rest = np.outer(tails[0][:, first], tails[1][:, first]) if first < size else 0.0
    i, j = np.nonzero(partial + rest >= cosine - UNSURE)
    value = partial[i, j]
    for start in range(first, size, STEP):
        stop = min(start + STEP, size)
        value = value + np.einsum("ij,ij->i", x[i, start:stop], y[j, start:stop])
        rest = tails[0][i, stop] * tails[1][j, stop] if stop < size else 0.0
        stay = value + rest >= cosine - UNSURE
        i, j, value = i[stay], j[stay], value[stay]
    unsure = np.flatnonzero(np.abs(value - cosine) <= UNSURE)
    if len(unsure):
        u, v = _matrix(a["unit"].iloc[i[unsure]]), _matrix(b["unit"].iloc[j[unsure]])
        value[unsure] = np.einsum("ij,ij->i", u, v)
    linked = value >= cosine
    return i[linked], j[linked]


def _links(cosine: float):
    """Per pair of tiles the links of each class, and edges that join those which are linked within the pair."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["side"].to_numpy() == 0
        a = rows[own]
        same = not (~own).any()
        b = a if same else rows[~own]
        i, j = _compare(a, b, cosine)
        if same:
            i, j = i[i != j], j[i != j]
        ra, rb = a["rid"].to_numpy(), b["rid"].to_numpy()
        na, nb = a["n"].to_numpy(), b["n"].to_numpy()
        count_a = np.bincount(i, nb[j], len(a)).astype(np.int64)
        parts = [pd.DataFrame({"rid": ra, "links": count_a, "b": np.int64(-1)})]
        if not same:
            parts.append(pd.DataFrame({"rid": rb, "links": np.bincount(j, na[i], len(b)).astype(np.int64), "b": np.int64(-1)}))
        for k, m in _forest(ra[i], rb[j]):
            parts.append(pd.DataFrame({"rid": [k], "links": [0], "b": [m]}))
        out = pd.concat(parts)
        return out[(out["links"] > 0) | (out["b"] >= 0)]

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Fewest of the edges that join what all of them join."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def near_vectors(vectors: DataFrame, vec: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """Links and components of the rows of ``vectors`` (vec_id long, vector, label) by cosine within equal labels.

    Equal vectors of a label are one class, counted but not compared. Classes are turned to principal axes, dealt to
    cells of the leading components that are as wide as two linked vectors can be apart, and cut into tiles in
    the order of the next component. Only tiles of neighbouring cells whose bounding boxes are near enough are
    compared; links within a pair of tiles leave as counts and as the edges of a spanning forest, never as all pairs.

    Returns per row: vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable, itself
    included), kept (vec_id = component_id). Null, empty and zero vectors, those with null or non-finite components, and
    null labels link with nothing; vectors of different length neither. Null ids link but never name a component;
    without any id component_id is null and its rows are kept. Rows that repeat an id are rows of their own. Empty tables give empty results; other columns are ignored.
    """
    units = materialise(scaled(vectors, vec, label), "units")
    classes = units.where("unit is not null").groupBy("label", "unit")
    classes = classes.agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
    classes = materialise(classes.withColumn("rid", F.monotonically_increasing_id()), "classes")
    width = (2 - 2 * cosine) ** 0.5
    turned = materialise(_turned(classes, principal_axes(classes), width + 1e-6), "turned")
    tiles = materialise(_tiles(turned).select("rid", "n", "label", "size", "cell", "unit", "turned", "tile"), "tiles")
    pairs = materialise(_near_tiles(materialise(_boxes(tiles), "boxes"), width), "tile-pairs")
    rows = tiles.select("rid", "n", "unit", "turned", "tile")
    left = pairs.select("a", "b", F.col("a").alias("tile"), F.lit(0).alias("side")).join(rows, "tile")
    right = pairs.where("a <> b").select("a", "b", F.col("b").alias("tile"), F.lit(1).alias("side")).join(rows, "tile")
    both = left.unionAll(right).select("a", "b", "side", "rid", "n", "unit", "turned")
    found = both.groupBy("a", "b").applyInPandas(_links(cosine), "rid long, links long, b long")
    found = materialise(found, "vector-links")
    linked = found.groupBy("rid").agg(F.sum("links").alias("links"))
    comp = components(found.where("b >= 0").select(F.col("rid").alias("a"), "b")).withColumnRenamed("node", "rid")
    labelled = classes.join(comp, "rid", "left").join(linked, "rid", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "rid"))
    labelled = materialise(labelled.select("label", "unit", "n", "low", "component", "links"), "labels")
    lowest = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    links = (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    named = labelled.join(lowest, "component").select("label", "unit", "component_id", links)
    known = units.where("unit is not null").join(named, ["label", "unit"]).select("vec_id", "n_links", "component_id")
    alone = units.where("unit is null").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    whole = known.unionAll(alone)
    return whole.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
