"""What several operators share: stored intermediates, connected components, hashed words and shingles."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlore.sources.tables import materialise

#: White space of all word rules: space, tab, newline, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``materialise`` for a large step, after which the driver lets go of what the step held, so that Spark
    removes its shuffle files."""
    out = materialise(df, purpose)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


#: Steps of a plan below which each row still is one row of a file.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "Relation"}


def _straight_from_files(docs: DataFrame) -> bool:
    """Whether nothing but projections and filters stands between the rows and their files."""
    step = docs._jdf.queryExecution().analyzed()
    while str(step.getClass().getSimpleName()) in _ROW_BY_ROW:
        below = step.children()
        if below.isEmpty():
            return True
        step = below.head()
    return False


def located(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """Rows with two columns that name each row for good, a file and a place in it, and the names of the columns.

    Rows that come straight from files are named by file and row number. Others are written first: below a join or an
    explode one row of a file can be several rows.
    """
    file, at = fresh(docs, "file"), fresh(docs, "at")
    place = lambda df: df.withColumns(
        {file: F.xxhash64("_metadata.file_path"), at: F.col("_metadata.row_index")}
    )
    if _straight_from_files(docs):
        try:
            return place(docs), file, at
        except AnalysisException:  # files without row numbers
            pass
    return place(materialise(docs, "rows")), file, at


# --- components -------------------------------------------------------------------------

EDGES = 100_000  # edges that a task of ``components`` takes, about


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); component is the smallest node reachable.

    Alternates large and small stars: each round hangs neighbours below the smallest one. Every step is a
    minimum by key and a join with that minimum, so hubs are pre-aggregated and their joins can be split;
    rounds are written to the shared folder. Ends when every node hangs below one that hangs nowhere. Nulls and loops
    link nothing; repeated edges count once. A round takes as many tasks as its edges need, at most the shuffle's
    partitions, since the driver remembers each task of the many rounds.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = materialise(clean, "edges")
    print_before = _fingerprint(current)
    while True:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.coalesce(print_before[0] // EDGES + 1), "large-star")
        print_large = _fingerprint(large)
        # stars stay what they are; a node below two others does too, but hangs twice
        if print_large == print_before and large.select("u").distinct().count() == print_before[0]:
            break
        tasks = print_large[0] // EDGES + 1
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        hung = large.join(low, "u").select(F.inline(ends)).where("u <> v").coalesce(tasks)
        current = materialise(hung.distinct().coalesce(tasks), "small-star")
        print_before = _fingerprint(current)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


# --- text in tasks ----------------------------------------------------------------------

def in_chunks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose values of ``column`` take up to ``most`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind each other, and where each text begins (one more entry for the end); null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2**64."""
    if kind not in _powers or len(_powers[kind]) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), equal for equal bytes, from one prefix sum."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data)), out=total[1:])
    value = (total[ends] - total[starts]) * _power("down", len(data) + 1)[starts]
    return mixed(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def words_of(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the joined texts, and the index of each text's first word (one more at the end).

    ``between`` flags the bytes that are no part of a word.
    """
    filled = ~between[data]
    first, last = filled.copy(), filled.copy()
    first[1:] &= ~filled[:-1]
    last[:-1] &= ~filled[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[inner] = filled[inner]
    last[inner - 1] = filled[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles_of(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text (A-Z lower-cased) and where each text's begin.

    A text with fewer words has one shingle, its whole sequence; one without words has none.
    """
    data = _LOWER[data]
    starts, ends, at = words_of(data, offsets)
    words = span_hashes(data, starts, ends)
    counts = np.diff(at)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    begins = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    inside = np.arange(begins[-1]) - np.repeat(begins[:-1], n)
    where = np.repeat(at[:-1], n) + inside
    short = np.repeat(np.minimum(counts, size), n)
    value = np.zeros(begins[-1], np.uint64)
    for k in range(size):
        there = short > k
        part = words[np.minimum(where + k, max(len(words) - 1, 0))] if len(words) else value
        value = np.where(there, value * np.uint64(_BASE) + part, value)
    return mixed(value + short.astype(np.uint64)), begins


def minwise(values: np.ndarray, begins: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One row per text: for each multiplier the least scrambled value (upper 32 bits); texts without values get the largest."""
    out = np.full((len(begins) - 1, len(multipliers)), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(begins))
    if len(some):
        at = begins[:-1][some]
        for k, m in enumerate(multipliers):
            out[some, k] = np.minimum.reduceat((values ^ (m >> np.uint64(7))) * m, at) >> np.uint64(32)
    return out


def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd factors that stand for as many independent orders of the values."""
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of rows with equal key, from batches that arrive sorted by it; several groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.column(key)[batch.num_rows - 1]
        keys = pc.equal(batch.column(key), last)
        cut = pc.index(keys, True).as_py()
        if cut == 0 and held and held[-1].column(key)[held[-1].num_rows - 1] != last:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)
