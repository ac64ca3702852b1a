"""A Merkle manifest of a table: aligned builders, logs in postorder, proofs addressed by position."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlore.llm.common import fresh, located, stored
from orderlore.sources.tables import materialise

BITS = 10  # a builder takes 2 ** BITS entries of a tree
DIGEST = 32  # bytes of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  # what a leaf covers
NONE, RIGHT, LEFT = 0, 1, 2  # a step of a proof: no sibling, or where the sibling stands

_BUILT = "tree long, block long, n long, count int, nodes binary, top binary"


# --- trees ------------------------------------------------------------------------------

def digest(*nodes: bytes) -> bytes:
    """SHA-256 of the nodes' digests as lower-case hexadecimal text behind each other."""
    return sha256("".join(x.hex() for x in nodes).encode()).digest()


def width(n: int, level: int) -> int:
    """Nodes of a level above n entries."""
    return -(-n >> level)


def height(n: int) -> int:
    """Levels above n entries until one node remains."""
    return (n - 1).bit_length() if n > 1 else 0


def position(level: int, index: int, n: int) -> int:
    """Where a node of a tree over n entries stands in the log, to which a builder appends each node when its last entry
    has come.

    Before entry m the log holds the whole subtrees of m entries, 2 m less the ones in m's binary form; an entry is
    followed by the nodes that it completes, from the lowest level up. Nodes that the end leaves incomplete come last.
    """
    if (index + 1) << level <= n:
        m = ((index + 1) << level) - 1
        return 2 * m - m.bit_count() + level
    lowest = (n & -n).bit_length()  # the first level with an incomplete node
    return 2 * n - n.bit_count() + level - lowest


def build(entries: Sequence[bytes], levels: int) -> list[bytes]:
    """The log of a tree: all nodes up to ``levels`` above the entries, in the order of their completion."""
    log: list[bytes] = []
    waiting: list[bytes | None] = [None] * (levels + 1)  # the left node of each level whose right one is to come
    for node in entries:
        log.append(node)
        level = 0
        while level < levels and waiting[level] is not None:
            node, waiting[level] = digest(waiting[level], node), None
            level += 1
            log.append(node)
        waiting[level] = node
    last = None  # the incomplete node of the level
    for level in range(levels):
        if waiting[level] is not None or last is not None:
            last = digest(*(x for x in (waiting[level], last) if x is not None))
            log.append(last)
    return log


def steps(nodes: np.ndarray, n: int, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level of a log, from the lowest: what kind of step each entry has there, and its sibling's digest."""
    entries, out = np.arange(n), []
    for level in range(levels):
        index = entries >> level
        sibling = index ^ 1
        there = sibling < width(n, level)
        at = np.array([position(level, i, n) for i in range(width(n, level))])
        kind = np.where(there, np.where(index & 1, LEFT, RIGHT), NONE)
        out.append((kind, nodes[at[np.where(there, sibling, 0)]]))
    return out


def fold(node: bytes, path: Sequence[tuple[int, bytes]]) -> bytes:
    """The top of the tree, from one entry and the steps above it."""
    for kind, sibling in path:
        node = digest(node) if kind == NONE else digest(node, sibling) if kind == RIGHT else digest(sibling, node)
    return node


def _packed(path: Sequence[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([kind]) + sibling for kind, sibling in path)


def _unpacked(path: bytes) -> list[tuple[int, bytes]]:
    size = DIGEST + 1
    return [(path[i], path[i + 1 : i + size]) for i in range(0, len(path), size)]


def _own_steps(nodes: bytes, count: int, levels: int) -> list[list[tuple[int, bytes]]]:
    """The steps of each entry inside its builder."""
    found = steps(np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST), count, levels)
    kinds = [kind.tolist() for kind, _ in found]
    siblings = [sibling.tobytes() for _, sibling in found]
    return [
        [(kinds[k][i], siblings[k][DIGEST * i : DIGEST * (i + 1)]) for k in range(levels)] for i in range(count)
    ]


def _levels(n: int, count: int, bits: int) -> int:
    """Levels that a builder adds: all up to the top of a tree that it holds alone, else ``bits``."""
    return height(count) if n <= 1 << bits else bits


# --- many trees at once -----------------------------------------------------------------

def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add at and n: the place of each row among those of its group (nulls are a group, and first), and their number.

    Rows are sorted over ranges and written; a row's place follows from its row number in the file and the numbers
    of rows that files before have of the group, a small table.
    """
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    written = materialise(spread, "ordered")
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    file, row = fresh(rows, "file"), fresh(rows, "row")
    written = written.withColumns({file: F.struct(part, F.col("_metadata.file_name")), row: F.col("_metadata.row_index")})
    parts = written.groupBy(F.col(group).alias("_own"), F.col(file).alias("_part")).agg(
        F.min(row).alias("_first"), F.count("*").alias("_size")
    )
    along = Window.partitionBy("_own").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_size").over(along), F.lit(0)))
    parts = materialise(parts.withColumn("n", F.sum("_size").over(Window.partitionBy("_own"))), "parts")
    both = written.join(parts, (F.col(file) == F.col("_part")) & F.col(group).eqNullSafe(F.col("_own")))
    place = (F.col("_before") + F.col(row) - F.col("_first")).alias("at")
    return both.select(*rows.columns, place, "n")


def _builder(extra: Sequence[str], bits: int):
    """One builder's row: the log of its entries, and the lists of further columns."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        entries, n = table.column("digest").to_pylist(), table.column("n")[0].as_py()
        log = build(entries, _levels(n, len(entries), bits))
        row = {
            "tree": [key[0].as_py()], "block": [key[1].as_py()], "n": [n], "count": [len(entries)],
            "nodes": [b"".join(log)], "top": [log[-1]],
        }
        kinds = {"tree": pa.int64(), "block": pa.int64(), "n": pa.int64(), "count": pa.int32(), "nodes": pa.binary(), "top": pa.binary()}
        out = [pa.array(v, kinds[k]) for k, v in row.items()]
        for name in extra:
            held = table.column(name).combine_chunks()
            held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
            out.append(pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held))
        return pa.Table.from_arrays(out, [*row, *extra])

    return run


def grow(entries: DataFrame, extra: Sequence[str] = (), bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``entries`` (tree, at, n, digest, the extra columns): the builders' rows, stage by stage, and the top
    of each tree (tree, top).

    A builder takes the entries whose places share all but the lowest ``bits`` bits, and appends nodes to its log as
    they are completed. The tops of its builders are the entries of a larger tree in the next stage.
    """
    stages = []
    kinds = {f.name: f.dataType.simpleString() for f in entries.schema.fields}
    schema = ", ".join([_BUILT, *(f"`{c}` array<{kinds[c]}>" for c in extra)])
    while True:
        dealt = entries.withColumn("block", F.shiftright("at", bits)).groupBy("tree", "block")
        own = list(extra) if not stages else []
        stages.append(stored(dealt.applyInArrow(_builder(own, bits), schema if own else _BUILT), "nodes"))
        more = stages[-1].where(F.col("n") > 1 << bits)
        if more.isEmpty():
            break
        entries = more.select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("n") / (1 << bits)).alias("n"), F.col("top").alias("digest")
        )
    tops = [s.where(F.col("n") <= 1 << bits).select("tree", "top") for s in stages]
    return stages, reduce(DataFrame.unionAll, tops)


def _entry_paths(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _own_steps(row["nodes"], row["count"], _levels(row["n"], row["count"], bits))
                n, first = len(own), row["block"] << bits
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * n, pa.int64()),
                        pa.array(range(first, first + n), pa.int64()),
                        pa.array([_packed(x) + row["above"] for x in own], pa.binary()),
                    ],
                    ["tree", "at", "path"],
                )

    return run


def with_paths(stages: list[DataFrame], tails: DataFrame, bits: int) -> DataFrame:
    """The first stage's builders with ``above``, the steps from a builder's top upward; ``tails`` (tree, path) has those
    above the top of each tree."""
    above = None
    for stage in reversed(stages):
        joined = stage.where(F.col("n") <= 1 << bits).join(tails, "tree").withColumnRenamed("path", "above")
        if above is not None:
            higher = above.select("tree", F.col("at").alias("block"), F.col("path").alias("above"))
            joined = joined.unionByName(stage.where(F.col("n") > 1 << bits).join(higher, ["tree", "block"]))
        if stage is not stages[0]:
            above = materialise(joined.mapInArrow(_entry_paths(bits), "tree long, at long, path binary"), "paths")
    return joined


# --- the manifest -----------------------------------------------------------------------

def leaf(columns: Sequence[Column]) -> Column:
    """SHA-256 of the values one behind the other: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass
class Manifest:
    """trees: (group, tree, n, top) with a number for each group in its order; stages: the builders' logs of all trees,
    the first with the keys and claims of its leaves; upper: the logs of the tree over the groups' tops; root."""

    trees: DataFrame
    stages: list[DataFrame]
    upper: list[DataFrame]
    root: bytes
    bits: int

    def proofs(self) -> DataFrame:
        """Per leaf: key, leaf, claim, subroot (binary), path (steps of one byte for the kind and DIGEST for the sibling),
        folded (the root that claim and path give)."""
        ends = self.trees.sparkSession.createDataFrame([(0, b"")], "tree long, path binary")
        tops = with_paths(self.upper, ends, self.bits).mapInArrow(_entry_paths(self.bits), "tree long, at long, path binary")
        tails = materialise(tops.select(F.col("at").alias("tree"), "path"), "paths")
        rows = with_paths(self.stages, tails, self.bits).join(self.trees.select("tree", F.col("top").alias("subroot")), "tree")
        kind = next(f.dataType.elementType.simpleString() for f in self.stages[0].schema.fields if f.name == "key")
        schema = f"key {kind}, leaf binary, claim binary, subroot binary, path binary, folded binary"
        return rows.mapInArrow(_proven(self.bits), schema)


def _proven(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["nodes", "count", "n", "above", "subroot", "claim"]).to_pylist()):
                n = row["count"]
                levels, above = _levels(row["n"], n, bits), _unpacked(row["above"])
                paths = [[*own, *above] for own in _own_steps(row["nodes"], n, levels)]
                leaves = [row["nodes"][DIGEST * p : DIGEST * (p + 1)] for p in (position(0, k, n) for k in range(n))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key")[i].values,
                        pa.array(leaves, pa.binary()),
                        pa.array(row["claim"], pa.binary()),
                        pa.array([row["subroot"]] * n, pa.binary()),
                        pa.array([_packed(x) for x in paths], pa.binary()),
                        pa.array([fold(c, x) for c, x in zip(row["claim"], paths, strict=True)], pa.binary()),
                    ],
                    ["key", "leaf", "claim", "subroot", "path", "folded"],
                )

    return run


def manifest(
    docs: DataFrame,
    group: str = "lang",
    key: str = "doc_id",
    fields: Sequence[str] = FIELDS,
    claim: Sequence[Column] | None = None,
    bits: int = BITS,
) -> Manifest | None:
    """The tree of trees over the rows of ``docs``: leaves of each group in the order of ``key``, groups in theirs.

    ``claim`` holds the values of ``fields`` that a proof is asked for, by default the rows' own; they change no tree. A
    builder takes 2 ** ``bits`` entries. Rows with equal keys stand in the order of their leaves; a null key comes first,
    and nulls are the first group. Repeated rows are leaves of their own. An empty table has no manifest (None). Other
    columns are ignored.
    """
    rows, file, at = located(docs)
    own = [F.col(c) for c in fields]
    leaves = rows.select(
        F.col(group).alias("part"), F.col(key).alias("key"), F.col(file).alias("file_no"), F.col(at).alias("row_no"),
        leaf(own).alias("digest"), leaf(claim or own).alias("claim"),
    )
    leaves = materialise(leaves, "leaves")
    if leaves.isEmpty():
        return None
    leaves = stored(numbered(leaves, "part", ["key", "digest", "file_no", "row_no"]), "leaves")
    groups = leaves.groupBy("part").agg(F.first("n").alias("size"))
    groups = numbered(groups.select(F.lit(0).cast("long").alias("all"), "part", "size"), "all", ["part"])
    groups = materialise(groups.select("part", "size", F.col("at").alias("tree"), F.col("n").alias("groups")), "groups")
    named = groups.select(F.col("part").alias("own"), "tree")
    entries = leaves.join(named, F.col("part").eqNullSafe(F.col("own"))).select("tree", "at", "n", "digest", "key", "claim")
    stages, tops = grow(entries, ["key", "claim"], bits)
    trees = materialise(groups.join(tops, "tree"), "trees")
    above = trees.select(
        F.lit(0).cast("long").alias("all"), F.col("tree").alias("at"), F.col("groups").alias("n"), F.col("top").alias("digest")
    ).withColumnRenamed("all", "tree")
    upper, top = grow(above, bits=bits)
    return Manifest(trees.select(F.col("part").alias("group"), "tree", "size", "top"), stages, upper, top.first().top, bits)


def verified(docs: DataFrame, claim: Sequence[Column] | None = None, bits: int = BITS) -> DataFrame:
    """Per row of ``docs`` (the FIELDS, any others): doc_id, leaf, subroot, root, proof_sha256 (of the siblings as
    hexadecimal text, from the leaf up), folded_root (what ``claim`` and the siblings give) and verified, whether that is
    the root. All are lower-case hexadecimal text. See ``manifest`` for nulls, ties, repeated rows and empty tables."""
    made = manifest(docs, claim=claim, bits=bits)
    text = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if made is None:
        return docs.sparkSession.createDataFrame([], text)
    root = F.lit(made.root.hex())

    def siblings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = [
                sha256("".join(s.hex() for kind, s in _unpacked(p) if kind != NONE).encode()).hexdigest()
                for p in batch.column("path").to_pylist()
            ]
            columns = [batch.column(c) for c in ("key", "leaf", "subroot", "folded")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(joined, pa.string())], ["key", "leaf", "subroot", "folded", "proof"])

    told = made.proofs().mapInArrow(siblings, "key long, leaf binary, subroot binary, folded binary, proof string")
    hexed = lambda c: F.lower(F.hex(c))
    return told.select(
        F.col("key").alias("doc_id"), hexed("leaf").alias("leaf"), hexed("subroot").alias("subroot"), root.alias("root"),
        F.col("proof").alias("proof_sha256"), hexed("folded").alias("folded_root"), (hexed("folded") == root).alias("verified"),
    )


def tampered(number: str, of: int = 7) -> list[Column]:
    """The FIELDS with 1 added to n_chars where ``of`` divides the CRC-32 of the decimal ``number``; null stays null."""
    hit = F.crc32(F.col(number).cast("string").cast("binary")) % of == 0
    more = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return [more if c == "n_chars" else F.col(c) for c in FIELDS]
