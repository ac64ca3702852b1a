"""Benchmark passages in documents, found by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlore.llm.common import (
    _BASE,
    _LOWER,
    in_chunks,
    located,
    mixed,
    span_hashes,
    stored,
    text_bytes,
    words_of,
)
from orderlore.sources.tables import materialise

WINDOW = 10  # words of an item that a document has to hold in a row
GRAM = 5  # words of a gram; of the grams of each window the least one is its fingerprint
SIEVE_BITS = 24  # documents are sieved by a set of 2 ** SIEVE_BITS bits, however many fingerprints there are
CHUNK = 1 << 20  # bytes of text that a task hashes at once

_BETWEEN = np.ones(256, bool)  # bytes outside of words: all ASCII but digits and letters
_BETWEEN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_ITEMS = "item_id string, size int, key long, digest binary"
_PRINTS = "array<struct<size:int,key:long,first:int,digests:array<binary>>>"


class _Words:
    """The words of several texts: A-Z lower-cased, hashed, and joined by one space for exact digests."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        data = _LOWER[data]
        starts, ends, self.at = words_of(data, offsets, _BETWEEN)
        self.hashes = span_hashes(data, starts, ends)
        sizes = ends - starts
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        joined = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
        inner = np.ones(len(joined), bool)
        inner[self.ends] = False
        joined[inner] = data[~_BETWEEN[data]]
        self.joined = memoryview(joined)

    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def digest(self, first: int, size: int) -> bytes:
        """128 bits of ``size`` words from word ``first`` on."""
        return xxhash.xxh3_128_digest(self.joined[self.starts[first] : self.ends[first + size - 1]])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each window of ``size`` words from a word on: the key of its fingerprint, the word that the fingerprint
        starts at (the last of equal ones), and whether the window lies inside one text.

        The fingerprint is the least hash of the window's grams, so it depends on the window's words alone, and
        neighbouring windows mostly have it in common.
        """
        width = min(GRAM, size)
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
        m = n + size - width
        grams = np.zeros(m, np.uint64)
        for k in range(width):
            grams = grams * np.uint64(_BASE) + self.hashes[k : k + m]
        grams = mixed(grams + np.uint64(size))
        least, where = grams[:n].copy(), np.zeros(n, np.int64)
        for k in range(1, size - width + 1):
            lower = grams[k : k + n] <= least
            least[lower] = grams[k : k + n][lower]
            where[lower] = k
        ends = np.repeat(self.at[1:], self.counts())[:n]
        starts = np.arange(n)
        return mixed(least), starts + where, starts + size <= ends


def _slots(keys: np.ndarray) -> list[np.ndarray]:
    """Two bits of the sieve for each key."""
    return [(keys >> np.uint64(shift)) & np.uint64((1 << SIEVE_BITS) - 1) for shift in (4, 36)]


# --- items ------------------------------------------------------------------------------

def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of each item; one of fewer words is one window."""
    for chunk in in_chunks(batches, "text", CHUNK):
        words, ids = _Words(chunk.column("text")), chunk.column("item_id")
        counts = words.counts()
        sizes = np.minimum(counts, WINDOW)
        for size in sorted(set(sizes[sizes > 0].tolist())):
            keys, _, inside = words.windows(size)
            of = np.repeat(np.arange(len(counts)), counts)[: len(keys)]
            use = np.flatnonzero(inside & (sizes[of] == size))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(of[use])),
                    pa.array(np.full(len(use), size, np.int32)),
                    pa.array(keys[use].view(np.int64)),
                    pa.array([words.digest(i, size) for i in use.tolist()], pa.binary()),
                ],
                ["item_id", "size", "key", "digest"],
            )


def item_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different windows (size, key, digest, items) of ``items`` and the members (items, item_id) of their sets of items.

    ``items`` names the set of items that have a window by its size and two sums of hashes; windows with equal
    sets share it. So a phrase of many items is one window with one name, and the ids of a set stand in one place.
    """
    rows = items.select(F.col("item_id").cast("string"), "text").mapInArrow(_item_windows, _ITEMS).distinct()
    rows = materialise(rows, "item-windows")
    total = lambda salt: F.sum(F.xxhash64("item_id", F.lit(salt)).cast("decimal(20,0)"))
    name = F.concat_ws(":", F.count("*"), total(1), total(2))
    windows = materialise(rows.groupBy("size", "key", "digest").agg(name.alias("items")), "windows")
    first = windows.groupBy("items").agg(F.min(F.struct("size", "key", "digest")).alias("x")).select("items", "x.*")
    return windows, rows.join(first, ["size", "key", "digest"]).select("items", "item_id")


def _sieve(windows: DataFrame) -> np.ndarray:
    """A set of 2 ** SIEVE_BITS bits that holds all fingerprints; as many bits come back at most."""
    slots = [F.shiftrightunsigned("key", shift).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)) for shift in (4, 36)]
    both = windows.select(F.explode(F.array(*slots)).alias("slot"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    held = both.groupBy(F.shiftrightunsigned("slot", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
    words = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    words[held["at"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64)
    return np.unpackbits(words.astype("<i8").view(np.uint8), bitorder="little")


# --- documents --------------------------------------------------------------------------

def _scanner(sizes: list[int], packed: bytes):
    """Per document its number of words and the fingerprints that the sieve lets pass, each with the digests of the
    windows around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
        for chunk in in_chunks(batches, "text", CHUNK):
            words = _Words(chunk.column("text"))
            counts = words.counts()
            found: list[list[dict]] = [[] for _ in counts]
            for size in sizes:
                keys, grams, inside = words.windows(size)
                use = np.flatnonzero(inside)
                new = np.ones(len(use), bool)
                new[1:] = grams[use][1:] != grams[use][:-1]
                begins = np.flatnonzero(new)
                one, two = _slots(keys[use[begins]])
                passed = np.flatnonzero(sieve[one] & sieve[two])
                ends = np.append(begins, len(use))[passed + 1]
                of = np.searchsorted(words.at, use[begins[passed]], "right") - 1
                for doc, a, b in zip(of.tolist(), begins[passed].tolist(), ends.tolist(), strict=True):
                    first = int(use[a])
                    found[doc].append({
                        "size": size, "key": int(keys[first].astype(np.int64)), "first": first - int(words.at[doc]),
                        "digests": [words.digest(i, size) for i in range(first, first + b - a)],
                    })
            kind = pa.list_(pa.struct([
                ("size", pa.int32()), ("key", pa.int64()), ("first", pa.int32()), ("digests", pa.list_(pa.binary()))
            ]))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("file"), chunk.column("at"), pa.array(counts, pa.int64()), pa.array(found, kind)],
                ["file", "at", "n_words", "prints"],
            )

    return run


def _hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``docs`` (file, at, text): (file, at, n_words) of all rows, and (file, at, start, stop, items) of each window
    of an item that a row holds; and the members of the sets of items."""
    windows, members = item_windows(items)
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # 1 to WINDOW
    packed = np.packbits(_sieve(windows)).tobytes()
    scan = docs.select("file", "at", "text").mapInArrow(
        _scanner(sizes, packed), f"file long, at long, n_words long, prints {_PRINTS}"
    )
    scan = stored(scan, "fingerprints")
    prints = scan.select("file", "at", F.explode("prints").alias("x")).select("file", "at", "x.*")
    prints = prints.join(windows.select("key").distinct(), "key", "left_semi")
    around = prints.select("file", "at", "size", "first", F.posexplode("digests").alias("step", "digest"))
    held = around.join(windows.select("size", "digest", "items"), ["size", "digest"])
    start = F.col("first") + F.col("step")
    hits = held.select("file", "at", start.alias("start"), (start + F.col("size")).alias("stop"), "items")
    return scan.select("file", "at", "n_words"), stored(hits, "hits"), members


def _reached(hits: DataFrame) -> DataFrame:
    """Hits with ``reach``, how far the hits before them in the row come."""
    before = Window.partitionBy("file", "at").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    return hits.withColumn("reach", F.coalesce(F.max("stop").over(before), F.lit(-1)))


def passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The longest word ranges of ``docs`` that windows of items cover: all columns of the row but its text, with
    start and stop (words before the range and up to its end)."""
    rows, file, at = located(docs)
    _, hits, _ = _hits(rows.select(F.col(file).alias("file"), F.col(at).alias("at"), "text"), items)
    along = Window.partitionBy("file", "at").orderBy("start", "stop")
    number = F.sum((F.col("start") > F.col("reach")).cast("int")).over(along)
    spans = _reached(hits).withColumn("number", number).groupBy("file", "at", "number")
    spans = spans.agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    spans = spans.select(F.col("file").alias(file), F.col("at").alias(at), "start", "stop")
    return rows.drop("start", "stop", "text").join(spans, [file, at]).drop(file, at)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (text, any others) without the text, with n_words, n_hit, n_items, items_sha256 and contaminated added.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A window is WINDOW words of an item
    (``items``: item_id, text) in a row; an item of fewer words is one window. n_hit counts the words of a row inside
    windows that it holds, n_items the items with such windows, and items_sha256 is that of their ids, sorted as strings
    and joined by commas.

    Of the gram hashes inside each window the least one is kept as its fingerprint, on both sides by the same rule, so a
    shared window always shares its fingerprint. Fingerprints of documents are sieved by a bit set of fixed size (which lets
    all of the items' pass), joined with those of the items, and extended to the windows around them, which are
    confirmed by 128-bit digests of their words. Both joins have one row per key on the items' side.

    Null and empty texts and texts without words have no words and no hits. Null item texts have no windows; rows with
    equal item_id are one item; a null item_id is one item that counts but is not listed. Repeated rows are rows of
    their own. Empty tables give empty results, or no hits. Columns with the names of the added ones are replaced.
    """
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    names = [c for c in docs.columns if c not in (*added, "text")]
    rows, file, at = located(docs.select(*names, "text"))
    scan, hits, members = _hits(rows.select(F.col(file).alias("file"), F.col(at).alias("at"), "text"), items)
    covered = F.greatest(F.col("stop") - F.greatest("start", "reach"), F.lit(0))
    held = _reached(hits).groupBy("file", "at").agg(
        F.sum(covered).alias("n_hit"), F.sort_array(F.collect_set("items")).alias("sets")
    )
    held = materialise(held.withColumn("named", F.sha2(F.concat_ws(",", "sets"), 256)), "hit-rows")
    several = held.groupBy("named").agg(F.first("sets").alias("sets"))  # rows with equal sets share the list of ids
    listed = several.select("named", F.explode("sets").alias("items")).join(members, "items")
    listed = listed.select("named", "item_id").distinct().groupBy("named").agg(
        F.count("*").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("item_id"))), 256).alias("items_sha256"),
    )
    found = scan.join(held.select("file", "at", "n_hit", "named").join(listed, "named"), ["file", "at"], "left")
    hit = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    found = found.select(
        F.col("file").alias(file), F.col("at").alias(at), "n_words", hit("n_hit").alias("n_hit"),
        hit("n_items").alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (hit("n_hit") > 0).alias("contaminated"),
    )
    return rows.select(*names, file, at).join(found, [file, at]).select(*names, *added)


def without_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with their columns as they are."""
    rows, file, at = located(docs)
    _, hits, _ = _hits(rows.select(F.col(file).alias("file"), F.col(at).alias("at"), "text"), items)
    bad = hits.select(F.col("file").alias(file), F.col("at").alias(at)).distinct()
    return rows.join(bad, [file, at], "left_anti").select(*docs.columns)
