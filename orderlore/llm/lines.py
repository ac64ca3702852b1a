"""Removal of lines that nearly repeat another line of the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlore.llm.common import (
    by_group,
    components,
    distinct,
    fresh,
    in_chunks,
    located,
    minwise,
    mixed,
    multipliers,
    stored,
)
from orderlore.sources.tables import materialise

SIZE = 10  # characters of a shingle, white space left out
PERCENT = 75  # least similarity of a link, in hundredths
BANDS, ROWS = 8, 3  # a pair at the least similarity shares no band with probability (1 - 0.75 ** 3) ** 8, 1.3 %
LEAST = 20  # lines of fewer characters repeat by chance and stay
CHUNK = 1 << 18  # bytes of text that a task hashes at once; arrays beyond some MB cost a page fault for each page
SEEN = 200_000  # lines that a task remembers to have had
NODE = 1 << 20  # a bucket of up to so many characters is compared exhaustively
COPIES = 8  # a larger bucket is compared in blocks at once if that takes up to so many copies of a line
FINE_BANDS, FINE_ROWS = 27, 6  # bands of what is larger: a pair at the least similarity shares none with 0.5 %

_FACTORS = multipliers(BANDS * ROWS, 7_310)
_FINE = multipliers(FINE_BANDS * FINE_ROWS, 7_311)
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(128, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def _plain(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all lines without white space and with A-Z lower-cased, where each line begins (one more for
    the end), and each line's text and number within it."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    joints = np.flatnonzero(points == 10)
    sizes = np.array([len(t) for t in texts], np.int64)
    closing = np.cumsum(sizes + 1)[:-1] - 1  # the joints between texts
    keep = ~_SPACES[np.minimum(points, 127)]
    kept = points[keep]
    kept += np.where(kept - np.uint32(65) < 26, np.uint32(32), np.uint32(0))  # smaller ones wrap around
    n_lines = len(joints) + 1
    begins = np.concatenate([[0], np.cumsum(keep)[joints], [len(kept)]])
    first = np.concatenate([[0], np.searchsorted(joints, closing) + 1])
    text = np.repeat(np.arange(len(texts)), np.diff(np.concatenate([first, [n_lines]])))
    return kept, begins, text, np.arange(n_lines) - first[text]


def _rolled(points: np.ndarray) -> np.ndarray:
    """Hashes of the SIZE characters from each place on; the last ones run over the end."""
    h = points.astype(np.uint64)
    h += np.uint64(1)
    out, done, width, power = None, 0, 1, _BASE
    while True:
        if SIZE & width:
            if out is None:
                out = h.copy()
            else:
                out *= np.uint64(power)
                out[: max(0, len(h) - done)] += h[done:]
            done += width
        if done == SIZE:
            break
        ahead = h[width:]
        h = h * np.uint64(power)
        h[: len(ahead)] += ahead
        width, power = 2 * width, power * power % (1 << 64)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(29)
    return out


def _banded(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Per line one number for each band of minwise values."""
    out = np.zeros((len(least), bands), np.uint64)
    for r in range(rows):
        out = (out * np.uint64(_BASE)) ^ least[:, r::rows]
    out = out * np.uint64(_BASE) + np.arange(bands, dtype=np.uint64)
    return out ^ (out >> np.uint64(31))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per line of at least LEAST characters: its place, a key of its characters, the key's first bytes as a number, and
    its bands unless the task remembers to have had them from an equal line."""
    seen: set[bytes] = set()
    for chunk in in_chunks(batches, "text", CHUNK):
        points, begins, text, number = _plain([t or "" for t in chunk.column("text").to_pylist()])
        use = np.flatnonzero(np.diff(begins) >= LEAST)
        if not len(use):
            continue
        held = points.tobytes()
        keys = [xxhash.xxh3_128_digest(held[4 * begins[i] : 4 * begins[i + 1]]) for i in use]
        if len(seen) > SEEN:
            seen.clear()
        new = np.array([k not in seen and seen.add(k) is None for k in keys])
        own = use[new]
        counts = np.diff(begins)[own] - SIZE + 1
        at = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(begins[own] - at[:-1], counts) + np.arange(at[-1])
        least = minwise(_rolled(points)[places], at, _FACTORS).astype(np.uint64)
        ends = np.concatenate([[0], np.cumsum(np.where(new, BANDS, 0))])
        rows = pa.array(text[use])
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("file").take(rows),
                chunk.column("at").take(rows),
                chunk.column("doc_id").take(rows),
                pa.array(number[use], pa.int32()),
                pa.array(keys, pa.binary()),
                pa.array(np.frombuffer(b"".join(keys), ">i8")[::2].astype(np.int64)),
                pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(_banded(least, BANDS, ROWS).view(np.int64).ravel())
                ),
            ],
            ["file", "at", "doc_id", "line", "key", "id", "bands"],
        )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by band and id; each further id of a band is paired with the band's first one, once."""
    band = low = last = None
    for batch in batches:
        bands, ids = batch.column("band").to_numpy(), batch.column("id").to_numpy()
        if not len(bands):
            continue
        new = np.ones(len(bands), bool)
        new[1:] = bands[1:] != bands[:-1]
        new[0] = band is None or bands[0] != band
        first = np.where(new, np.arange(len(bands)), -1)
        first = np.maximum.accumulate(first)
        lows = np.where(first >= 0, ids[first], ids[0] if low is None else low)
        again = ~new
        again[1:] &= ids[1:] == ids[:-1]
        again[0] &= last is not None and ids[0] == last
        band, low, last = bands[-1], lows[-1], ids[-1]
        keep = (lows != ids) & ~again
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (bands, lows, ids)], ["band", "low", "id"])


def _named_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of the lines that are named by number, with their keys."""
    for batch in batches:
        keys, texts = [], []
        for text, named in zip(batch.column("text").to_pylist(), batch.column("named").to_pylist(), strict=True):
            lines = text.split("\n")
            for x in named:
                keys.append(x["key"])
                texts.append(lines[x["line"]])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.string())], ["key", "text"])


def _shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each line, sorted."""
    values, at = _shingled(texts)
    return [distinct(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that are similar enough; lines that occur in several pairs of a batch are shingled once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = [batch.column(c).dictionary_encode() for c in ("text_a", "text_b")]
        sets = [_shingle_sets(s.dictionary.to_pylist()) for s in sides]
        sizes = [np.array([len(x) for x in own])[s.indices.to_numpy()] for s, own in zip(sides, sets, strict=True)]
        small, large = np.minimum(*sizes), np.maximum(*sizes)
        links = 100 * small >= PERCENT * large
        pairs = np.stack([s.indices.to_numpy() for s in sides], axis=1)
        for i in np.flatnonzero(links):
            x, y = sets[0][pairs[i, 0]], sets[1][pairs[i, 1]]
            both = len(x) + len(y) - len(distinct(np.concatenate([x, y])))
            links[i] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))


def _number(key: str):
    """The first eight bytes of a key as a number, for the search of candidates only."""
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long")


def _shingled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all lines behind each other, and where each line's begin (one more for the end)."""
    points, begins, _, _ = _plain(texts)
    counts = np.diff(begins) - SIZE + 1
    at = np.concatenate([[0], np.cumsum(counts)])
    return _rolled(points)[np.repeat(begins[:-1] - at[:-1], counts) + np.arange(at[-1])], at


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line goes to one smaller bucket for each of the finer bands."""
    for chunk in in_chunks(batches, "text", CHUNK):
        least = minwise(*_shingled(chunk.column("text").to_pylist()), _FINE).astype(np.uint64)
        node = mixed(chunk.column("node").to_numpy().view(np.uint64))[:, None]
        child = mixed(node ^ _banded(least, FINE_BANDS, FINE_ROWS)).view(np.int64)
        for k in range(FINE_BANDS):
            others = [chunk.column(c) for c in ("id", "comp", "chars")]
            yield pa.RecordBatch.from_arrays([pa.array(child[:, k].copy()), *others], ["node", "id", "comp", "chars"])


def _joined(texts: list[str], comp: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of similar lines of different components, as few as join what all of them join.

    Each line is compared with the later ones that share shingles with it, until one component is left.
    """
    n, links = len(texts), []
    values, at = _shingled(texts)
    owner = np.repeat(np.arange(n), np.diff(at))
    order = np.lexsort((owner, values))
    values, owner = values[order], owner[order]
    new = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]
    values, owner = values[new], owner[new]
    stop = np.searchsorted(values, values, "right")
    sizes = np.bincount(owner, minlength=n)
    of, ends = np.argsort(owner, kind="stable"), np.cumsum(sizes)
    left = len(np.unique(comp))
    for i in range(n):
        if left == 1:
            break
        own = of[ends[i] - sizes[i] : ends[i]] + 1  # behind the line itself
        lengths = stop[own - 1] - own
        where = np.repeat(own - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        both = np.bincount(owner[where], minlength=n)
        for j in np.flatnonzero((100 * both >= PERCENT * (sizes + sizes[i] - both)) & (comp != comp[i])):
            if comp[j] != comp[i]:
                links.append((i, int(j)))
                comp[comp == comp[j]] = comp[i]
                left -= 1
    return links


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components within each bucket; rows arrive by bucket."""
    for table in by_group(batches, "node"):
        nodes = table["node"].to_numpy()
        cuts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1], True])
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            group = table.slice(begin, end - begin)
            keys = group["key"].to_pylist()
            links = _joined(group["text"].to_pylist(), group["comp"].to_numpy().copy())
            if links:
                ends = [pa.array([keys[x[side]] for x in links], pa.binary()) for side in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, ["a", "b"])


def _mixed_buckets(rows: DataFrame, lines: int) -> DataFrame:
    """Rows of the buckets of at least so many lines that stand in several components, with the bucket's characters;
    of buckets with equal lines one."""
    of = rows.groupBy("node").agg(
        F.count("*").alias("lines"), F.sum("chars").alias("n"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
        F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("members"),
    )
    of = of.where(F.col("lines") >= lines).where("c0 <> c1").groupBy("lines", "members")
    return rows.join(of.agg(F.min(F.struct("node", "n")).alias("x")).select("x.*"), "node")


def _divided(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the large buckets that are compared in blocks with at most COPIES copies of a row, since most of their lines
    stand in one component, and rows of the others."""
    own = large.groupBy("node", "comp").agg(F.sum("chars").cast("double").alias("own"))
    work = own.groupBy("node").agg(F.sum("own").alias("all"), F.sum(F.col("own") * F.col("own")).alias("same"))
    few = (F.col("all") * F.col("all") - F.col("same") <= COPIES * NODE / 2 * F.col("all")).alias("few")
    told = stored(large.join(work.select("node", few), "node"), "line-buckets")
    return told.where("few").drop("few"), told.where("NOT few").drop("few")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Large buckets as pairs of blocks. A component that fills blocks of its own is not compared with itself."""
    half = NODE / 2
    own = rows.groupBy("node", "comp").agg(F.sum("chars").alias("own"))
    solo = own.withColumn("solo", F.col("own") > half)
    rest = solo.groupBy("node").agg(F.sum(F.when(F.col("solo"), 0).otherwise(F.col("own"))).alias("rest"))
    dealt = rows.join(solo, ["node", "comp"]).join(rest, "node")
    block = lambda n: F.pmod(F.xxhash64("id"), F.ceil(F.col(n) / half))
    alone = F.xxhash64("node", "comp", block("own"))
    dealt = dealt.withColumn("block", F.when(F.col("solo"), alone).otherwise(F.xxhash64("node", block("rest"))))
    dealt = dealt.withColumn("filled", F.when(F.col("solo"), F.col("comp")))
    dealt = materialise(dealt.select("node", "id", "comp", "block", "filled"), "line-blocks")
    blocks = dealt.select("node", "block", "filled").distinct()
    pairs = blocks.join(blocks.select("node", F.col("block").alias("block_b"), F.col("filled").alias("filled_b")), "node")
    pairs = pairs.where("block <= block_b AND (filled IS NULL OR filled_b IS NULL OR filled <> filled_b)")
    pair = F.xxhash64("node", "block", "block_b").alias("pair")
    sides = F.explode(F.array_distinct(F.array("block", "block_b"))).alias("block")
    pairs = pairs.select("node", pair, "block", "block_b").select("node", "pair", sides)
    return dealt.join(pairs, ["node", "block"]).select(F.col("pair").alias("node"), "id", "comp")


def _rest(stars: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the components that ``links`` leave within a bucket of bands: buckets of up to NODE characters whole,
    larger ones in blocks if few copies do, else by finer bands, and what these leave large in blocks."""
    comp = components(links).select(_number("node").alias("id"), _number("component").alias("component"))
    named = texts.select("id", "key", "text")
    rows = stars.select("band", "id").unionAll(stars.select("band", F.col("low").alias("id")).distinct())
    rows = rows.join(comp, "id", "left").join(named.select("id", F.length("text").cast("long").alias("chars")), "id")
    rows = rows.select(F.col("band").alias("node"), "id", F.coalesce("component", "id").alias("comp"), "chars")
    rows = stored(_mixed_buckets(rows, 3), "line-buckets")  # the star has compared both lines of a bucket of two
    columns = ["node", "id", "comp"]
    nodes, large = rows.where(F.col("n") <= NODE).select(columns), rows.where(F.col("n") > NODE)
    if not large.isEmpty():
        blocks, large = _divided(large)
        nodes = nodes.unionAll(_in_blocks(blocks).select(columns))
    if not large.isEmpty():
        wide = large.drop("n").join(named.select("id", "text"), "id")
        fine = wide.mapInArrow(_fine, "node long, id long, comp long, chars long").distinct()
        rows = stored(_mixed_buckets(fine, 2), "line-buckets")
        nodes, large = nodes.unionAll(rows.where(F.col("n") <= NODE).select(columns)), rows.where(F.col("n") > NODE)
        if not large.isEmpty():
            nodes = nodes.unionAll(_in_blocks(large).select(columns))
    whole = nodes.join(named, "id").repartition("node").sortWithinPartitions("node")
    return stored(whole.select("node", "comp", "key", "text").mapInArrow(_linked, "a binary, b binary"), "line-links")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """The lines to remove: (file, at, line) of ``docs`` (file, at, doc_id, text).

    Lines are compared without white space and case of A-Z. Equal lines share a key. Of different ones, each
    is first tried with the least one of every band bucket that it falls into; buckets whose lines then still stand in
    several components are compared exhaustively (see ``_rest``). Pairs are confirmed by the exact Jaccard
    similarity of their character shingles, and links are joined to components. Of all lines of a component the
    first stays: smallest doc_id (null last), then line, then row.
    """
    docs = docs.select("file", "at", F.col("doc_id").cast("long"), "text")
    lines = stored(
        docs.mapInArrow(_lines, "file long, at long, doc_id long, line int, key binary, id long, bands array<long>"), "lines"
    )
    banded = lines.select(F.explode("bands").alias("band"), "id")
    # a band's rows pass as a stream of two numbers each; equal lines have been thinned before
    banded = banded.repartition("band").sortWithinPartitions("band", "id")
    stars = stored(banded.mapInArrow(_stars, "band long, low long, id long"), "line-stars")
    pairs = stored(stars.select("low", "id").distinct(), "line-pairs")
    ids = pairs.select("id").union(pairs.select("low")).distinct()
    once = lines.select("file", "at", "line", "key", "id").join(ids, "id")
    once = once.groupBy("key").agg(F.first(F.struct("file", "at", "line", "id")).alias("x"))
    once = materialise(once.select("key", "x.*"), "named-lines")
    named = once.groupBy("file", "at").agg(F.collect_list(F.struct("line", "key")).alias("named"))
    texts = docs.select("file", "at", "text").join(named, ["file", "at"]).select("text", "named")
    texts = texts.mapInArrow(_named_lines, "key binary, text string").withColumn("id", _number("key"))
    texts = stored(texts, "line-texts")  # ids of different lines may be equal: that makes candidates, not links
    side = lambda x, y: texts.select(F.col("id").alias(y), F.col("key").alias(x), F.col("text").alias(f"text_{x}"))
    keyed = pairs.join(side("b", "id"), "id").join(side("a", "low"), "low")
    links = stored(keyed.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a binary, b binary"), "line-links")
    links = links.unionAll(_rest(stars, links, texts))
    joined = components(links).withColumnRenamed("node", "key")
    again = lines.groupBy("key").count().where("count > 1").select("key")
    group = again.join(joined, "key", "full").withColumn("component", F.coalesce("component", "key"))
    group = materialise(group, "line-groups")
    members = lines.select("file", "at", "doc_id", "line", "key").join(group, "key").drop("key")
    members = materialise(members, "repeated")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line", "file", "at")
    first = members.groupBy("component").agg(F.min(order).alias("first"))
    return members.join(first, "component").where(
        ~((F.col("file") == F.col("first.file")) & (F.col("at") == F.col("first.at")) & (F.col("line") == F.col("first.line")))
    ).select("file", "at", "line")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of which nothing goes pass as they are."""
    for batch in batches:
        texts, removed = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        n_removed = pc.fill_null(pc.list_value_length(removed), 0).cast(pa.int64())
        full = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
        n_lines = pc.if_else(full, pc.add(pc.fill_null(pc.count_substring(texts, "\n"), 0).cast(pa.int64()), 1), 0)
        hit = pc.greater(n_removed, 0)
        left = []
        for text, numbers in zip(texts.filter(hit).to_pylist(), removed.filter(hit).to_pylist(), strict=True):
            gone = set(numbers)
            left.append("\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone))
        if left:
            texts = pc.replace_with_mask(texts, hit, pa.array(left, texts.type))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(batch.num_columns - 2)), texts.cast(pa.string()), n_lines, n_removed],
            [*batch.schema.names[:-2], "text", "n_lines", "n_removed"],
        )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any others) with repeated lines cut from the text, and n_lines, n_removed added.

    Of near-equal lines anywhere in the corpus, the same document included, one stays (see ``repeated_lines``);
    lines of fewer than LEAST characters always stay. Null texts stay null, empty ones empty (0 lines);
    a document of which every line is cut keeps an empty text. Repeated rows are documents of their own, so the
    lines of all but one go. Null ids count as the last ones. Empty tables give empty results; other
    columns pass through, unless they are called n_lines or n_removed, which are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    names = docs.columns
    others = [c for c in names if c != "text"]
    rows, file, at = located(docs)
    gone = repeated_lines(rows.select(F.col(file).alias("file"), F.col(at).alias("at"), "doc_id", "text"))
    gone = stored(gone, "cut-lines").groupBy("file", "at").agg(F.collect_list("line").alias("removed"))
    removed = fresh(docs, "removed")
    gone = gone.select(F.col("file").alias(file), F.col("at").alias(at), F.col("removed").alias(removed))
    whole = rows.join(gone, [file, at], "left").select(*others, "text", removed)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "text string", "n_lines long", "n_removed long"])
    return whole.mapInArrow(_cut, schema).select(*names, "n_lines", "n_removed")


def text_digest(text: str = "text"):
    """SHA-256 of the text's UTF-8 bytes; null as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)

