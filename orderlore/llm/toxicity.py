"""Toxicity of texts by boosted trees on a few dense measures, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlore.llm.common import _LOWER, in_chunks, span_hashes, text_bytes, words_of
from orderlore.llm.quality import _counted, labelled
from orderlore.sources.tables import materialise

PER_CLASS = 5_000  # labelled rows of each class that a model is fitted on, at most
TREES, TREE_DEPTH, RATE = 20, 4, 0.3
CHUNK = 1 << 20  # bytes of text that a task measures at once
STEMS = (0, 4, 5, 6)  # whole words, and the first bytes of longer ones
LEAST_DOCUMENTS, LEAST_ODDS = 3, 3.0  # toxic documents that have an entry of the lexicon, and its log odds ratio
NEAR = 5  # words between an entry of the lexicon and a second person
TOXIC = 0.5  # least score of a toxic text

#: Words of address in the languages of the corpus.
SECOND_PERSON = [
    "you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "deinen", "ihr", "euch", "euer", "sie",
    "ihnen", "ihre", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes",
    "vosotros", "tus", "su", "sus",
]

#: Insults that hold without any labels.
INSULTS = [
    "idiot", "idiots", "idiotic", "moron", "morons", "stupid", "scum", "trash", "loser", "losers", "pathetic",
    "worthless", "disgusting", "clown", "dumb", "jerk", "idiota", "estúpido", "estúpida", "imbécil", "basura",
    "asqueroso", "connard", "stupide", "débile", "ordure", "blödmann", "dumm", "dummkopf", "abschaum", "trottel",
    "widerlich",
]

MEASURES = (
    *(f"{kind}_{i}" for i in range(len(STEMS)) for kind in ("density", "hits")),
    "near_share", "near_hits", "capitals", "capital_words", "marks", "punctuation", "obfuscated", "size",
)


def _hashes(words: list[str]) -> np.ndarray:
    joined = b" ".join(w.encode() for w in words)
    data = np.frombuffer(joined, np.uint8)
    starts, ends, _ = words_of(data, np.array([0, len(data)]))
    return np.sort(span_hashes(data, starts, ends))


_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class _Text:
    """The words of joined texts, without signs around them, as hashes of the whole and of their beginnings."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        starts, ends, self.at = words_of(data, offsets)
        self.outer = starts, ends
        starts, ends = starts.copy(), ends.copy()
        for _ in range(4):
            ends -= _PUNCTUATION[data[ends - 1]] & (ends - starts > 1)
            starts += _PUNCTUATION[data[starts]] & (ends - starts > 1)
        self.starts, self.ends = starts, ends
        lowered = _LOWER[data]
        self.keys = [
            span_hashes(lowered, starts, ends if not n else np.minimum(ends, starts + n)) for n in STEMS
        ]
        self.long = [ends - starts > n for n in STEMS]


@dataclass
class Lexicon:
    """Sorted hashes of the entries of each kind: whole words, then beginnings."""

    entries: list[np.ndarray]

    def hits(self, text: _Text) -> list[np.ndarray]:
        out = []
        for keys, long, own in zip(text.keys, text.long, self.entries, strict=True):
            if len(own):
                out.append(long & (own[np.minimum(np.searchsorted(own, keys), len(own) - 1)] == keys))
            else:
                out.append(np.zeros(len(keys), bool))
        return out


_SECOND = _hashes(SECOND_PERSON)


def measures(text: _Text, lexicon: Lexicon) -> np.ndarray:
    """One row of MEASURES per text."""
    data, offsets, at = text.data, text.offsets, text.at
    begin, end = at[:-1], at[1:]
    per_text = lambda flags: _counted(flags, begin, end)
    n, size = np.maximum(end - begin, 1), np.maximum(np.diff(offsets), 1)
    hits = lexicon.hits(text)
    columns = []
    for h in hits:
        found = per_text(h)
        columns += [found / n, np.log1p(found)]
    either = hits[0].copy()
    for h in hits[1:]:
        either |= h
    whole = text.keys[0]
    second = _SECOND[np.minimum(np.searchsorted(_SECOND, whole), len(_SECOND) - 1)] == whole
    total = np.concatenate([[0], np.cumsum(second)])
    here, of = np.arange(len(whole)), np.repeat(np.arange(len(n)), end - begin)
    low, high = np.maximum(here - NEAR, begin[of]), np.minimum(here + NEAR + 1, end[of])
    near = per_text(either & (total[high] > total[low]))
    upper = (data >= 65) & (data <= 90)
    letters = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    bytes_of = lambda flags: _counted(flags, offsets[:-1], offsets[1:])
    inside = lambda flags: _counted(flags, text.starts, text.ends)
    length = text.ends - text.starts
    signs = inside(_PUNCTUATION[data] | ((data >= 48) & (data <= 57)))
    odd = (signs > 0) & (inside(letters) > signs)
    columns += [
        near / np.maximum(per_text(either), 1), np.log1p(near), bytes_of(upper) / np.maximum(bytes_of(letters), 1),
        per_text((inside(upper) == length) & (length > 1)) / n, bytes_of((data == 33) | (data == 63)) / size,
        bytes_of(_PUNCTUATION[data]) / size, per_text(odd) / n, np.log1p(end - begin),
    ]
    return np.stack(columns, axis=1)


# --- lexicon ----------------------------------------------------------------------------

def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label and half that have each entry, summed up within a chunk."""
    for chunk in in_chunks(batches, "text", CHUNK):
        text = _Text(*text_bytes(chunk.column("text")))
        of = np.repeat(np.arange(chunk.num_rows), np.diff(text.at))
        label, half = (chunk.column(c).to_numpy() for c in ("label", "half"))
        for kind, (keys, long) in enumerate(zip(text.keys, text.long, strict=True)):
            pairs = np.unique(np.stack([keys[long], of[long].astype(np.uint64)]), axis=1)
            group = (label * 2 + half)[pairs[1].astype(np.int64)]
            found, index = np.unique(pairs[0], return_inverse=True)
            counts = [np.bincount(index, group == g, len(found)).astype(np.int64) for g in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), kind, np.int32)), pa.array(found.view(np.int64)), *map(pa.array, counts)],
                ["kind", "entry", "n00", "n01", "n10", "n11"],
            )


def learn_lexicons(sample: DataFrame) -> list[Lexicon]:
    """Lexicons of the sample's first half, its second half and the whole.

    An entry is a word, or the beginning of words, that at least LEAST_DOCUMENTS toxic documents have and whose log
    odds ratio for toxic documents is at least LEAST_ODDS. Known insults belong to each.
    """
    sizes = sample.groupBy("label", "half").count().collect()
    size = {(r["label"], r["half"]): r["count"] for r in sizes}
    schema = "kind int, entry long, n00 long, n01 long, n10 long, n11 long"
    counted = sample.select("label", "half", "text").mapInArrow(_entries, schema)
    counted = counted.groupBy("kind", "entry").agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")])
    parts = ((0,), (1,), (0, 1))

    def may_enter(halves: tuple[int, ...]) -> Column:
        clean, toxic = (sum((F.col(f"n{x}{h}") for h in halves), F.lit(0)) for x in (0, 1))
        n = [sum(size.get((x, h), 0) for h in halves) + 1 for x in (0, 1)]
        odds = F.log((toxic + 0.5) / n[1]) - F.log((clean + 0.5) / n[0])
        return (toxic >= LEAST_DOCUMENTS) & (odds >= LEAST_ODDS - 1e-9)  # told exactly below

    got = counted.where(may_enter(parts[0]) | may_enter(parts[1]) | may_enter(parts[2])).toPandas()
    base = _hashes(INSULTS)
    lexicons = []
    for halves in parts:
        clean, toxic = (sum(got[f"n{x}{h}"] for h in halves).to_numpy(np.float64) for x in (0, 1))
        n = [sum(size.get((x, h), 0) for h in halves) + 1 for x in (0, 1)]
        odds = np.log((toxic + 0.5) / n[1]) - np.log((clean + 0.5) / n[0])
        use = (toxic >= LEAST_DOCUMENTS) & (odds >= LEAST_ODDS)
        entries = []
        for kind in range(len(STEMS)):
            own = got["entry"].to_numpy(np.int64)[use & (got["kind"].to_numpy() == kind)].view(np.uint64)
            entries.append(np.unique(np.concatenate([own, base if kind == 0 else base[:0]])))
        lexicons.append(Lexicon(entries))
    return lexicons


def measured(docs: DataFrame, lexicons: list[Lexicon]) -> DataFrame:
    """Add the MEASURES to the rows of ``docs``. With three lexicons, a row of half 0 or 1 gets that learned from the
    other half, so that no row is measured with entries that it has taught."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "text", CHUNK):
            text = _Text(*text_bytes(chunk.column("text")))
            if len(lexicons) == 1:
                rows = measures(text, lexicons[0])
            else:
                half = chunk.column("half").to_numpy()[:, None]
                rows = np.where(half == 0, measures(text, lexicons[1]), measures(text, lexicons[0]))
            kept = [chunk.column(c) for c in names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(c) for c in rows.T.astype(np.float64))], [c for c in names if c != "text"] + [*MEASURES]
            )

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    own = [f"`{c}` {kinds[c]}" for c in names if c != "text"]
    return docs.mapInArrow(run, ", ".join([*own, *(f"{m} double" for m in MEASURES)]))


# --- model ------------------------------------------------------------------------------

@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    constant: float = 0.0



def _raw(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    scored = trees.transform(VectorAssembler(inputCols=[*MEASURES], outputCol="features").transform(rows))
    return scored.withColumn("raw", vector_to_array("probability")[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled documents of each class.

    Lexicons are learned from halves of the sample and measured on the other half; three quarters of the rows
    train the trees, the last quarter the isotonic curve, in which rows count as often as their class is found among all
    labelled rows. Without rows of both classes the score is constant.
    """
    known = labelled(docs, labels, label, per_class, per_class)
    counts = known.counts
    sample = materialise(known.sample.withColumn("half", F.pmod("place", F.lit(2)).cast("int")), "sample")
    if not (counts.get(0) and counts.get(1)):
        return ToxicityModel(Lexicon([_hashes(INSULTS), *[np.zeros(0, np.uint64)] * 3]), None, None, float(1 in counts))
    lexicons = learn_lexicons(sample)
    rows = materialise(measured(sample.select("label", "place", "half", "text"), lexicons).coalesce(2), "measured")
    part = F.pmod(F.shiftright("place", 1), F.lit(4))
    vectors = VectorAssembler(inputCols=[*MEASURES], outputCol="features")
    boosted = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=RATE, seed=0
    )
    trees = boosted.fit(vectors.transform(rows.where(part != 3)).select("features", F.col("label").cast("double")))
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    weight = F.when(F.col("label") == 1, counts[1] / n[1]).otherwise(counts[0] / n[0])
    held = _raw(rows.where(part == 3), trees).select("raw", F.col("label").cast("double"), weight.alias("weight"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight")
    known = {r["label"] for r in held.select("label").distinct().collect()}
    return ToxicityModel(lexicons[2], trees, curve.fit(held) if len(known) == 2 else None)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (double, 0 to 1, higher for toxic) of each row of ``docs`` (doc_id, text); the text alone decides.

    Null text counts as empty; empty and wordless texts have the measures of no word. Null ids and repeated rows stay.
    Empty tables give empty results; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    if model.trees is None:
        return docs.select("doc_id", F.lit(model.constant).alias("score"))
    rows = _raw(measured(docs, [model.lexicon]), model.trees)
    if model.curve is None:
        return rows.select("doc_id", F.col("raw").alias("score"))
    rows = model.curve.setPredictionCol("calibrated").transform(rows.select("doc_id", "raw"))
    return rows.select("doc_id", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)).alias("score"))
