"""Quality and toxicity against plain versions of their counts, weights and measures; odd and long labelled rows."""

import random
import re
import tracemalloc
from collections import Counter

import helpers
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlore.llm import quality, toxicity
from orderlore.llm.common import text_bytes
from orderlore.sources.tables import materialise

DOCS = "doc_id long, text string"


def indicators(text):
    (found,) = quality.indicators(*text_bytes(pa.array([text])))
    return found


def plain_grams(text):
    """Four-byte strings and lower-cased words and pairs of words of a text."""
    data, words = text.encode(), helpers.WORD.findall(helpers.lower(text))
    return {data[k : k + 4] for k in range(len(data) - 3)}, set(words), set(zip(words, words[1:], strict=False))


def test_indicators_are_those_of_the_grams():
    """Equal sets of grams and shapes give equal indicators; each gram adds at most one; another gram changes them."""
    rng = random.Random(2)
    for _ in range(20):
        text = helpers.text(rng, 3)
        found = indicators(text)
        assert len(set(found.tolist())) == len(found) and found.max() < 1 << quality.BITS
        grams = plain_grams(text)
        # word shapes: one to three in a row, so at most three for each word
        assert len(found) <= sum(map(len, grams)) + 3 * len(helpers.WORD.findall(text))
        assert set(found) < set(indicators(text + " Neu-9!"))
    assert len(indicators("")) == 0 and len(indicators(None)) == 0


def test_class_counts_and_ratios(spark):
    rng = random.Random(3)
    rows = [(helpers.text(rng, 2), i % 3 // 2) for i in range(40)] + [(None, 0), ("", 1), ("x" * 9, 1)]
    counts = quality.class_counts(spark.createDataFrame(rows, "text string, label int").repartition(5))
    want = Counter((label, int(i)) for text, label in rows for i in indicators(text))
    assert {(k, i): int(counts[k, i]) for k, i in zip(*np.nonzero(counts), strict=True)} == dict(want)
    ratios = quality.log_count_ratios(counts)
    total = [sum(counts[k].tolist()) + counts.shape[1] for k in (0, 1)]
    for i in list({i for _, i in want})[:50]:
        share = [(want[k, i] + 1) / total[k] for k in (0, 1)]
        assert ratios[i] == pytest.approx(np.log(share[1] / share[0]))


def test_dual_solution_is_optimal():
    """The duality gap of the hinge loss closes, and the weights are the sum of the rows by their dual weights."""
    rng = np.random.default_rng(5)
    found = [np.sort(rng.choice(60, rng.integers(3, 12), replace=False)).astype(np.int32) for _ in range(80)]
    labels = np.array([int((f < 25).mean() + 0.3 * rng.standard_normal() > 0.4) for f in found])
    begins = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    rows = quality.Rows(np.concatenate(found), begins, labels)
    scale, cost = rng.standard_normal(60), np.full(80, 0.3)
    weights, bias = quality.dual_ascent(rows, scale, cost, passes=3000)
    x = np.zeros((80, 61))
    for i, f in enumerate(found):
        x[i, f] = scale[f] / len(f) ** 0.5
    x[:, 60] = 1.0
    sign = 2.0 * labels - 1
    own = np.append(np.divide(weights, scale), bias)  # in the space of scaled indicators
    primal = 0.5 * own @ own + (cost * np.maximum(0, 1 - sign * (x @ own))).sum()
    margin = sign * (x @ own)
    # optimal: no step along any direction of the rows lowers the loss
    for _ in range(200):
        other = own + rng.standard_normal(61) * rng.choice([1e-3, 1e-2, 0.1])
        assert 0.5 * other @ other + (cost * np.maximum(0, 1 - sign * (x @ other))).sum() >= primal - 1e-6
    assert (margin > 1).any() and (margin < 1).any()


def test_sample_is_bounded_with_repeated_and_contradicting_ids(spark):
    docs = [(i % 40, f"text {i}") for i in range(400)] + [(None, "none"), (500, None)]
    labels = [(i, i % 2) for i in range(40)] + [(3, 0), (4, 0), (None, 1), (500, 1), (600, 0), (7, None), (8, 2)]
    docs = materialise(spark.createDataFrame(docs, DOCS).repartition(3), "test")
    labels = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    known = quality.labelled(docs, labels, "quality", 12, 30)
    # id 3 is labelled 1 and 0; ids 7 and 8 keep their valid label
    assert known.counts == {0: 200, 1: 191}
    sample, texts = known.sample.collect(), known.texts.collect()
    assert Counter(r.label for r in sample) == {0: 12, 1: 12} and Counter(r.label for r in texts) == {0: 30, 1: 30}
    assert sorted(r.turn for r in sample if r.label == 0) == list(range(1, 13)) and not any(r.doc_id == 3 for r in sample)
    again = quality.labelled(docs, labels, "quality", 12, 30).sample.collect()
    assert sorted(map(str, again)) == sorted(map(str, sample))


def test_many_long_labelled_texts_stay_within_the_bound(spark):
    """300 labelled texts of about 30,000 indicators each: the driver gets a bounded number of them."""
    rng = np.random.default_rng(1)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def text(good):
        words = ["".join(rng.choice(list(letters if good else letters[:30]), 7)) for _ in range(4000)]
        return " ".join(words)

    base = [text(k % 2) for k in range(12)]
    rows = [(i, base[i % 12] + f" {i}") for i in range(300)]
    docs = materialise(spark.createDataFrame(rows, DOCS).repartition(4), "test")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    known = quality.labelled(docs, labels, "quality", 150)
    size = len(indicators(rows[0][1]))
    fetched, places = quality._fetched(known.sample, 40 * size)
    assert len(fetched.found) <= 40 * size and len(fetched) == len(places) >= 30 and set(fetched.labels) == {0, 1}
    assert [len(fetched[i]) for i in range(3)] == np.diff(fetched.begins)[:3].tolist()
    model = quality.fit(docs, labels, most=40 * size)
    told = quality.score(docs, model).select("doc_id", "score").collect()
    assert all((r.score > 0.5) == r.doc_id % 2 for r in told)


# --- toxicity ---------------------------------------------------------------------------

WORDS = ["idiot", "you", "your", "hello", "WORLD", "Stop!", "id1ot", "$hit", "fool", "a", "I", "nice", "ok?!", "été"]


def test_measures_equal_plain_ones():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["", None, "!!! ???"]
    entries = toxicity._hashes(["idiot", "fool"])
    lexicon = toxicity.Lexicon([entries, *[np.zeros(0, np.uint64)] * 3])
    rows = toxicity.measures(toxicity._Text(*text_bytes(pa.array(texts))), lexicon)
    names = list(toxicity.MEASURES)
    second = set(toxicity.SECOND_PERSON)
    assert rows.shape == (len(texts), len(names))
    for text, row in zip(texts, rows, strict=True):
        words = helpers.WORD.findall(text or "")
        assert row[names.index("size")] == pytest.approx(np.log1p(len(words)))
        plain = [re.sub(r"[^a-z0-9\x80-\U0010ffff]", "", helpers.lower(w)) for w in words]
        hits = [w in ("idiot", "fool") for w in plain]
        assert row[0] == pytest.approx(sum(hits) / max(len(words), 1))
        near = sum(
            h and any(plain[j] in second for j in range(max(i - toxicity.NEAR, 0), min(i + toxicity.NEAR + 1, len(words))))
            for i, h in enumerate(hits)
        )
        letters = [c for c in (text or "").encode() if chr(c).isascii() and chr(c).isalpha() or c >= 128]
        upper = sum(65 <= c <= 90 for c in letters)
        base = 2 * len(toxicity.STEMS)
        assert row[base] == pytest.approx(near / max(sum(hits), 1)) and row[base + 1] == pytest.approx(np.log1p(near))
        assert row[base + 2] == pytest.approx(upper / max(len(letters), 1))
        marks = sum((text or "").count(c) for c in "!?")
        assert row[base + 4] == pytest.approx(marks / max(len((text or "").encode()), 1))


def test_isotonic_curve_never_falls(spark):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(texts, labels.where(quality.remainder("doc_id", 5) != 0))
    raw = toxicity._raw(toxicity.measured(texts.select("doc_id", "text"), [model.lexicon]), model.trees)
    both = raw.select("doc_id", "raw").join(toxicity.score(texts, model), "doc_id").orderBy("raw").collect()
    scores = [r.score for r in both]
    assert all(a <= b + 1e-12 for a, b in zip(scores, scores[1:], strict=False)) and max(scores) > 0.5 > min(scores)


# --- hosts ------------------------------------------------------------------------------

def test_small_hosts_are_shrunk_to_the_mean(spark):
    """Many hosts of three documents whose rates differ by chance alone stay near the mean; large ones with rates of their
    own pull the prior down and keep theirs."""
    from orderlore.llm import hostrules

    rng = np.random.default_rng(7)
    failing = rng.binomial(3, 0.2, 3000)
    schema = "host string, n long, " + ", ".join(f"fails_{r} long" for r in hostrules.RULES)
    frame = lambda rows: spark.createDataFrame([(h, n, *[f] * len(hostrules.RULES)) for h, n, f in rows], schema)
    rates = [r.rate_lines for r in hostrules.host_rates(frame([(f"h{i}", 3, int(f)) for i, f in enumerate(failing)])).collect()]
    assert max(rates) < 0.35 and min(rates) > 0.15
    large = [(f"h{i}", 3, int(f)) for i, f in enumerate(failing)] + [(f"b{i}", 5000, 4500 if i % 2 else 100) for i in range(8)]
    got = {r.host: r.rate_lines for r in hostrules.host_rates(frame(large)).collect()}
    assert got["b1"] == pytest.approx(0.9, abs=0.01) and got["b2"] == pytest.approx(0.02, abs=0.01)
    one = hostrules.host_rates(frame([("only", 10, 9)])).first()
    assert one.rate_lines == pytest.approx(0.9) and hostrules.host_rates(frame([])).count() == 0


def test_indicators_of_the_sample_are_held_once(spark):
    """Beside the array, the driver holds a batch of rows, not all that a part fetches."""
    rows = [(i % 2, i, i // 2 + 1, " ".join(f"w{i}x{k}" for k in range(4000))) for i in range(160)]
    sample = spark.createDataFrame(rows, "label int, place long, turn int, text string").repartition(8)
    quality._fetched(sample.where(F.col("place") < 2), 1 << 24)  # imports what it needs
    tracemalloc.start()
    got, places = quality._fetched(sample, 1 << 24)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 160 and sorted(places.tolist()) == list(range(160))
    for i, place in enumerate(places[:4]):
        assert got[i].tolist() == indicators(rows[place][3]).tolist()
    assert got.found.nbytes > 8e6 and peak < 2.3 * got.found.nbytes, (got.found.nbytes, peak)
