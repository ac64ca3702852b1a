"""The operators against plain versions of themselves, on small tables with every odd case."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import helpers
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlore.llm import hostrules, lines, mixing, neardup, packing, quality, suffix, toxicity, vectors, warc
from orderlore.llm.common import components
from orderlore.llm.queries import tokenizer_file
from orderlore.sources.tables import shared_folder


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (5, 5), (None, 4), (7, 8), (8, 7), (20, 21), (22, 21), (23, 22), (24, 23)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20}
    assert components(df.where("false")).count() == 0


# --- mixing -----------------------------------------------------------------------------

def test_mixing_targets(spark, docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for row in rows:
        sizes[row[3]] += len(helpers.WORD.findall(row[1] or ""))
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        above = {s for s in order if s not in full and weight[s] * level > 3 * sizes[s]}
        if not above:
            break
        full |= above
    for r in got:
        assert r.target == pytest.approx(min(3 * sizes[r.source], weight[r.source] * level))
        assert r.source_size == sizes[r.source] and r.taken == r.size * r.copies and 0 <= r.copies <= 3
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    largest = max(r.size for r in got)
    assert all(abs(taken[r.source] - r.target) <= largest for r in got)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixing_repeats_documents(docs, nothing):
    plan = {(r.doc_id, r.copies) for r in mixing.mix(docs.where("doc_id is not null")).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts and all(counts.get(i, 0) >= 0 for i, _ in plan)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_given_weights(spark):
    rows = [(i, "w " * 10, "a" if i < 50 else "b") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight long")
    taken = {r.source: r.t for r in mixing.mix(df, weights).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert abs(taken["a"] - 750) <= 10 and abs(taken["b"] - 250) <= 10


# --- packing ----------------------------------------------------------------------------

def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, length = int(rng.integers(20, 60)), 16
        documents = np.unique(np.append(rng.integers(1, n, 4), n))
        sentences = np.unique(rng.integers(1, n, 12))
        found = packing.cuts(n, documents, sentences, length)
        places = sorted({0, n, *documents.tolist(), *sentences.tolist()})
        if max(np.diff(places)) > length // 4:
            assert max(np.diff([0, *found])) <= max(length, max(np.diff(places)))
            continue

        def price(p):
            return 0 if p == n or p in documents else packing.AT_SENTENCE

        best = {0: 0}
        for p in places[1:]:
            best[p] = min(best[q] + length - p + q + price(p) for q in places if q < p and p - q <= length)
        cost = sum(length - b + a + price(b) for a, b in zip([0, *found[:-1]], found, strict=True))
        assert cost == best[n] and found[-1] == n


def test_packing_keeps_every_id(docs, rows, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    got = packing.pack(docs, tokenizer_file()).collect()
    ids = {}
    for doc_id, text, *_ in rows:
        ids[doc_id] = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
    pieces = defaultdict(list)
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
    times = Counter(r[0] for r in rows)
    for doc_id, own in ids.items():
        assert sum(n for _, n in pieces[doc_id]) == len(own) * times[doc_id]
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    assert packing.pack(nothing, tokenizer_file()).count() == 0


# --- vectors ----------------------------------------------------------------------------

def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 24))
    rows = []
    for i in range(400):
        v = base[rng.integers(0, 20) if i % 3 else 7] + rng.normal(size=24) * rng.choice([0, 0.05, 0.13, 0.16])
        rows.append([i, [float(x) for x in v.astype(np.float32)], int(rng.integers(0, 3))])
    rows[5][2] = None
    rows[6][1] = [0.0] * 24
    rows[8][1] = None
    rows[9][1] = [float("nan")] + rows[9][1][1:]
    rows[10][1] = [None, *rows[10][1][1:]]
    rows[11][1] = []
    rows[12][1] = rows[12][1][:7]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(df.withColumn("unit", F.lit(1)).repartition(4)).collect()}
    usable = [i for i in range(400) if i not in (5, 6, 8, 9, 10, 11)]
    groups, n = helpers.Groups(400), Counter()
    for a in usable:
        for b in usable:
            x, y = np.array(rows[a][1]), np.array(rows[b][1])
            if a < b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    groups.join(a, b)
                    n[a] += 1
                    n[b] += 1
    assert sum(n.values()) > 1000
    for i in range(400):
        assert (got[i].n_links, got[i].component_id) == (n[i], groups.root(i)) and got[i].kept == (groups.root(i) == i)
    assert vectors.near_vectors(df.where("false")).count() == 0


# --- repeated strings -------------------------------------------------------------------

@pytest.mark.parametrize("group", [4096, 1])
def test_repeated_strings(docs, rows, nothing, monkeypatch, group):
    monkeypatch.setattr(suffix, "GROUP", group)  # 1: every group of several slices is dealt in parts
    flags = helpers.covered([r[1] for r in rows], suffix.LEAST)
    want = []
    for row, gone in zip(rows, flags, strict=True):
        data = (row[1] or "").encode()
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((row[0], len(data), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    got = suffix.without_repeated_strings(docs)
    found = [tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and sum(w[2] for w in want) > 2000
    assert suffix.without_repeated_strings(nothing).count() == 0


def test_common_prefixes():
    rng = np.random.default_rng(0)
    for alphabet in (2, 4):
        data = rng.integers(97, 97 + alphabet, 300).astype(np.uint8)
        order = suffix.sorted_rotations(data, 12)
        found = suffix.common_prefixes(data, order, 12)
        turned = [bytes(np.roll(data, -i)[:12]) for i in order]
        assert turned == sorted(turned)
        for k in range(1, 300):
            same = next((j for j in range(12) if turned[k][j] != turned[k - 1][j]), -1)
            assert found[k] == same


# --- archives ---------------------------------------------------------------------------

def test_archives(spark, tmp_path):
    long = "<p>" + "ü" * 60_000 + "\r\n\r\nWARC/1.1\r\n</p>"
    same = "<html>" + "x" * 1500
    rows = [(1, "http://a/\r\nb c", long), (2, None, None), (3, "u", ""), (4, "u", same), (9, "u", same), (7, "v", same)]
    rows += [(None, "n", same), (11, "s", "short"), (12, "s", "short"), (9, "u", same)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(df.withColumn("record", F.lit(1)).repartition(3), shared_folder(spark, "test"))
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        again = html == same and page_id != 9
        kind = ("revisit", 9) if again else ("response", None)
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), *kind))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want, key=str)
    assert warc.round_trip(df.where("false"), shared_folder(spark, "test")).count() == 0


def test_segments_are_checked():
    row = {"record": "r", "url": "u", "page_id": 1, "digest": "d", "refers_to": None, "payload": b"abc" * 5000}
    parts = warc.records_of(row, segment=1000)
    content = b"\r\n\r\n".join([*reversed(parts), b""])
    read = [(f, b) for f, b in warc.parsed(content)]
    rows = [warc._row(f, f.get("warc-segment-origin-id", f["warc-record-id"]), b, int(f["warc-segment-number"])) for f, b in read]
    rows.sort(key=lambda r: r["number"])
    assert warc._whole(rows)["payload"] == row["payload"]
    for broken in (rows[1:], rows[:-1], [rows[0], *rows[2:]], [*rows[:-1], rows[-1] | {"total": 7}]):
        with pytest.raises(ValueError):
            warc._whole(broken)
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


# --- host rules -------------------------------------------------------------------------

def test_host_rules_measure_texts(docs, rows, nothing):
    got = hostrules.judge(docs)
    found = [(r.doc_id, r.n_words, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got.collect()]
    want = []
    for doc_id, text, *_ in rows:
        words = helpers.WORD.findall(text or "")
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        full = [x for x in (text or "").split("\n") if helpers.WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want.append((doc_id, len(words), len(full) - len(set(full)), len(covered), failed))
    assert sorted(found, key=str) == sorted(want, key=str)
    assert hostrules.judge(nothing).count() == 0


def test_hosts_decide(spark):
    clean = "\n".join(" ".join(f"word{i}x{k}" for k in range(12)) for i in range(6))
    junk = clean.replace(" ", "### ")
    rows = [(i, junk if i % 10 else clean, "bad") for i in range(40)] + [(100 + i, junk if i == 0 else clean, "good") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in hostrules.judge(df).collect()}
    assert all(kept[i] == (i % 10 == 0) for i in range(40)) and all(kept[100 + i] for i in range(40))


# --- lines ------------------------------------------------------------------------------

def test_lines(docs, rows, nothing):
    cut = lines.without_repeated_lines(docs)
    assert set(docs.columns) <= set(cut.columns)
    got = Counter((r.doc_id, r.n_removed) for r in cut.collect())
    assert got == Counter((row[0], n) for row, n in zip(rows, helpers.cut_lines(rows), strict=True))
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[rows[0][0]] == rows[0][1]
    assert {rows[i][0]: texts[rows[i][0]] for i in range(len(rows)) if rows[i][1] in (None, "", " \t\n")} == {
        r[0]: r[1] for r in rows if r[1] in (None, "", " \t\n")
    }
    assert lines.without_repeated_lines(nothing).count() == 0


@pytest.mark.parametrize("node", [1 << 17, 2])
def test_lines_of_one_bucket(spark, monkeypatch, node):
    monkeypatch.setattr(lines, "NODE", node)  # 2: buckets are split and compared in blocks
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    texts = []
    for _ in range(6):  # a base and variants that are similar to the base, but not to each other
        base = letters(130)
        texts += [base, *(base[:k] + letters(2) + base[k + 2 :] for k in range(10, 121, 11))]
    for _ in range(6):  # lines of a template in pairs; only those of a pair are similar
        frame = letters(90)
        for own in (letters(34) for _ in range(12)):
            texts += [frame + own, frame + own[:-3] + letters(3)]
    rng.shuffle(texts)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    cut = lines.without_repeated_lines(spark.createDataFrame(rows, helpers.SCHEMA))
    got = {r.doc_id: r.n_removed for r in cut.collect()}
    assert [got[i] for i in range(len(rows))] == helpers.cut_lines(rows)


# --- near duplicates --------------------------------------------------------------------

@pytest.mark.parametrize("node", [2048, 2])
def test_near_duplicates(docs, rows, nothing, monkeypatch, node):
    monkeypatch.setattr(neardup, "NODE", node)  # 2: nodes are branched and compared in blocks
    sets = [helpers.shingles(r[1]) for r in rows]
    groups = helpers.near_groups(sets, 75)
    ids = defaultdict(list)
    for row, g in zip(rows, groups, strict=True):
        ids[g].append(row[0])
    low = {g: min((i for i in own if i is not None), default=None) for g, own in ids.items()}
    want = [(r[0], len(s), low[g], r[0] == low[g]) for r, s, g in zip(rows, sets, groups, strict=True)]
    got = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert neardup.near_duplicates(nothing).count() == 0
    stay = neardup.without_near_duplicates(docs)
    assert stay.columns == docs.columns and stay.count() == len(set(groups))


# --- scores -----------------------------------------------------------------------------

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def _accuracy(scored, labels, label, limit):
    both = scored.join(labels, "doc_id").select((F.col("score") >= limit).cast("int").alias("p"), label).collect()
    return sum(p == y for p, y in both) / len(both)


def test_quality_is_learned(labelled, docs, nothing, rows):
    texts, labels = labelled
    part = quality.remainder("doc_id", 4)
    model = quality.fit(texts, labels.where(part != 2))
    assert _accuracy(quality.score(texts, model), labels.where(part == 2), "quality", quality.KEEP) > 0.9
    odd = quality.score(docs, model)
    assert odd.count() == len(rows) and odd.where("score between 0 and 1").count() == len(rows)
    assert quality.score(nothing, model).count() == 0
    none = quality.fit(texts, labels.where("false"))
    assert quality.score(docs, none).where("abs(score - 0.5) > 1e-6").count() == 0


def test_toxicity_is_learned(labelled, docs, nothing, rows):
    texts, labels = labelled
    part = quality.remainder("doc_id", 5)
    model = toxicity.fit(texts, labels.where(part != 0))
    assert _accuracy(toxicity.score(texts, model), labels.where(part == 0), "toxic", toxicity.TOXIC) > 0.9
    odd = toxicity.score(docs, model)
    assert odd.count() == len(rows) and odd.where("score between 0 and 1").count() == len(rows)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.score(docs, toxicity.fit(texts, labels.where("false"))).where("score <> 0").count() == 0


def test_rare_toxic_labels_teach_entries(spark):
    """An entry of 40 of 40 toxic and 80 of 2,000 clean documents: more clean ones, but log odds of 3.2."""
    own = [(1, i % 2, "zugwort") for i in range(40)]
    own += [(0, i % 2, "zugwort" if i < 80 else "anderes") for i in range(2_000)]
    for lexicon in toxicity.learn_lexicons(spark.createDataFrame(own, "label int, half int, text string")):
        assert np.isin(toxicity._hashes(["zugwort"]), lexicon.entries[0]).all()


def test_broken_archive_raises(spark):
    path = shared_folder(spark, "test")
    spark.createDataFrame([("no record",)], "value string").write.text(path)
    with pytest.raises(PySparkException):
        warc.read_archives(spark, path).collect()
