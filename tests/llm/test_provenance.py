"""Benchmark passages, manifests and whitening against plain versions, and rows that a join or explode multiplies."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlore.llm import decontaminate, lines, merkle, suffix, warc, whitening
from orderlore.llm.common import located
from orderlore.sources.tables import shared_folder

# --- rows named by their place ----------------------------------------------------------

def test_rows_below_joins_and_explodes_have_names_of_their_own(spark, docs):
    twice = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2))))
    joined = docs.join(spark.range(2).withColumnRenamed("id", "copy"), F.lit(True))
    for rows in (twice, joined):
        named, file, at = located(rows)
        assert named.select(file, at).distinct().count() == rows.count() == 2 * docs.count()
    filtered, file, at = located(docs.where("doc_id > 3").select("doc_id", F.upper("text").alias("text")))
    assert "LogicalRelation" in filtered._jdf.queryExecution().analyzed().toString() or filtered.count()


@pytest.mark.parametrize("how", ["explode", "join"])
def test_multiplied_rows_are_rows_of_their_own(spark, docs, rows, how):
    pair = F.explode(F.sequence(F.lit(1), F.lit(2)))
    many = docs.withColumn("again", pair) if how == "explode" else docs.join(spark.range(2).withColumnRenamed("id", "again"))
    many = many.select("doc_id", "text")
    cut = lines.without_repeated_lines(many).agg(F.sum("n_removed")).first()[0]
    assert cut == sum(helpers.cut_lines([r for r in rows for _ in range(2)]))
    gone = suffix.without_repeated_strings(many).agg(F.sum("n_removed")).first()[0]
    assert gone == sum(sum(x) for x in helpers.covered([r[1] for r in rows for _ in range(2)], 400))


@pytest.mark.parametrize("how", ["explode", "join"])
def test_multiplied_pages(spark, how):
    rng = random.Random(3)
    pages = [(i, "http://a/" + str(i), helpers.text(rng, 300, 30)) for i in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = shared_folder(spark, "test")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    if how == "explode":
        many = df.withColumn("page_id", F.explode(F.array(F.col("page_id"), F.col("page_id") + 10)))
    else:
        many = df.join(spark.range(2), F.lit(True)).withColumn("page_id", F.col("page_id") + 10 * F.col("id")).drop("id")
    got = {r.page_id: r for r in warc.round_trip(many, shared_folder(spark, "warc")).collect()}
    for i, _, html in pages:
        assert got[i].payload_digest == got[i + 10].payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert (got[i].record_type, got[i].refers_to, got[i + 10].record_type) == ("revisit", i + 10, "response")


# --- benchmark passages -----------------------------------------------------------------

PART = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def parts(text):
    return PART.findall(helpers.lower(text or ""))


def plain_hits(texts, items):
    """Per text: words, flags of hit words, ids of items with windows."""
    windows = {}
    for item_id, text in items:
        words = parts(text)
        size = min(len(words), 10)
        for k in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(item_id)
    out = []
    for text in texts:
        words = parts(text)
        flags, found = [False] * len(words), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                held = windows.get(tuple(words[k : k + size]))
                if held:
                    flags[k : k + size] = [True] * size
                    found |= held
        out.append((words, flags, found))
    return out


@pytest.fixture(scope="module")
def benchmark_rows(rows):
    rng = random.Random(9)
    base = [r[1] for r in rows if r[1] and len(r[1]) > 200]
    cut = lambda t, a, n: " ".join(parts(t)[a : a + n])
    items = [(i, cut(base[i], i, 10 + 3 * i)) for i in range(6)]
    items += [(20, cut(base[0], 5, 10)), (21, cut(base[0], 5, 9)), (22, cut(base[1], 0, 3)), (23, parts(base[2])[4])]
    items += [(24, "two"), (25, "ONE, two!"), (26, None), (27, ""), (28, " \t-"), (29, helpers.text(rng)), (30, "日本語 " * 12)]
    items += [(31, "x ab " * 3 + "ab " * 30), (20, cut(base[3], 2, 14)), (20, cut(base[0], 5, 10)), (None, cut(base[4], 1, 12))]
    items += [(32, cut(base[0], 3, 14).upper().replace(" ", " ... ")), (-5, cut(base[5], 0, 25))]
    items += [(100 + i, cut(base[0], 8, 12) + f" end{i}") for i in range(40)]  # a phrase of many items
    return items


def test_every_shared_window_is_found(spark, docs, rows, benchmark_rows, nothing):
    items = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    got = decontaminate.contamination(docs.withColumn("n_hit", F.lit(7)), items.withColumn("doc_id", F.lit(1)))
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert got.columns == [c for c in docs.columns if c != "text"] + added
    want = []
    for row, (words, flags, found) in zip(rows, plain_hits([r[1] for r in rows], benchmark_rows), strict=True):
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        want.append((row[0], len(words), sum(flags), len(found), hashlib.sha256(ids.encode()).hexdigest(), any(flags)))
    found = [tuple(r) for r in got.select("doc_id", *added).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(w[-1] for w in want) > 8 and not all(w[-1] for w in want)
    assert decontaminate.contamination(nothing, items).count() == 0
    assert decontaminate.contamination(docs, items.where("false")).where("contaminated").count() == 0
    clean = decontaminate.without_passages(docs, items)
    assert clean.columns == docs.columns and clean.count() == sum(not w[-1] for w in want)


def test_passages_are_the_longest_ranges(spark, docs, rows, benchmark_rows):
    items = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    got = Counter((r.doc_id, r.start, r.stop) for r in decontaminate.passages(docs, items).collect())
    covered = Counter()
    for row, (words, flags, _) in zip(rows, plain_hits([r[1] for r in rows], benchmark_rows), strict=True):
        covered[row[0]] += sum(flags)
    total = Counter()
    for (doc_id, start, stop), times in got.items():
        total[doc_id] += (stop - start) * times
    assert {k: v for k, v in covered.items() if v} == dict(total)


def test_windows_always_share_a_fingerprint():
    import pyarrow as pa

    rng = random.Random(4)
    for _ in range(20):
        words = [rng.choice("abc") + str(rng.randint(0, 3)) for _ in range(40)]
        for size in range(1, 11):
            one = decontaminate._Words(pa.array([" ".join(words)]))
            k = rng.randint(0, 40 - size)
            two = decontaminate._Words(pa.array(["zz", "q " + " ".join(words[k : k + size]) + " r s"]))
            keys, _, inside = one.windows(size)
            others, _, _ = two.windows(size)
            assert inside.all() and keys[k] == others[2] and one.digest(k, size) == two.digest(2, size)


# --- manifests --------------------------------------------------------------------------

def H(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: H(*(part(v) for v in (r[0], r[3], r[2], n, r[1])))
    trees, order = {}, sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    for lang in order:
        own = sorted((r[0] is not None, r[0] or 0, leaf(r, r[4]), i) for i, r in enumerate(rows) if r[2] == lang)
        trees[lang] = ([x[3] for x in own], plain_levels([x[2] for x in own]))
    top = plain_levels([trees[lang][1][-1][0] for lang in order])
    root, out = top[-1][0], []
    for k, lang in enumerate(order):
        for i, r in enumerate(trees[lang][0]):
            row, proof = rows[r], []
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, row[4] + 1 if hit and row[4] is not None else row[4])
            for levels, at in ((trees[lang][1], i), (top, k)):
                for level in levels[:-1]:
                    pair = level[at ^ 1 : (at ^ 1) + 1]
                    proof += pair
                    node = H(*(pair + [node] if at % 2 else [node] + pair))
                    at //= 2
            out.append((row[0], trees[lang][1][0][i], trees[lang][1][-1][0], root, H(*proof), node, node == root))
    return out


def test_positions_in_the_log():
    for n in range(1, 70):
        nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
        for levels in {merkle.height(n), 7}:
            log, level = merkle.build(nodes, levels), nodes
            for k in range(levels + 1):
                assert [log[merkle.position(k, i, n)] for i in range(len(level))] == level
                level = [merkle.digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
            assert len(log) == sum(merkle.width(n, k) for k in range(levels + 1))
            own = merkle._own_steps(b"".join(log), n, levels)
            assert all(merkle.fold(nodes[i], own[i]) == log[-1] for i in range(n))
            assert merkle._unpacked(merkle._packed(own[0])) == own[0]


@pytest.mark.parametrize("bits", [10, 2])
def test_manifest(docs, rows, nothing, bits):
    own = merkle.tampered("doc_id")
    assert sorted(map(str, map(tuple, merkle.verified(docs, own, bits).collect()))) == sorted(map(str, plain_manifest(rows)))
    honest = merkle.verified(docs, bits=bits)
    assert honest.count() == len(rows) and honest.where("NOT verified").count() == 0
    assert merkle.verified(nothing).count() == 0
    one = merkle.verified(docs.where("doc_id = 0")).collect()
    assert [(r.leaf, r.proof_sha256) for r in one] == [(one[0].root, hashlib.sha256(b"").hexdigest())]


# --- whitening --------------------------------------------------------------------------

def test_divide_and_conquer_finds_the_components():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 5, 17, 40):
        for kind in range(4):
            x = rng.standard_normal((3 * n, n)) * np.exp(rng.standard_normal(n))
            a = np.cov(x.T, bias=True).reshape(n, n)
            a = {0: a, 1: np.eye(n) * 3, 2: a @ a * 1e-9, 3: np.diag(np.repeat([2.0, 5.0], n)[:n])}[kind]
            values, vectors = whitening.components(a)
            assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
            assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-13 * np.linalg.norm(a)
            assert values == pytest.approx(np.linalg.eigvalsh(a)[::-1], abs=1e-13 * np.linalg.norm(a))


def test_polar_factor():
    rng = np.random.default_rng(2)
    for n in (1, 4, 30):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        signs = np.where(np.arange(n) % 3 == 0, -1.0, 1.0)
        a = q @ np.diag(signs * 10.0 ** -rng.uniform(0, 9, n)) @ q.T
        assert np.abs(whitening.polar((a + a.T) / 2) - q @ np.diag(signs) @ q.T).max() < 1e-6
        a = q @ np.diag(signs * rng.uniform(0.5, 2, n)) @ q.T
        assert np.abs(whitening.polar((a + a.T) / 2) - q @ np.diag(signs) @ q.T).max() < 1e-13


def vector_rows(size=6):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, size)) * (1 + np.arange(size)) * 0.3
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [None, [], [1.0] * (size - 1) + [None], [math.nan] * size, [math.inf] + [0.0] * (size - 1), [1.0] * (size + 1)]
    return rows + [(100 + i, v) for i, v in enumerate(odd)] + [(None, rows[0][1]), rows[1], rows[1]]


def test_whitened(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.withColumns({c: F.lit(1) for c in ("x", "n", "size", "component", "label")})
    used = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if i is None or i < 100]
    x = np.array([v for _, v in used], np.int64)
    n, sums = len(x), x.sum(axis=0)
    covariance = (x - sums / n).T @ (x - sums / n) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = (x - sums / n) @ vectors / np.sqrt(values)
    got = whitening.whitened(df).toPandas()
    assert len(got) == 6 * n and set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-12
    for k in range(6):
        own = got[got["component"] == k + 1]
        assert own["explained"].to_numpy() == pytest.approx(np.full(n, values[k] / values.sum()), rel=1e-12)
        by_id = dict(zip(own["vec_id"].fillna(-1), own["whitened"], strict=True))
        theirs = {(-1 if i is None else i): z[r, k] for r, (i, _) in enumerate(used)}
        sign = np.sign(by_id[5] * theirs[5])
        assert all(by_id[i] * sign == pytest.approx(v, abs=1e-10) for i, v in theirs.items())
    deviations = Counter(map(int, got[got["component"] == 1]["deviation"]))
    assert deviations == Counter(sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, sums, strict=True)) for r in x)
    assert set(whitening.whitened(df, most=2).toPandas()["component"]) == {1, 2}


def test_whitening_of_few_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.5]) for i in range(5)]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).count() == 0
    flat = [(i, [float(i % 4), 0.25]) for i in range(8)]
    assert set(r.component for r in whitening.whitened(spark.createDataFrame(flat, schema)).collect()) == {1}
    assert whitening._exact_deviation(np.array([[1 << 40], [-(1 << 40)]]), 2, [0]) == [None, None]


@pytest.mark.parametrize("kind", ["random", "chains", "two parents", "stars", "clique"])
def test_components_of_many_shapes(spark, kind):
    from orderlore.llm.common import components

    rng = random.Random(6)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
        "chains": [(k + 100 * c, k + 1 + 100 * c) for c in range(3) for k in range(40)],
        "two parents": [(30 + k, k % 7) for k in range(50)] + [(30 + k, (k + 1) % 7 + 10) for k in range(50)],
        "stars": [(100 * c, 100 * c + k) for c in range(4) for k in range(1, 30)],
        "clique": [(a, b) for a in range(12) for b in range(12)],
    }[kind]
    groups = helpers.Groups(1000)
    for a, b in edges:
        groups.join(a, b)
    want = {x: groups.root(x) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want


def test_rounds_of_components_take_tasks_by_their_edges(spark, monkeypatch):
    """Where the shuffle's partitions are many and not coalesced, a few edges still are one task, and many edges several."""
    from orderlore.llm import common

    edges = [(i, i + 1) for i in range(0, 400, 4)] + [(i + 1, i + 3) for i in range(0, 400, 4)] + [(5, None), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = common.components(df)
        files = len(got.inputFiles())
        monkeypatch.setattr(common, "EDGES", 20)
        more = common.components(df)
        several = len(more.inputFiles())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected = sorted((i + x, i) for i in range(0, 400, 4) for x in (0, 1, 3))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, more.collect())) == expected
    assert files == 1 and 1 < several <= 11, (files, several)
