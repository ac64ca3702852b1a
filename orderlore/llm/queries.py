"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.llm import (
    decontaminate,
    hostrules,
    lines,
    merkle,
    mixing,
    neardup,
    packing,
    quality,
    suffix,
    toxicity,
    vectors,
    warc,
    whitening,
)
from orderlore.sources.tables import shared_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def tokenizer_file() -> str:
    """The public vocabulary of the packing query; installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), tokenizer_file())


def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, folder, "embeddings"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages"), shared_folder(spark, "warc"))


def op4_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    left = suffix.without_repeated_strings(_table(spark, folder, "documents"))
    changed = (F.col("n_removed") > 0).alias("changed")
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", changed)


def op6_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = hostrules.judge(_table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    cut = lines.without_repeated_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", lines.text_digest().alias("kept_sha256"))


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    part = quality.remainder("doc_id", 4)
    model = quality.fit(docs, labels.where(part != 2), "quality")
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", (part == 2).alias("held_out"), "score", (F.col("score") >= quality.KEEP).cast("int").alias("predicted")
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    part = quality.remainder("doc_id", 5)
    model = toxicity.fit(docs, labels.where(part != 0), "toxic")
    return toxicity.score(docs, model).select(
        "doc_id", (part == 0).alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted")
    )


def op11_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, _table(spark, folder, "benchmark"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(_table(spark, folder, "documents"), merkle.tampered("doc_id"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_near_vectors": op3_near_vectors,
    "op4_repeated_strings": op4_repeated_strings,
    "op5_warc": op5_warc,
    "op6_host_rules": op6_host_rules,
    "op7_fuzzy_lines": op7_fuzzy_lines,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_decontaminate": op11_decontaminate,
    "op12_merkle": op12_merkle,
    "op13_whitening": op13_whitening,
}


_OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || COALESCE(doc_id::VARCHAR, '')) AS hash
  FROM documents),
sources AS (
  SELECT src, SUM(size)::BIGINT AS source_size, (ROW_NUMBER() OVER (ORDER BY src) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY src),
tried AS (
  SELECT ((SELECT SUM(source_size) FROM sources) - COALESCE(SUM(source_size) FILTER (below), 0) * 3.0::DOUBLE)
         / SUM(weight) FILTER (NOT below) AS level
  FROM (SELECT b.src AS try, s.source_size, s.weight, s.source_size * b.weight < b.source_size * s.weight AS below
        FROM sources b, sources s)
  GROUP BY try
  HAVING SUM(weight) FILTER (NOT below) > 0),
goal AS (
  SELECT src, source_size, LEAST(source_size * 3.0::DOUBLE, weight * level) AS target
  FROM sources, (SELECT level FROM tried
                 ORDER BY abs((SELECT SUM(LEAST(source_size * 3.0::DOUBLE, weight * level)) FROM sources)
                              - (SELECT SUM(source_size) FROM sources)) LIMIT 1)),
placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN FLOOR(g.target / g.source_size * 16777216)::BIGINT ELSE 0 END AS rate,
         ('0x' || substr(md5('mix' || d.src), 1, 6))::BIGINT AS shift,
         ROW_NUMBER() OVER (PARTITION BY d.src ORDER BY d.size, d.hash, d.doc_id) AS place
  FROM docs d JOIN goal g USING (src))
SELECT doc_id, size, source_size, target,
       size * (((place * rate + shift) >> 24) - (((place - 1) * rate + shift) >> 24)) AS taken
FROM placed
"""

_OP6_SQL = r"""
WITH docs AS (
  SELECT ROW_NUMBER() OVER () AS row_no, doc_id, source, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT row_no, i, COUNT(*) OVER (PARTITION BY row_no, a, b, c) AS found
  FROM (SELECT row_no, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT row_no, words, UNNEST(generate_series(1, len(words) - 2)) AS i FROM docs WHERE len(words) > 2))),
repeats AS (
  SELECT row_no, COUNT(DISTINCT i + k) AS n
  FROM windows, (VALUES (0), (1), (2)) AS steps(k) WHERE found > 1 GROUP BY row_no),
measured AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         COALESCE(r.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN repeats r USING (row_no)),
ruled AS (
  SELECT *, n_words < 50 AS short, 10 * n_symbols > 3 * n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS lines,
         100 * n_repeat_words > 50 * n_words AS repeats,
         word_chars < 2 * n_words OR word_chars > 15 * n_words AS letters
  FROM measured),
hosts AS (
  SELECT source, rule, COUNT(*) AS n, COUNT(*) FILTER (failed) AS f
  FROM (UNPIVOT (SELECT source, short, symbols, lines, repeats, letters FROM ruled)
        ON short, symbols, lines, repeats, letters INTO NAME rule VALUE failed)
  GROUP BY source, rule),
means AS (SELECT rule, SUM(f) / SUM(n) AS m FROM hosts GROUP BY rule),
spreads AS (
  SELECT rule, m, CASE WHEN SUM(n) - SUM(n * n) / SUM(n) > 0
                       THEN (SUM(n * (f / n - m) * (f / n - m)) - (COUNT(*) - 1) * m * (1 - m)) / (SUM(n) - SUM(n * n) / SUM(n))
                       ELSE 0 END AS v
  FROM hosts JOIN means USING (rule) GROUP BY rule, m),
priors AS (
  SELECT rule, m,
         LEAST(GREATEST(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1000000.0 END, 1.0), 1000000.0) AS w
  FROM spreads),
bad AS (
  SELECT source, list(rule) AS rules
  FROM hosts JOIN priors USING (rule) WHERE (f + m * w) / (n + w) > 0.5 GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats)
       AND NOT COALESCE((symbols AND list_contains(b.rules, 'symbols')) OR (r.lines AND list_contains(b.rules, 'lines'))
                        OR (letters AND list_contains(b.rules, 'letters')), false) AS kept
FROM ruled r LEFT JOIN bad b ON r.source IS NOT DISTINCT FROM b.source
"""

_OP5_SQL = """
WITH p AS (
  SELECT page_id, strlen(COALESCE(html, '')) AS payload_bytes, sha1(COALESCE(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN MAX(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM q
"""

_OP11_SQL = r"""
WITH docs AS (
  SELECT ROW_NUMBER() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT item_id,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
sized AS (SELECT *, LEAST(len(words), 10) AS size FROM items WHERE len(words) > 0),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS held
  FROM (SELECT *, UNNEST(generate_series(1, len(words) - size + 1)) AS i FROM sized)),
doc_windows AS (
  SELECT row_no, size, i, array_to_string(words[i : i + size - 1], ' ') AS held
  FROM (SELECT row_no, words, size, UNNEST(generate_series(1, len(words) - size + 1)) AS i
        FROM docs, (SELECT DISTINCT size FROM sized) WHERE len(words) >= size)),
hits AS (SELECT row_no, size, i, item_id FROM doc_windows JOIN item_windows USING (size, held)),
hit_words AS (
  SELECT row_no, COUNT(DISTINCT i + k) AS n_hit
  FROM (SELECT DISTINCT row_no, i, UNNEST(generate_series(0, size - 1)) AS k FROM hits) GROUP BY row_no),
hit_items AS (
  SELECT row_no, COUNT(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT row_no, item_id FROM hits) GROUP BY row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit, COALESCE(n_items, 0)::BIGINT AS n_items,
       sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (row_no) LEFT JOIN hit_items USING (row_no)
"""

_OP12_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, lang, COALESCE(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
         || COALESCE(strlen(source) || ':' || source, '-') || COALESCE(strlen(lang) || ':' || lang, '-') AS before,
         n_chars, COALESCE(strlen(text) || ':' || text, '-') AS after
  FROM documents),
crc_table AS (
  SELECT n, list_reduce(list_prepend(n, generate_series(1, 8)),
                        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
  FROM (SELECT UNNEST(generate_series(0, 255))::BIGINT AS n)),
crc_list AS (SELECT list(c ORDER BY n) AS t FROM crc_table),
claims AS (
  SELECT *, n_chars + CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                             string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                             lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 7 = 0
                           THEN 1 ELSE 0 END AS claimed
  FROM texts, crc_list),
leaves AS (
  SELECT ROW_NUMBER() OVER () AS row_no, doc_id, lang,
         sha256(before || COALESCE(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') || after) AS leaf,
         sha256(before || COALESCE(strlen(claimed::VARCHAR) || ':' || claimed::VARCHAR, '-') || after) AS claim
  FROM claims),
placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
lower_nodes AS (
  SELECT lang, 0 AS level, i, leaf AS d FROM placed
  UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(d, '' ORDER BY i))
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY lang) AS many FROM lower_nodes) WHERE many > 1
  GROUP BY lang, level, i // 2),
tops AS (
  SELECT lang, MAX(level) AS levels, arg_max(d, level) AS subroot, ROW_NUMBER() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM lower_nodes GROUP BY lang),
upper_nodes AS (
  SELECT 0 AS level, place AS i, subroot AS d FROM tops
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(d, '' ORDER BY i))
  FROM (SELECT *, COUNT(*) OVER () AS many FROM upper_nodes) WHERE many > 1
  GROUP BY level, i // 2),
root AS (SELECT MAX(level) AS upper_levels, arg_max(d, level) AS root FROM upper_nodes),
above AS (
  SELECT row_no, claim, levels + upper_levels AS n_steps, UNNEST(generate_series(0, levels + upper_levels - 1)) AS step,
         placed.lang, i, place, levels
  FROM placed JOIN tops ON placed.lang IS NOT DISTINCT FROM tops.lang, root),
steps AS (
  SELECT row_no, step, step < levels AS low, lang, CASE WHEN step < levels THEN step ELSE step - levels END AS level,
         CASE WHEN step < levels THEN i >> step ELSE place >> (step - levels) END AS own
  FROM above),
siblings AS (
  SELECT s.row_no, s.step, s.own % 2 AS is_right, COALESCE(a.d, b.d) AS d
  FROM steps s
  LEFT JOIN lower_nodes a ON s.low AND a.level = s.level AND a.i = xor(s.own, 1) AND a.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN upper_nodes b ON NOT s.low AND b.level = s.level AND b.i = xor(s.own, 1)),
proofs AS (SELECT row_no, string_agg(d, '' ORDER BY step) AS joined FROM siblings GROUP BY row_no),
folded AS (
  SELECT row_no, 0 AS step, claim AS d FROM placed
  UNION ALL
  SELECT f.row_no, f.step + 1,
         sha256(CASE WHEN s.d IS NULL THEN f.d WHEN s.is_right = 1 THEN s.d || f.d ELSE f.d || s.d END)
  FROM folded f JOIN siblings s ON f.row_no = s.row_no AND f.step = s.step),
ends AS (SELECT row_no, arg_max(d, step) AS folded_root FROM folded GROUP BY row_no)
SELECT doc_id, leaf, subroot, root, sha256(COALESCE(joined, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN tops ON placed.lang IS NOT DISTINCT FROM tops.lang JOIN ends USING (row_no) LEFT JOIN proofs USING (row_no), root
"""

ORACLE_SQL: dict[str, str] = {"op1_mixing": _OP1_SQL, "op5_warc": _OP5_SQL, "op6_host_rules": _OP6_SQL,
                              "op11_decontaminate": _OP11_SQL, "op12_merkle": _OP12_SQL}
