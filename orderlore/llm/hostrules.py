"""Quality rules judged with the host that a document comes from, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlore.llm.common import SPACES, WORD
from orderlore.sources.tables import materialise

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: A rule holds against a host from this shrunk rate of failing documents on.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_LEAST, PRIOR_MOST = 1.0, 1_000_000.0

RULES = ("short", "symbols", "lines", "repeats", "letters")


def base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (all long) to the rows of ``docs``.

    A repeated three-word window is found by sorting 64-bit hashes of the windows within the row; positions are
    sorted along only in texts that repeat one. Null text counts as empty.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns({"_words": F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), "_lines": lines})
    n = F.size("_words").cast("long")
    df = df.withColumns(
        {
            "n_words": n,
            "word_chars": F.length(F.translate(whole, SPACES, "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(
                n >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - 3),
                    lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
                ),
            ),
        }
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.when(repeated, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_sorted", ordered).drop("_words", "_lines", "_windows")
    at = lambda j: F.get("_sorted", j)
    again = F.transform(
        "_sorted",
        lambda x, j: F.when((x.h == at(j + 1).h) | (F.when(j > 0, at(j - 1).h) == x.h), x.i),
    )
    places = F.when(F.col("_sorted").isNotNull(), F.sort_array(F.filter(again, lambda i: i.isNotNull())))
    df = df.withColumn("_places", places).drop("_sorted")
    steps = F.transform("_places", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - i, F.lit(3))))
    count = F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return df.withColumn("n_repeat_words", count).drop("_places")


def rule_failures() -> dict[str, Column]:
    """Whether a document fails each rule, from its measures."""
    c = F.col
    return {
        "short": c("n_words") < 50,
        "symbols": 10 * c("n_symbols") > 3 * c("n_words"),
        "lines": 10 * c("n_dup_lines") > 3 * c("n_lines"),
        "repeats": 100 * c("n_repeat_words") > 50 * c("n_words"),
        "letters": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words")),
    }


def host_rates(hosts: DataFrame) -> DataFrame:
    """Add rate_<rule>, the shrunk share of failing documents of each host.

    ``hosts`` has n and fails_<rule>. The prior of a rule is a beta distribution with the mean of all documents and
    the spread of the hosts' true rates: that of their own rates, weighted by documents, less what chance alone gives
    to as many documents. A host with few documents stays near the mean, a large one near its own rate; where the
    rates differ by no more than chance, or there is one host, all stay near the mean.
    """
    square = F.sum(F.col("n").cast("double") * F.col("n")).alias("square")
    total = [F.sum("n").alias("n"), F.count("*").alias("hosts"), square, *[F.sum(f"fails_{r}").alias(r) for r in RULES]]
    sums = hosts.agg(*total).first()
    if not sums["n"]:
        return hosts.withColumns({f"rate_{r}": F.lit(0.0) for r in RULES})
    mean = {r: sums[r] / sums["n"] for r in RULES}
    away = lambda r: F.col(f"fails_{r}") / F.col("n") - mean[r]
    spread = hosts.agg(*[F.sum(F.col("n") * away(r) * away(r)).alias(r) for r in RULES]).first()
    between = sums["n"] - sums["square"] / sums["n"]
    rates = {}
    for r in RULES:
        chance = mean[r] * (1 - mean[r])
        true = (spread[r] - (sums["hosts"] - 1) * chance) / between if between > 0 else 0.0
        weight = chance / true - 1 if true > 0 else PRIOR_MOST
        weight = min(max(weight, PRIOR_LEAST), PRIOR_MOST)
        rates[f"rate_{r}"] = (F.col(f"fails_{r}") + mean[r] * weight) / (F.col("n") + weight)
    return hosts.withColumns(rates)


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, host column): its measures and whether it is kept.

    Base: fewer than 50 words, or more than half of the words in repeated three-word windows, fail by themselves.
    Beyond that a rule counts against a document only if its host fails that rule by its shrunk rate
    (HOST_LIMIT); a document that fails no rule is kept on any host.

    Returns doc_id, the host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
    kept. Null host: a host of its own. Null, empty and wordless texts: all counts 0, base_failed. Repeated rows are
    documents of their own. Empty tables give empty results; other columns are ignored.
    """
    rows = docs.select("doc_id", F.col(host).alias("host"), F.col("text").alias("text"))
    measured = materialise(base_measures(rows).drop("text"), "measures")
    failures = rule_failures()
    hosts = measured.groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(fails).alias(f"fails_{r}") for r, fails in failures.items()]
    )
    hosts = host_rates(materialise(hosts, "hosts"))
    verdicts = hosts.select(
        F.coalesce("host", F.lit("")).alias("key"),
        F.col("host").isNull().alias("none"),
        *[(F.col(f"rate_{r}") > HOST_LIMIT).alias(f"bad_{r}") for r in RULES],
    )
    keyed = measured.withColumns({"key": F.coalesce("host", F.lit("")), "none": F.col("host").isNull()})
    base = failures["short"] | failures["repeats"]
    against = F.lit(False)
    for r in RULES:
        against = against | (failures[r] & F.col(f"bad_{r}"))
    judged = keyed.join(verdicts, ["key", "none"], "left").withColumns(
        {"base_failed": base, "kept": ~base & ~F.coalesce(against, F.lit(False))}
    )
    return judged.select(
        "doc_id", F.col("host").alias(host), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )
