"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document and leaves one bit and its
measurements. A policy names the bits it enforces, so that a new policy, and
the question what each of its rules costs, needs the ledger only, not the texts.

Defined results: a null text has no words. Empty texts fail ``short``. Equal
rows and rows without an id are judged like any other; an empty table gives an
empty ledger. Only ``doc_id`` and ``text`` are read, whatever else there is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.functions.frames import computed_once
from tideferry.llm.words import BLANKS, PLAIN_WORD, id_and_text, words_of

# The base rules.
LEAST_WORDS = 50
REPEAT_PERCENT = 50

# Rules in the order of their bits; a condition reads the measurements.
RULES = {
    "short": f"n_words < {LEAST_WORDS}",
    "repeats": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 40 * n_words",
    "shouting": "5 * n_shouts > n_words",
}
BITS = {name: 1 << place for place, name in enumerate(RULES)}
BASE = BITS["short"] | BITS["repeats"]
ALL = sum(BITS.values())

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shouts")


@dataclass(frozen=True)
class Policy:
    """A version's name and the bits of the rules it enforces."""

    version: str
    mask: int = ALL


STANDARD = Policy("v1")


def _windows(words: Column) -> Column:
    """One 64-bit hash per three consecutive words."""
    threes = F.arrays_zip(words, F.slice(words, F.lit(2), F.size(words)), F.slice(words, F.lit(3), F.size(words)))
    whole = F.slice(threes, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(whole, lambda three: F.xxhash64(three))


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct ``row``, the measurements, and ``failed``, the bits of the rules a row fails."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).select("row", text.alias("body"))
    rows = rows.select(
        "row",
        words_of(F.col("body")).alias("words"),
        F.filter(F.split("body", "\n"), lambda line: line.rlike(BLANKS.replace("[", "[^"))).alias("lines"),
        F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("body", r"[^!]+", "")).cast("bigint").alias("n_shouts"),
    )
    rows = rows.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_shouts",
        _windows(F.col("words")).alias("windows"),
    )
    measured = [name for name in MEASURES if name != "n_repeat_words"]
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select("row", *measured, F.when(twice, placed).otherwise(F.slice(placed, 1, 0)).alias("placed"))
    # Equal windows are neighbours now; a start covers three words, or up to the next start.
    equal = "filter(placed, (x, at) -> x.h = get(placed, at - 1).h OR x.h = get(placed, at + 1).h)"
    rows = rows.select("row", *measured, F.expr(f"sort_array(transform({equal}, x -> x.i))").alias("starts"))
    gaps = "zip_with(starts, slice(starts, 2, size(starts)), (a, b) -> least(3, coalesce(b - a, 3)))"
    covered = F.expr(f"aggregate({gaps}, 0L, (total, gap) -> total + gap)")
    rows = rows.select("row", *measured, covered.alias("n_repeat_words"))
    bits = [F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.select("row", *MEASURES, failed.cast("bigint").alias("failed"))


def kept_by(policy: Policy) -> Column:
    """Whether a ledger's row passes a policy. The base rules always hold."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask | BASE)) == 0


def filtered(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with."""
    # Computed before the filter: pushed below the ledger's steps, it would compute them again and again.
    rows = ledger(docs).select("row", computed_once([F.col("failed")]))
    return rows.filter(kept_by(policy)).select("row.*")


def judged(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """One row per document: measurements, bits, and the verdict of a policy."""
    return ledger(id_and_text(docs)).select(
        "row.doc_id",
        *MEASURES,
        "failed",
        (F.col("failed").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"),
        kept_by(policy).alias("kept"),
        F.lit(policy.version).alias("policy"),
    )


def ablation(judgements: DataFrame, policies: list[Policy]) -> DataFrame:
    """What each rule of each policy costs: how many documents it alone rejects.

    Documents are first counted by their bits, at most two to the power of the
    number of rules; all policies and rules then read those counts.
    """
    counted = judgements.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(F.lit(p.version).alias("policy"), F.lit(name).alias("rule"), F.lit(p.mask | BASE).cast("bigint").alias("mask"), F.lit(bit).cast("bigint").alias("bit"))
        for p in policies
        for name, bit in BITS.items()
        if (p.mask | BASE) & bit
    ]
    cases = counted.select("failed", "n", F.inline(F.array(*cases)))
    hits = F.col("failed").bitwiseAND(F.col("mask"))
    return cases.groupBy("policy", "rule").agg(
        F.sum(F.when(hits.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hits == F.col("bit"), F.col("n")).otherwise(0)).alias("n_alone"),
        F.sum(F.when(hits == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )


def sql(documents: str) -> str:
    """The same judgements in DuckDB."""
    rules = " + ".join(f"CASE WHEN {rule} THEN {BITS[name]} ELSE 0 END" for name, rule in RULES.items())
    return f"""
    WITH read AS (
        SELECT *, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{PLAIN_WORD}') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{PLAIN_WORD}')) AS lines
        FROM ({documents}) AS source),
    windowed AS (
        SELECT *, list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS windows FROM read),
    counted AS (
        SELECT *, CASE WHEN len(windows) > len(list_distinct(windows)) THEN map_from_entries(list_transform(map_entries(list_histogram(windows)), lambda e: (e.key, e.value))) END AS found
        FROM windowed),
    measured AS (
        SELECT * EXCLUDE (body, words, lines, windows, found),
               CAST(len(words) AS BIGINT) AS n_words,
               CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) AS BIGINT) AS n_lines,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               CAST(length(regexp_replace(body, '[^!]+', '', 'g')) AS BIGINT) AS n_shouts,
               CAST(CASE WHEN found IS NULL THEN 0 ELSE len(list_distinct(flatten(list_transform(
                   list_filter(range(1, len(words) - 1), lambda i: found[windows[i]] > 1), lambda i: [i, i + 1, i + 2])))) END AS BIGINT) AS n_repeat_words
        FROM counted)
    SELECT *, CAST({rules} AS BIGINT) AS failed FROM measured"""


QUERY_SQL = f"""SELECT doc_id, {", ".join(MEASURES)}, failed, failed & {BASE} <> 0 AS base_failed, failed = 0 AS kept, 'v1' AS policy
FROM ({sql("SELECT * FROM documents")}) AS ledger"""
