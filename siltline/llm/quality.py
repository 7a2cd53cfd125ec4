"""Quality rules: a table of thresholds compiled into one projection.

All measures are built-in expressions over the words of a text; nothing is shuffled and no user
function runs. Repeated three-word windows are found by sorting the hashes (64 bits) of a text's
windows with their positions, so cost grows with n log n of one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import WORD, table

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he this are or his from at which but have an had they you were "
    "de la le et les des en un du une que est pour qui dans par sur au avec ne se pas il plus "
    "der die und den von das mit sich des auf ist im dem nicht ein eine als auch es für zu "
    "el los y del las con una su al lo como más pero sus o este"
).split()

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A text passes when ``low <= measure <= high``; a missing bound is open, a missing measure passes."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("words", "n_words", 50, 100_000),
    Rule("repeated_words", "100 * n_repeat_words / n_words", None, 50),
    Rule("mean_word_length", "word_chars / n_words", 2, 14),
    Rule("symbols", "n_symbols / n_words", None, 0.3),
    Rule("stop_words", "n_stop_words / n_words", 0.01, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / n_lines", None, 0.3),
)


def compile_rules(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(verdict, names of the rules that a row breaks) as expressions over the measures."""
    broken = []
    for rule in rules:
        measure = F.expr(rule.measure.replace("/ n_words", "/ nullif(n_words, 0)").replace("/ n_lines", "/ nullif(n_lines, 0)"))
        within = F.lit(True)
        if rule.low is not None:
            within &= measure >= rule.low
        if rule.high is not None:
            within &= measure <= rule.high
        broken.append(F.when(~F.coalesce(within, F.lit(True)), F.lit(rule.name)))
    names = F.array_compact(F.array(*broken))
    return F.size(names) == 0, names


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures of each row's whole text.

    A null or empty text has no words and no lines and zero everywhere; equal rows are measured each;
    columns other than ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    words = docs.select("doc_id", text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    hashes = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    hashed = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "").alias("lines"),
        hashes.alias("hashes"),
    )
    # Only texts in which a window comes back have their windows sorted.
    sorted_windows = hashed.select(
        "*",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ).alias("windows"),
    )
    found_twice = F.transform(
        "windows",
        lambda s, i: F.when((s["h"] == F.get("windows", i - 1)["h"]) | (s["h"] == F.get("windows", i + 1)["h"]), s["p"]),
    )
    placed = sorted_windows.select(
        "*",
        F.sort_array(F.array_compact(found_twice)).alias("places"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    # Windows at sorted places cover three words each, less where the next one begins.
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return placed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_stop_words", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: F.ltrim(x).rlike(r"\A[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).rlike(r"(\.\.\.|…)\z"))).cast("long").alias("n_ellipsis_lines"),
    )


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and the names of broken rules of each row."""
    verdict, names = compile_rules(rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measures(docs).select("*", failed.alias("base_failed"), (~failed & verdict).alias("kept"), names.alias("broken_rules"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(words) - 1)) AS p, words FROM w WHERE len(words) > 2),
t AS (SELECT r, p, count(*) OVER (PARTITION BY r, words[p], words[p + 1], words[p + 2]) AS n FROM g),
c AS (SELECT r, count(DISTINCT q) AS n_repeat_words FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM t WHERE n > 1) GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)}))) AS n_stop_words, len(lines) AS n_lines,
        len(list_filter(lines, lambda x: regexp_matches(x, '^ *[-*\x{{2022}}]'))) AS n_bullet_lines,
        len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}}) *$'))) AS n_ellipsis_lines
      FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words <= 100000 AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / n_words <= 0.3
    AND n_stop_words / n_words >= 0.01 AND coalesce(n_dup_lines / n_lines, 0) <= 0.5
    AND coalesce(n_bullet_lines / n_lines, 0) <= 0.9 AND coalesce(n_ellipsis_lines / n_lines, 0) <= 0.3 AS kept
FROM b
"""
