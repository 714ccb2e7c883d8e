"""Quality rules: a short-circuit cascade over counts of each document, all in SQL functions.

``text_counts`` adds the counts that rules read. ``rank_rules`` measures each rule's
time and rejections on a bounded sample, drawn by hash from all rows, and sorts by rejections per second. The
sample is gone over ``REPEATS`` times in a run, the median run counts, and what the run costs without a rule is
taken off, so that the start of a job is not measured. ``apply_rules`` chains the rules in that order, so that a rejected
document costs no later rule. The order changes the cost only: a document is kept if it passes
every rule.

Null and empty texts have no words and zero counts, and fail the base rule. Rules of equal rank stay in the order given.
Each row is judged by itself, repeated ones alike; texts of any length are taken whole. Extra
columns stay; a column of a count's own name is replaced by the count.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import query, table

#: About so many rows are measured, so often in a run, in so many runs.
SAMPLE_ROWS = 2000
REPEATS = 16
RUNS = 3
#: A rule costs this share of the run without a rule at least; less is noise.
LEAST_COST = 0.1
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Rule:
    """A document passes if the condition is true; null counts as a pass."""

    name: str
    passes: Column

    def rejects(self) -> Column:
        return ~F.coalesce(self.passes, F.lit(True))


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words that lie in an n-word window found at least twice in the array."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - n),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]),
    )
    return F.when(F.size(words) <= n, F.lit(0)).otherwise(_covered(hashes, n)).cast("long")


def _covered(hashes: Column, n: int) -> Column:
    # One-element arrays bind each intermediate array once.
    def ordered(h: Column) -> Column:
        return F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        def hash_at(k: Column) -> Column:
            return F.get(s, k)["h"]

        found = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda k: F.coalesce(
                (hash_at(k) == hash_at(k + 1)) | (F.when(k > 0, hash_at(k - 1)) == hash_at(k)), F.lit(False)
            ),
        )
        return F.sort_array(F.transform(found, lambda k: F.get(s, k)["i"]))

    def width(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - x, F.lit(n))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def bind(value: Column, use: object) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def count(h: Column) -> Column:
        repeated = bind(ordered(h), lambda s: bind(starts(s), width))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated)

    return bind(hashes, count)


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words as columns of the table.

    Lines are split at \\n and count if they hold a word; words are runs without white space.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.withColumns(
        {
            "_words": F.array_remove(F.split(t, "[ \\t-\\r]+"), ""),
            "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
            "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
            "word_chars": F.length(F.translate(t, SPACES, "")),
        }
    )
    return rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.col("word_chars").cast("long"),
            "n_symbols": F.col("n_symbols").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
        }
    ).drop("_words", "_lines")


def base_fails() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules for prose: symbols, word length, exclamations, capitals, repeated lines."""
    t, words = F.col(text), F.col("n_words")

    def count(pattern: str) -> Column:
        return F.length(t) - F.length(F.regexp_replace(t, pattern, ""))

    return [
        Rule("capitals", 2 * count("\\p{Lu}") <= F.col("word_chars")),
        Rule("exclamations", 10 * count("!") <= 3 * words),
        Rule("symbols", 10 * F.col("n_symbols") <= words),
        Rule("word_length", F.col("word_chars").between(2 * words, 15 * words)),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") <= 3 * F.col("n_lines")),
    ]


def rank_rules(df: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> list[Rule]:
    """The rules by rejections per second of work, measured on about ``sample_rows`` rows."""
    total = df.count()
    if not total:
        return list(rules)
    place = F.pmod(F.xxhash64(key, F.length(text)), F.lit(1_000_000))
    sample = df.where(place < 1_000_000 * sample_rows // total + 1).persist()
    try:
        again = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

        def measured(rejects: Column) -> tuple[float, int]:
            probe = again.agg(F.count_if(rejects))
            times = []
            for _ in range(RUNS + 1):
                start = time.perf_counter()
                found = probe.first()[0]
                times.append(time.perf_counter() - start)
            return statistics.median(times[1:]), found  # the first run compiles

        sample.count()
        empty, _ = measured(F.col("_again") > REPEATS)
        worth = []
        for rule in rules:
            seconds, rejected = measured(rule.rejects())
            worth.append((rejected / max(seconds - empty, LEAST_COST * empty), rule))
        return [rule for _, rule in sorted(worth, key=lambda x: -x[0])]
    finally:
        sample.unpersist()


def first_rejection(rules: Sequence[Rule]) -> Column:
    """The name of the first rule, in this order, that rejects the row; null if none does."""
    chain = F.lit(None).cast("string")
    for rule in reversed(rules):
        chain = F.when(rule.rejects(), F.lit(rule.name)).otherwise(chain)
    return chain


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Adds base_failed, rejected_by (of the measured order) and kept."""
    ranked = rank_rules(df, rules, sample_rows, key, text)
    return df.withColumns({"base_failed": base_fails()}).withColumns(
        {
            "rejected_by": F.when(F.col("base_failed"), F.lit("base")).otherwise(first_rejection(ranked)),
        }
    ).withColumn("kept", F.col("rejected_by").isNull())


SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), g AS (
  SELECT doc_id, i, lead(i, 4) OVER d IS NOT NULL AS whole,
         word || ' ' || lead(word, 1) OVER d || ' ' || lead(word, 2) OVER d || ' ' || lead(word, 3) OVER d
         || ' ' || lead(word, 4) OVER d AS gram
  FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), f AS (
  SELECT doc_id, i, CASE WHEN whole AND count(*) OVER (PARTITION BY doc_id, gram) > 1 THEN 1 ELSE 0 END AS found FROM g
), r AS (
  SELECT doc_id, sum(hit)::BIGINT AS n_repeat_words FROM (
    SELECT doc_id, max(found) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM f
  ) GROUP BY doc_id
), l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w
  ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), c AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS caps,
         length(text) - length(regexp_replace(text, '!', '', 'g')) AS bangs
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND word_chars BETWEEN 2 * n_words AND 15 * n_words
       AND 10 * bangs <= 3 * n_words AND 2 * caps <= word_chars AND 10 * n_dup_lines <= 3 * n_lines AS kept
FROM b
"""


@query("op4_quality_rules", SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = text_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return apply_rules(counted, standard_rules()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
