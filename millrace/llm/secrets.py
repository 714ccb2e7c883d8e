"""Secret scans: fixed patterns, and two character Markov models that find other random strings.

Everything runs as SQL functions. A pattern's spans come from the pieces around its
matches: positions are sums of lengths in code points, ends exclusive, taken block by block of ``BLOCK`` matches and then
over the blocks, so that no array is copied once per match. A candidate is a run of at least ``MIN_RUN`` key characters,
apart from what the patterns found, that mixes digits and letters or small letters before capitals. It is a secret if its
characters are likelier under a model of random strings than under one of ordinary identifiers: by ``MIN_RATIO`` per step, and by
``MIN_TOTAL`` in all, which a short run reaches only if it is far from any identifier.

Null and empty texts have no spans. Texts of any length are taken whole. Each row is judged by itself, repeated ones alike;
spans of equal start go in the order of the kinds. Extra columns stay, and columns of the names
assign, access, hex or random are replaced.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.registry import query, table

ASSIGN = (
    r"(?i:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
)
VALUE = r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN_CLASS = r"[A-Za-z0-9+/_=-]"
MIN_RUN = 8
#: About so many documents with matches, and documents without, train the models; they are looked for
#: among SEARCH times as many, those with the least hashes of the key.
TRAIN_DOCS = 4000
SEARCH = 20
#: Least log-likelihood ratio of a secret, in nats: the mean per character step, and the sum.
MIN_RATIO = 0.35
MIN_TOTAL = 19 * MIN_RATIO
#: Matches whose positions are summed in one go.
BLOCK = 256
#: Stands for each character of a found span; in the text itself it is replaced before.
MASK = "\x01"
SPAN = "array<struct<start:int,end:int,value:string>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def pieces_and_hits(text: Column, pattern: str) -> Column:
    """(p, h): the pieces around the matches, one more than these, and the matches."""
    return F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("h"))


def spans_between(pieces: Column, hits: Column) -> Column:
    """(start, end, value) of the hits; pieces are one more than hits, of which there is one at least."""

    def step(state: Column, i: Column) -> Column:
        hit = F.get(hits, i)
        start = state["at"] + F.length(F.get(pieces, i))
        end = start + F.length(hit)
        found = F.struct(start.alias("start"), end.alias("end"), hit.alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    def block(first: Column) -> Column:
        """The spans of a block, counted from its own start, and its length."""
        last = F.least(first + BLOCK, F.size(hits)) - 1
        return F.aggregate(F.sequence(first, last), F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), step)

    def moved(state: Column, part: Column) -> Column:
        shift = state["at"]
        out = F.transform(
            part["out"],
            lambda s: F.struct((s["start"] + shift).alias("start"), (s["end"] + shift).alias("end"), s["value"].alias("value")),
        )
        return F.struct((shift + part["at"]).alias("at"), F.concat(state["out"], F.array(out)).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), F.size(hits) - 1, F.lit(BLOCK)), block)
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.aggregate(blocks, first, moved, lambda s: F.flatten(s["out"]))


def pattern_spans(text: Column, pattern: str) -> Column:
    """(start, end, value) of the leftmost non-overlapping matches, none of them empty."""
    found = bound(pieces_and_hits(text, pattern), lambda x: spans_between(x["p"], x["h"]))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def masked(text: Column, pattern: str, good: Callable[[Column], Column]) -> Column:
    """The text with the characters of the pattern's good matches replaced by MASK; lengths stay, and so do older masks."""

    def cover(pieces: Column, hits: Column) -> Column:
        parts = F.transform(
            pieces,
            lambda piece, i: F.concat(
                piece,
                F.coalesce(F.when(good(F.get(hits, i)), F.repeat(F.lit(MASK), F.length(F.get(hits, i)))), F.get(hits, i), F.lit("")),
            ),
        )
        return F.array_join(parts, "")

    covered = bound(pieces_and_hits(text, pattern), lambda x: cover(x["p"], x["h"]))
    return F.when(text.rlike(pattern), covered).otherwise(text)


def value_of(hit: Column) -> Column:
    return F.regexp_extract(hit, VALUE, 1)


def base_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds assign, access and hex: the spans of the fixed patterns."""
    t = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns(
        {
            "assign": F.filter(pattern_spans(t, ASSIGN), lambda s: F.length(value_of(s["value"])) >= 8),
            "access": pattern_spans(t, ACCESS),
            "hex": pattern_spans(t, HEX),
        }
    )


def steps(value: Column) -> Column:
    """Codes of the neighbouring character pairs; null where a character is outside the alphabet."""
    n = len(ALPHABET)

    def pairs(codes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(codes) - 1),
            lambda i: F.get(codes, i - 1) * n + F.get(codes, i),
        )

    codes = F.transform(
        F.split(value, ""), lambda c: F.when(F.instr(F.lit(ALPHABET), c) > 0, F.instr(F.lit(ALPHABET), c) - 1)
    )
    bound = F.transform(F.array(F.filter(codes, lambda c: c.isNotNull())), pairs)
    return F.when(F.length(value) > 1, F.get(bound, F.lit(0))).otherwise(F.array().cast("array<int>"))


def train(df: DataFrame, text: str = "text", key: str = "doc_id", docs: int = TRAIN_DOCS) -> list[float]:
    """Log-likelihood ratios of character pairs, random against ordinary.

    Labelled samples: values that the fixed patterns find are random; words of four to
    forty letters, digits and underscores outside them are ordinary. About ``docs``
    documents of either kind train the models, found among ``SEARCH`` times as many.
    Half of the random model is the uniform one, so any even mix of characters counts.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    place = F.pmod(F.xxhash64(key), F.lit(1_000_000))
    searched = min(1_000_000, 1_000_000 * SEARCH * docs // max(1, df.count()) + 1)
    rows = df.select(place.alias("h"), t.alias("t")).where(F.col("h") < searched)
    hits = F.col("t").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")
    n_hits, n = rows.agg(F.count_if(hits), F.count("*")).first()

    def upto(found: int) -> int:
        """The hash below which about ``docs`` of so many documents lie; no text leaves its task."""
        return searched if found <= docs else searched * docs // found

    marked = rows.where(hits & (F.col("h") < upto(n_hits)))
    plain = rows.where(~hits & (F.col("h") < upto(n - n_hits)))
    found = base_spans(marked, "t").select(
        F.explode(
            F.concat(
                F.transform("assign", lambda s: value_of(s["value"])),
                F.transform("access", lambda s: s["value"]),
                F.transform("hex", lambda s: s["value"]),
            )
        ).alias("v")
    )
    words = plain.select(F.explode(F.regexp_extract_all("t", F.lit(r"[A-Za-z0-9_]{4,40}"), F.lit(0))).alias("v"))
    n = len(ALPHABET)
    models = []
    for sample, uniform in ((found, 0.5), (words, 0.0)):
        rows_ = sample.select(F.explode(steps(F.col("v"))).alias("c")).groupBy("c").count().collect()  # n * n rows at most
        counts = Counter({r["c"]: r["count"] for r in rows_})
        model = []
        for a in range(n):
            total = sum(counts[a * n + b] for b in range(n))
            model += [
                math.log(uniform / n + (1 - uniform) * (counts[a * n + b] + 0.5) / (total + 0.5 * n)) for b in range(n)
            ]
        models.append(model)
    return [r - o for r, o in zip(*models, strict=True)]


def likely(value: Column, model: list[float], min_ratio: float = MIN_RATIO, min_total: float = MIN_TOTAL) -> Column:
    """Whether the log-likelihood ratio of a string's steps is large enough."""
    scores = F.from_json(F.lit(json.dumps([round(x, 6) for x in model])), "array<double>")
    total = F.aggregate(steps(value), F.lit(0.0), lambda a, c: a + F.get(scores, c))
    return total >= F.greatest(F.lit(float(min_total)), min_ratio * (F.length(value) - 1))


def scan_secrets(
    df: DataFrame, model: list[float], text: str = "text", min_run: int = MIN_RUN, min_ratio: float = MIN_RATIO, min_total: float = MIN_TOTAL
) -> DataFrame:
    """Adds the spans by kind: assign, access, hex, and random for what the models add."""
    apart = f"(?<![{MASK}{RUN_CLASS[1:-1]}]){RUN_CLASS}{{{min_run},}}+(?!{MASK})"

    def secret(s: Column) -> Column:
        return s["value"].rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]|[a-z].*[A-Z]") & likely(s["value"], model, min_ratio, min_total)

    def runs(hidden: Column, patterns: Sequence[tuple[str, Callable[[Column], Column]]]) -> Column:
        """The runs of a text from which the patterns are yet to be hidden, each step worked out once."""
        if not patterns:
            return pattern_spans(hidden, apart)
        return bound(masked(hidden, *patterns[0]), lambda t: runs(t, patterns[1:]))

    # Some other character that ends a run and is part of no pattern in place of the mask's own.
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), MASK, "\x02")
    hide = [(ASSIGN, lambda hit: F.length(value_of(hit)) >= 8), (ACCESS, F.isnotnull), (HEX, F.isnotnull)]
    # A run that touches a found span is none of its own; spans begin and end with what ends no run.
    found = bound(clean, lambda t: runs(t, hide))
    return base_spans(df, text).withColumn("random", F.filter(found, secret))


def span_list(*kinds: str) -> Column:
    """kind:start:end of all spans by start and then kind, joined by commas."""

    def named(i: int, kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(s["start"].alias("s"), F.lit(i).alias("k"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("v")),
        )

    parts = [named(i, kind) for i, kind in enumerate(kinds)]
    return F.array_join(F.transform(F.sort_array(F.concat(*parts)), lambda x: x["v"]), ",")


@query("op10_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_secrets(docs, train(docs)).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(span_list(*KINDS[:3]), 256).alias("base_sha256"),
        span_list(*KINDS).alias("spans"),
    )
