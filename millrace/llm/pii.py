"""Personal data: fixed patterns, and boosted trees over looser candidates.

The fixed patterns find e-mail and IP addresses, card and phone numbers; these spans always
stay. Generators with high recall propose further, overlapping candidates: anything around
an @ sign, and numbers of seven digits or more, as every run of up to ``GROUPS`` neighbouring digit groups with any common
separator. Boosted trees score a candidate from its format and its context; each kind of candidate has its own
threshold, the least score at which held-out candidates reach the wanted precision. Chosen candidates that overlap
neither fixed spans nor better candidates are added under the kind ``model``, the better first, of equal scores the earlier.

Labels are weak: a candidate with the same digits or address as a fixed span is personal, one apart from all is not, and
one that covers part of a span or more than it teaches nothing. What
defines a fixed span (plus sign, check digit) is no feature, so format and context must
carry the score. Positions are code points, ends exclusive. Null and empty texts have
no spans; texts of any length are taken whole, in time that grows with the length; each row is judged by
itself, repeated ones alike; extra columns stay; a column named ``pii`` is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.buffers import text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import extended

KINDS = ("email", "ip", "card", "phone", "model")
#: Documents and candidates that train the trees.
TRAIN_DOCS = 4000
TRAIN_SPANS = 20_000
#: Neighbouring digit groups that one candidate may join.
GROUPS = 5
PRECISION = 0.98
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMBERS = re.compile(r"(?<![0-9])[0-9](?:[ ().\-/]{0,2}[0-9])++")
DIGITS = re.compile(r"[0-9]++")
AROUND_AT = re.compile(r"(?:(?<=\s)|^)[^\s@]++@[^\s@]++")
HINTS = re.compile(r"(?:mail|phone|tel|call|fax|mobile|card|visa|account|contact|address|ssn|iban|ip)\W*$", re.I | re.A)

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches: each @ takes the local characters before it that no match has used."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return out


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[Span]]:
    """The fixed patterns, each leftmost and non-overlapping, less the matches that fail their test."""
    return {
        "email": emails(text) if "@" in text else [],
        "ip": [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 14 <= len(d := only_digits(m[0])) <= 19 and luhn(d)],
        "phone": [m.span() for m in PHONE.finditer(text) if 10 <= len(only_digits(m[0])) <= 15] if "+" in text else [],
    }


def candidates(text: str) -> list[Span]:
    """Proposals: runs of digit groups with seven digits at least that no letter or digit touches, and strings around an @ sign."""
    found = []
    for m in NUMBERS.finditer(text):
        groups = [g.span() for g in DIGITS.finditer(text, m.start(), m.end())]
        for i, (start, _) in enumerate(groups):
            if i == 0 and text[max(0, start - 1) : start].isalnum():
                continue
            n = 0
            for j in range(i, min(i + GROUPS, len(groups))):
                n += groups[j][1] - groups[j][0]
                if n >= 7 and not text[groups[j][1] : groups[j][1] + 1].isalnum():
                    found.append((start - (text[start - 1 : start] in ("+", "(")), groups[j][1]))
    if "@" in text:
        found += [m.span() for m in AROUND_AT.finditer(text)]
    return sorted(found)


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    start, end = span
    body = text[start:end]
    digits = only_digits(body)
    groups = [len(g) for g in DIGITS.findall(body)]
    before, after = text[max(0, start - 24) : start], text[end : end + 2]
    return [
        len(body),
        len(digits),
        len(groups),
        max(groups, default=0),
        groups[0] if groups else 0,
        groups[-1] if groups else 0,
        body.count("."),
        body.count("-"),
        body.count(" "),
        body.count("(") + body.count(")"),
        body.count("@"),
        body.rfind(".") - body.rfind("@") if "@" in body else 0,
        sum(c.isalpha() for c in body),
        len(set(digits)),
        float(bool(HINTS.search(before))),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in ":=#"),
        float("," in body or "/" in body),
    ]


#: The place of the @ signs among the features.
AT_SIGNS = 10


@dataclass
class Trees:
    """Boosted regression trees of fixed depth: features, cuts and leaves by tree."""

    feature: list[list[int]] = field(default_factory=list)
    cut: list[list[float]] = field(default_factory=list)
    leaf: list[list[float]] = field(default_factory=list)
    start: float = 0.0
    #: Least scores of number candidates and of those around an @ sign; above 1 none is chosen.
    thresholds: tuple[float, float] = (2.0, 2.0)

    @property
    def threshold(self) -> float:
        return min(self.thresholds)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            f, c = np.array(feature), np.array(cut)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            total += np.array(leaf)[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, precision: float = PRECISION, kind: np.ndarray | None = None) -> Trees:
    """Logistic boosting on quantile bins; every third row only calibrates the threshold of its kind, 0 or 1, or both."""
    model = Trees()
    if len(y) < 20 or y.all() or not y.any():
        return model
    hold = np.arange(len(y)) % 3 == 2
    tx, ty = x[~hold], y[~hold].astype(float)
    cuts = [np.unique(np.quantile(tx[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, tx[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    mean = np.clip(ty.mean(), 0.01, 0.99)
    model.start = float(np.log(mean / (1 - mean)))
    total = np.full(len(ty), model.start)
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        grad, hess = ty - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(ty), np.int64)
        feature, cut = [0] * inner, [np.inf] * inner
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            g, h = grad[rows], hess[rows]
            best = 1e-6
            for j, c in enumerate(cuts):
                gs = np.cumsum(np.bincount(binned[rows, j], g, minlength=len(c) + 1))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, j], h, minlength=len(c) + 1))[:-1]
                if len(gs):
                    gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
                    i = int(gain.argmax())
                    if gain[i] > best:
                        best, feature[k], cut[k] = gain[i], j, float(c[i])
            node[rows] = 2 * k + 1 + (tx[rows, feature[k]] > cut[k])
        leaf = [float(RATE * grad[node == inner + i].sum() / (hess[node == inner + i].sum() + 1)) for i in range(inner + 1)]
        total += np.array(leaf)[node - inner]
        model.feature.append(feature)
        model.cut.append(cut)
        model.leaf.append(leaf)
    score, right = model.score(x[hold]), y[hold]
    of = [np.ones(len(right), bool)] * 2 if kind is None else [kind[hold] == k for k in (0, 1)]
    model.thresholds = (threshold(score[of[0]], right[of[0]], precision), threshold(score[of[1]], right[of[1]], precision))
    return model


def threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least score from which on so many of the candidates are right."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
    distinct = np.r_[score[order][1:] != score[order][:-1], np.ones(min(1, len(order)), bool)]
    good = np.flatnonzero((right >= precision) & distinct)
    return float(max(0.5, score[order][good[-1]])) if len(good) else 2.0


class Taken:
    """Spans that do not overlap, in order, asked for overlaps."""

    def __init__(self, spans: list[Span]) -> None:
        self.spans: list[Span] = []
        for start, end in sorted(spans):
            if self.spans and start < self.spans[-1][1]:
                self.spans[-1] = (self.spans[-1][0], max(end, self.spans[-1][1]))
            else:
                self.spans.append((start, end))

    def touches(self, span: Span) -> bool:
        i = bisect_left(self.spans, (span[1], 0)) - 1
        return i >= 0 and self.spans[i][1] > span[0]

    def add(self, span: Span) -> None:
        insort(self.spans, span)


def find_spans(text: str, model: Trees) -> list[tuple[str, int, int, float]]:
    """All spans by start, then kind in the order of KINDS; fixed ones have score 1."""
    base = base_spans(text)
    out = [(s, i, e, 1.0) for i, kind in enumerate(KINDS[:4]) for s, e in base[kind]]
    if model.threshold <= 1:
        taken = Taken([(s, e) for s, _, e, _ in out])
        rest = [c for c in candidates(text) if not taken.touches(c)]
        if rest:
            x = np.array([features(text, c) for c in rest])
            score = model.score(x)
            enough = score >= np.where(x[:, AT_SIGNS] > 0, model.thresholds[1], model.thresholds[0])
            for i in np.argsort(-score, kind="stable"):
                if enough[i] and not taken.touches(rest[i]):
                    taken.add(rest[i])
                    out.append((rest[i][0], 4, rest[i][1], float(score[i])))
    return [(KINDS[k], s, e, p) for s, k, e, p in sorted(out)]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def marked_texts(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, str]]:
    """(row, text) of the documents that hold a digit or an @ sign; others have no spans."""
    column = batch.column(batch.schema.get_field_index(text))
    for lo, _, data, offsets in text_chunks(batch, text):
        mark = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))])
        for i in np.flatnonzero(mark[offsets[1:]] > mark[offsets[:-1]]):
            yield lo + int(i), column[lo + int(i)].as_py()


def find_pii(df: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """All columns, with ``pii`` appended: array of (kind, start, end, score)."""
    base = df.drop("pii")
    schema = extended(base, ("pii", "array<struct<kind:string,start:int,end:int,score:double>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, value in marked_texts(batch, text):
                found[row] = [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find_spans(value, model)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, SPANS)], [*batch.schema.names, "pii"])

    return base.mapInArrow(run, schema)


def weak_labels(text: str) -> Iterator[tuple[Span, bool]]:
    """Candidates that equal a fixed span but for signs at its ends, and those apart from all fixed spans."""
    fixed = [s for spans in base_spans(text).values() for s in spans]
    known = {trimmed(text, s) for s in fixed}
    taken = Taken(fixed)
    for c in candidates(text):
        same = trimmed(text, c) in known
        if same or not taken.touches(c):
            yield c, same


def trimmed(text: str, span: Span) -> Span:
    start, end = span
    while start < end and not text[start].isalnum():
        start += 1
    while start < end and not text[end - 1].isalnum():
        end -= 1
    return start, end


def train_on(df: DataFrame, key: str = "doc_id", text: str = "text", docs: int = TRAIN_DOCS, spans: int = TRAIN_SPANS) -> Trees:
    """Trees from about ``docs`` documents, by hash, and at most ``spans`` of their candidates; no text leaves its task."""
    rows = df.where(F.col(text).rlike("[0-9@]"))
    spread = F.abs(F.xxhash64(key) % 1_000_000)
    share = min(1.0, 1.0 * docs / max(1, df.count()))
    few = rows.where(spread <= 1_000_000 * share).select(spread.alias("h"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[float]] = []
            label: list[bool] = []
            at: list[int] = []
            for h, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for c, personal in weak_labels(value):
                    out.append(features(value, c))
                    label.append(personal)
                    at.append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(out, pa.list_(pa.float64())), pa.array(label, pa.bool_())], ["h", "x", "y"]
            )

    found = few.mapInArrow(run, "h bigint, x array<double>, y boolean").orderBy("h", "x").limit(spans).collect()
    if not found:
        return Trees()
    x = np.array([r["x"] for r in found])
    return fit_trees(x, np.array([r["y"] for r in found]), kind=(x[:, AT_SIGNS] > 0).astype(int))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The text with every span in ``pii`` replaced by its kind in brackets; null stays null."""
    t = F.col(text)

    def step(state: Column, s: Column) -> Column:
        # Overlapping spans: only what lies beyond the last end is left in between.
        gap = F.substring(t, state["at"] + 1, F.greatest(F.lit(0), s["start"] - state["at"]))
        name = F.when(s["end"] > state["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], F.array(F.concat(gap, name))).alias("out")
        )

    joined = F.aggregate(
        "pii",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        step,
        lambda s: F.concat(F.array_join(s["out"], ""), F.substring(t, s["at"] + 1, F.length(t))),
    )
    return df.withColumn(text, F.when(F.size("pii") > 0, joined).otherwise(t))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op9_pii")
def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, train_on(docs)).drop("text")

    def of(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[of(k) for k in KINDS[:4]],
        F.sha2(span_list(F.filter("pii", lambda s: s["kind"] != KINDS[4])), 256).alias("base_sha256"),
        span_list(F.col("pii")).alias("spans"),
    )
