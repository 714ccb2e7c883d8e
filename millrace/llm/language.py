"""Language identification by a small byte convolutional network, trained in numpy.

Filters of two, three and four bytes slide over fixed windows of the UTF-8 text, each
filter keeps its largest response, and a softmax layer turns the responses into
language probabilities. A text's probabilities are the mean over all its windows,
weighted by their letters; nothing but the text enters a prediction.

``und`` with score 0 is returned for null texts, texts without a letter, and where no
labelled row was there to learn from. Tied classes go to the first name. Each row is judged by itself, so
repeated rows get equal results. Texts of any length are read whole, window by window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.buffers import text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import extended

#: Labelled documents of each language that train the network, and the characters taken of each.
LANGUAGE_DOCS = 750
EXCERPT = 2048
WINDOW = 512
FILTERS = 8
STEPS = 700
BATCH = 64
#: Letters of either case share a class, other ASCII is one class, high bytes stay apart.
CLASSES = np.zeros(256, np.uint8)
for _i in range(26):
    CLASSES[[65 + _i, 97 + _i]] = 1 + _i
CLASSES[128:] = 27 + np.arange(128)
# Accented Latin capitals are 32 below their small letters, as in ASCII.
CLASSES[128:160] = CLASSES[160:192]
N_CLASSES = 155


@dataclass
class ByteNet:
    """Weights: taps (9, classes, filters) of widths 2, 3 and 4; bias and softmax layer."""

    langs: list[str]
    taps: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """Responses of byte pairs: a wider filter is a sum of two look-ups."""
        t = self.taps
        pair = [(t[a][:, None, :] + t[b][None, :, :]).reshape(-1, FILTERS) for a, b in ((0, 1), (2, 3), (5, 6), (7, 8))]
        return [pair[0], pair[1], t[4], pair[2], pair[3]]

    def pooled(self, windows: np.ndarray, tables: list[np.ndarray], where: bool = False) -> tuple[np.ndarray, ...]:
        """Largest response of every filter in each window, and its place if asked for."""
        x = np.ascontiguousarray(windows.T).astype(np.intp)  # positions first: reductions run over whole rows
        pairs = x[:-1] * N_CLASSES + x[1:]
        two, three, last, head, tail = tables
        found, places = [], []
        for near, far, ahead in ((two, None, 0), (three, last, x[2:]), (head, tail, pairs[2:])):
            if far is None:
                y = np.take(near, pairs, axis=0)
            else:
                y = np.take(near, pairs[: len(ahead)], axis=0)
                y += np.take(far, ahead, axis=0)
            found.append(y.max(axis=0))
            if where:
                places.append(y.argmax(axis=0))
        return (np.concatenate(found, axis=1), *places)

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        z = np.tanh(features) @ self.out + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows of byte classes, document of each): all bytes, the last window padded."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // WINDOW))
    base = np.concatenate([[0], np.cumsum(count)])
    flat = np.zeros(int(base[-1]) * WINDOW, np.uint8)
    at = np.arange(len(data)) + np.repeat(base[:-1] * WINDOW - offsets[:-1], sizes)
    flat[at] = CLASSES[data]
    return flat.reshape(-1, WINDOW), np.repeat(np.arange(len(sizes)), count)


def train_net(texts: list[str], langs: list[str], seed: int = 7) -> ByteNet | None:
    """Adam on windows of random length, so that short texts are learned too."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    windows, doc = cut_windows(np.frombuffer(b"".join(raw), np.uint8), offsets)
    label = np.array([names.index(x) for x in langs])[doc]
    known = windows.any(axis=1)
    windows, label = windows[known], label[known]
    net = ByteNet(
        names,
        rng.normal(0, 0.3, (9, N_CLASSES, FILTERS)).astype(np.float32),
        rng.normal(0, 0.3, (3 * FILTERS, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    if not len(windows):
        return net
    share = np.bincount(label, minlength=len(names)) / len(label)
    weight = (1 / np.maximum(share, 1e-3)) ** 0.5
    params = [net.taps, net.out, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    taps_of, filters = ((0, 1), (2, 3, 4), (5, 6, 7, 8)), np.arange(FILTERS)
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(windows), BATCH)
        x, y = windows[pick].copy(), label[pick]
        keep = np.where(rng.random(BATCH) < 0.5, WINDOW, rng.integers(12, WINDOW, BATCH))
        x[np.arange(WINDOW)[None, :] >= keep[:, None]] = 0
        features, *places = net.pooled(x, net.tables(), where=True)
        h, p = np.tanh(features), net.probabilities(features)
        p[np.arange(BATCH), y] -= 1
        p *= (weight[y] / BATCH)[:, None]
        back = (p @ net.out.T) * (1 - h * h)
        grads = [np.zeros_like(net.taps), h.T @ p, p.sum(axis=0)]
        for k, taps in enumerate(taps_of):
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            for j, tap in enumerate(taps):
                byte = np.take_along_axis(x, places[k] + j, axis=1)
                np.add.at(grads[0][tap], (byte, np.broadcast_to(filters, byte.shape)), part)
        rate = 0.01 * (1 - step / (STEPS + 1))
        for value, grad, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def labelled_sample(df: DataFrame, learn: Column, key: str, text: str, lang: str, docs: int) -> tuple[list[str], list[str]]:
    """At most ``docs`` labelled texts of each language, by the hash of the key, an excerpt of each.

    A language is drawn from by its own number of rows, so a rare one is learned as well.
    """
    rows = df.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    spread = F.abs(F.xxhash64(key) % 1_000_000)
    sizes = rows.groupBy(F.col(lang).alias("_lang")).agg((2_000_000.0 * docs / F.count("*")).alias("_upto"))
    start = 1 + F.pmod(F.xxhash64(key, F.lit(1)), F.greatest(F.lit(1), F.length(text) - EXCERPT).cast("long"))
    chosen = rows.join(F.broadcast(sizes), F.col(lang) == F.col("_lang")).where(spread <= F.col("_upto"))
    excerpts = chosen.select(
        spread.alias("h"), F.col(key).alias("k"), F.substring(F.col(text), start.cast("int"), F.lit(EXCERPT)).alias("t"), F.col(lang).alias("l")
    )
    place = F.row_number().over(Window.partitionBy("l").orderBy("h", "k", "t"))
    found = excerpts.withColumn("place", place).where(F.col("place") <= docs).orderBy("h", "k", "l", "t").collect()
    return [r["t"] for r in found], [r["l"] for r in found]


def has_letter(data: np.ndarray) -> bool:
    if ((CLASSES[data] > 0) & (CLASSES[data] < 27)).any():
        return True
    return bool((data > 127).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def predict(net: ByteNet | None, data: np.ndarray, offsets: np.ndarray, step: int = 64) -> tuple[list[str], np.ndarray]:
    """Language and score of each document of a buffer."""
    n = len(offsets) - 1
    names, scores = ["und"] * n, np.zeros(n)
    if net is None:
        return names, scores
    tables = net.tables()
    windows, doc = cut_windows(data, offsets)
    letters = np.count_nonzero(windows, axis=1)
    total = np.zeros((n, len(net.langs)))
    for lo in range(0, len(windows), step):
        part = windows[lo : lo + step]
        p = net.probabilities(net.pooled(part, tables)[0]) * letters[lo : lo + step, None]
        np.add.at(total, doc[lo : lo + step], p)
    ascii_letters = np.bincount(doc, ((windows > 0) & (windows < 27)).sum(axis=1), minlength=n)
    for i in np.flatnonzero(total.sum(axis=1) > 0):
        if ascii_letters[i] or has_letter(data[offsets[i] : offsets[i + 1]]):
            best = int(total[i].argmax())
            names[i], scores[i] = net.langs[best], min(1.0, total[i, best] / total[i].sum())
    return names, scores


def identify(df: DataFrame, net: ByteNet | None, text: str = "text") -> DataFrame:
    """All columns, with lang_pred and score appended (columns of these names are replaced)."""
    base = df.drop("lang_pred", "score")
    schema = extended(base, ("lang_pred", "string"), ("score", "double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[str] = []
            scores: list[np.ndarray] = []
            for _, _, data, offsets in text_chunks(batch, text):
                some, score = predict(net, data, offsets)
                names += some
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return base.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1


def train_on(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", docs: int = LANGUAGE_DOCS) -> ByteNet | None:
    return train_net(*labelled_sample(df, learn, key, text, lang, docs))


@query("op8_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train_on(docs, ~F.coalesce(held_out(), F.lit(False)))
    return identify(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
