"""Spelling variants: words one edit apart, joined by pivotal bigrams.

``count_words`` takes runs of letters, drops a letter of some (as the rule of the query says) and counts the
distinct results. ``near_words`` finds every pair of words that one inserted, deleted or replaced code point
sets apart. All bigrams have one order, the rarest first; a word's gram prefix is its first three bigrams in
that order, with all places of the last one's bigram. Dynamic programming chooses two of the first three that
share no letter and are rarest together: the pivots. One edit breaks at most one of them. Of two near words
take the one whose prefix ends earlier in the order: a whole pivot of it stands in the other's prefix, and the
edit lies on one side of it. So the other side is equal in both words and limits the place: the pivots are indexed by the
word up to the pivot's end and by the word from its start, and prefix bigrams look there. Where this leaves fewer
than ``CONTEXT`` letters, one half of the rest is equal too and joins the key, with the length of the rest. Lengths and
a mask of letters filter, and the edit distance decides.

``variant_forms`` gives each word its most frequent near word of at least ten times its count, and follows these to the last.

Null and empty texts have no words. A null id counts as empty text before the colon. Repeated rows count again. Ties between
forms go to the least word in code-point order. Extra columns are not read. An empty table gives no rows.
Words of any length are taken whole; the grams of a batch of words are held at once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.buffers import U64, filled, mix, packed_words, prefix_hash, span_hash, spans_of, text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import crowds, written

#: Texts of so many bytes are counted together in a task.
TEXT_BYTES = 1 << 24
MIN_POINTS = 7
MIN_COUNT = 2
#: One run in so many loses a letter.
DROP_ONE_IN = 31
#: A form is at least so many times as frequent.
FORM_RATIO = 10
#: a-z and U+00C0 to U+00FF, so there are 8,100 bigrams at most.
SYMBOLS = 26 + 64
#: Longer runs are hashed one by one, and longer words go through the join as their SHA-256, as all their grams may be alike.
LONG_RUN = 64
#: Fewer letters on the equal side are joined by half of the other side.
CONTEXT = 6
#: Pivots under one key that meet a block of prefix grams in one task.
BLOCK = 4096
EDITS = 1
PREFIX = 2 * EDITS + 1
SHIFTS = (-1, 0, 1)

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
LETTER = (_byte >= 97) & (_byte <= 122)
#: First byte of U+00C0 to U+00FF.
WIDE = 0xC3


def _crc_table() -> np.ndarray:
    table_ = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table_ = np.where(table_ & 1, (table_ >> np.uint32(1)) ^ np.uint32(0xEDB88320), table_ >> np.uint32(1))
    return table_


CRC = _crc_table()


def run_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of byte runs, each going on from the crc32 of what stands before it."""
    out = begun.astype(np.uint32)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    long = order[: np.searchsorted(-size[order], -LONG_RUN, "left")]
    for i in long.tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(begun[i]))
    order = order[len(long) :]
    at, left = starts[order], size[order]
    state = out[order] ^ np.uint32(0xFFFFFFFF)
    for k in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -k, "left"))
        state[:n] = CRC[(state[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def words_of(ids: list[object], data: np.ndarray, offsets: np.ndarray, min_points: int) -> pa.LargeStringArray:
    """The words of a chunk of documents, in order, those with fewer code points left out."""
    data = LOWER[data]
    wide = data == WIDE
    inside = LETTER[data] | wide
    inside[1:] |= wide[:-1]
    starts, ends, doc = spans_of(inside, offsets)
    before = np.r_[0, np.cumsum(wide)]
    points = ends - starts - (before[ends] - before[starts])
    keep = points >= min_points
    starts, ends, doc, points = starts[keep], ends[keep], doc[keep], points[keep]
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = run_crcs(data, starts, ends, heads[doc]).astype(np.int64)
    hit = np.flatnonzero(crc % DROP_ONE_IN == 0)
    taken, size = filled(starts, ends, len(data)), ends - starts
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    at = lead[np.searchsorted(lead, starts[hit]) + crc[hit] % points[hit]]
    taken[at] = False
    broad = wide[at]
    taken[at[broad] + 1] = False
    size[hit] -= 1 + broad
    points[hit] -= 1
    short = points < min_points
    taken &= ~filled(starts[short], ends[short], len(data))
    return packed_words(data, taken, size[~short])


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", min_points: int = MIN_POINTS) -> DataFrame:
    """(word, n) of all words of the texts; counted per chunk, then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, offsets in text_chunks(batch, "text", TEXT_BYTES):
                found = words_of(ids[lo:hi], data, offsets, min_points).dictionary_encode()
                n = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
                yield pa.RecordBatch.from_arrays([found.dictionary.cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    parts = df.select(df[key].alias("id"), df[text].alias("text")).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, byte offsets, number of each letter, letter offsets) of lower-case words."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(words) + 1, words.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    symbol = data[lead].astype(np.int64) - 97
    broad = data[lead] == WIDE
    symbol[broad] = 26 + data[lead[broad] + 1].astype(np.int64) - 0x80
    return data, offsets, symbol, np.searchsorted(lead, offsets)


def bigrams(symbol: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bigram, word, place in the word) of every bigram."""
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inner = np.flatnonzero(word[1:] == word[:-1])
    return symbol[inner] * SYMBOLS + symbol[inner + 1], word[inner], inner - offsets[word[inner]]


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n): how often each bigram stands in the distinct words; at most SYMBOLS squared rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, symbol, offsets = letters(batch.column(0))
            n = np.bincount(bigrams(symbol, offsets)[0], minlength=1)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], ["gram", "n"])

    return words.select("word").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def pivots_of(place: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the two columns of least total cost whose places lie two apart; places rise along a row.

    The programme goes over the columns: the best single column up to each, and the best pair that ends there.
    """
    rows, width = np.arange(len(place)), place.shape[1]
    one = np.zeros(place.shape, np.int64)
    pair = np.zeros((len(place), 2), np.int64)
    best = np.full(len(place), np.inf)
    for i in range(width):
        if i:
            one[:, i] = np.where(cost[:, i] < cost[rows, one[:, i - 1]], i, one[:, i - 1])
            # The last column that leaves a letter's room is one or two back.
            back = np.where(place[:, i] - place[:, i - 1] >= 2, i - 1, i - 2)
            total = np.where(back >= 0, cost[:, i] + cost[rows, one[rows, np.maximum(back, 0)]], np.inf)
            better = total < best
            best = np.where(better, total, best)
            pair[better] = np.stack([one[rows, np.maximum(back, 0)], np.full(len(place), i)], 1)[better]
    return pair[:, 0], pair[:, 1]


def side_keys(
    prefix: np.ndarray, byte_at: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray, shifts: tuple[int, ...]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entries, keys) of bigrams at letter ``at`` of words from ``begin`` to ``end``.

    ``shifts`` are the lengths, against its own, that the other word's rest may have; the other word knows its own only.
    """

    def spans(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return span_hash(prefix, byte_at[low], byte_at[high])

    for side, low, high in ((0, begin, at + 2), (1, at, end)):
        rest = end - high if side == 0 else low - begin
        whole = np.flatnonzero(high - low >= CONTEXT)
        yield whole, mix(spans(low[whole], high[whole]) ^ U64(side + 1))
        for shift in shifts:
            i = np.flatnonzero((high - low < CONTEXT) & (rest + shift >= 0))
            other = rest[i] + shift
            tag = mix(other.astype(U64) * U64(4) + U64(side))
            half = other // 2
            a, b = (low[i], high[i] + half) if side == 0 else (low[i] - half, high[i])
            yield i, mix(spans(a, b) ^ mix(tag + U64(3)))
            fits = other - half <= rest[i]
            i, far, tag = i[fits], (other - half)[fits], tag[fits]
            c, d = (end[i] - far, end[i]) if side == 0 else (begin[i], begin[i] + far)
            yield i, mix(mix(spans(low[i], high[i]) ^ tag) + spans(c, d))


def references(words: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The words, with long ones as # and their digest, which is no word."""
    long = np.flatnonzero(sizes > LONG_RUN)
    if not len(long):
        return words.cast(pa.string())
    named = words.to_pylist()
    for i in long.tolist():
        named[i] = "#" + hashlib.sha256(named[i].encode()).hexdigest()
    return pa.array(named, pa.string())


def pivot_rows(words: DataFrame, order: dict[int, tuple[int, int]], pivots: bool) -> DataFrame:
    """(key, last, mask, size, word, n) of the pivots, or of the prefix grams; long words as references.

    ``order`` gives each bigram its rank and count.
    """
    rank_of, cost_of = np.zeros(SYMBOLS**2, np.int64), np.zeros(SYMBOLS**2, np.float64)
    for gram, (rank, count) in order.items():
        rank_of[gram], cost_of[gram] = rank, count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, byte_at, symbol, offsets = letters(batch.column(0))
            gram, word, place = bigrams(symbol, offsets)
            rank = rank_of[gram]
            by = np.lexsort((place, rank, word))
            gram, word, place, rank = gram[by], word[by], place[by], rank[by]
            first = np.searchsorted(word, np.arange(batch.num_rows))
            last = rank[first + PREFIX - 1]
            if pivots:
                three = first[:, None] + np.arange(PREFIX)
                three = np.take_along_axis(three, np.argsort(place[three], axis=1), 1)
                a, b = pivots_of(place[three], cost_of[gram[three]])
                rows = np.arange(batch.num_rows)
                chosen = np.r_[three[rows, a], three[rows, b]]
            else:
                chosen = np.flatnonzero(rank <= last[word])
            owner, at = word[chosen], offsets[word[chosen]] + place[chosen]
            starts = np.r_[np.flatnonzero((data & 0xC0) != 0x80), len(data)]
            made = list(side_keys(prefix_hash(data), starts, offsets[owner], offsets[owner + 1], at, SHIFTS if pivots else (0,)))
            owner, key = owner[np.concatenate([i for i, _ in made])], np.concatenate([k for _, k in made])
            masks = np.bitwise_or.reduceat(U64(1) << (symbol % 64).astype(U64), offsets[:-1]).view(np.int64)
            sizes = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(last[owner].astype(np.int16)),
                    pa.array(masks[owner]),
                    pa.array(sizes[owner].astype(np.int32)),
                    references(batch.column(0), sizes).take(pa.array(owner)),
                    batch.column(1).take(pa.array(owner)),
                ],
                ["key", "last", "mask", "size", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(run, "key bigint, last smallint, mask bigint, size int, word string, n bigint")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): both directions of every pair of words one edit apart.

    Words of at least MIN_POINTS letters of the alphabet above, each once; any letter of the long tail may repeat.
    """
    counted = sorted((r["n"], r["gram"]) for r in gram_counts(words).collect())  # 8,100 at most
    order = {gram: (rank, n) for rank, (n, gram) in enumerate(counted)}
    pivots, grams = pivot_rows(words, order, True), pivot_rows(words, order, False)
    large = written(crowds(pivots, ["key"], BLOCK), "pivot-crowds")
    large = large.withColumnRenamed("n", "blocks")
    pivots = (
        pivots.join(large, "key", "left")
        .withColumn("block", F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int"))
        .drop("blocks")
    )
    grams = (
        grams.join(large, "key", "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .drop("blocks")
    )
    p, g = pivots.alias("p"), grams.alias("g")
    long = F.greatest("p.size", "g.size") > LONG_RUN
    met = p.join(
        g,
        (F.col("p.key") == F.col("g.key"))
        & (F.col("p.block") == F.col("g.block"))
        & (F.col("p.last") <= F.col("g.last"))
        & (F.abs(F.col("p.size") - F.col("g.size")) <= EDITS)
        & (F.bit_count(F.col("p.mask").bitwiseXOR(F.col("g.mask"))) <= 2 * EDITS)
        & (F.col("p.word") != F.col("g.word"))
        & (long | (F.levenshtein("p.word", "g.word", EDITS) == EDITS)),
    )
    ahead = F.col("p.word") < F.col("g.word")

    def ordered(name: str, low: str, high: str) -> list:
        return [
            F.when(ahead, F.col(f"p.{name}")).otherwise(F.col(f"g.{name}")).alias(low),
            F.when(ahead, F.col(f"g.{name}")).otherwise(F.col(f"p.{name}")).alias(high),
        ]

    pairs = written(met.select(*ordered("word", "a", "b"), *ordered("n", "a_n", "b_n"), long.alias("long")).distinct(), "near-pairs")
    names = words.where(F.length("word") > LONG_RUN).select(F.concat(F.lit("#"), F.sha2("word", 256)).alias("ref"), "word")
    kept = pairs.where(pairs["long"])
    for side in ("a", "b"):
        named = names.select(F.col("ref").alias(side), F.col("word").alias("whole"))
        kept = kept.join(named, side, "left").withColumn(side, F.coalesce("whole", side)).drop("whole")
    kept = kept.where(F.levenshtein("a", "b", EDITS) == EDITS)
    pairs = pairs.where(~pairs["long"]).unionByName(kept).drop("long")
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for links (word, form): counts rise tenfold along them, so a few doublings reach the end."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left")
        after = written(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variant_forms(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the table of words and counts."""
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = written(near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "near-words")
    joined = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.less") >= FORM_RATIO * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("f"),
    )
    joined = written(joined.select("word", "n", "n_near", "f.form", "f.form_n"), "forms")
    found = roots(joined.where("form IS NOT NULL"))
    return joined.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("form_n").cast("bigint").alias("form_n")
    )


@query("op13_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = written(count_words(docs).where(F.col("n") >= MIN_COUNT), "words")
    return variant_forms(words)
