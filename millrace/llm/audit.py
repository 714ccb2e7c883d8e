"""How filters interact: one pass over a sparse document-term matrix, then sums over all orders.

``document_terms`` deals the documents into shards of some megabytes. A shard is a CSR matrix: the terms of
each document and their counts, with the shard's own dictionary. It comes in pieces, rows that each hold a run of its
documents and a run of its dictionary, so that neither Python nor the JVM has to hold it in one array. One shuffle
of these dictionaries by word numbers each distinct word and gives every shard the numbers of its words; a word comes
once per shard, however often it is used, so a common word is no hot key. ``matrix_rows`` puts the numbers into the
shards; the sums of a row and its entries are the words and the distinct words of a document.

``interactions`` applies filters in every order. All it needs is how many documents of a part fail which filters, 32 rows
a part; a fixed table says for each order, step and set of failures what happens there.

Null texts are empty. A null id is smaller than none and equal to none: it fails no test of copies and makes no other
row fail; it has no labels. Rows that repeat an id are documents of their own, and copies of each other only if a smaller
id has the text. Several labels of one id count if any of them is 1. A null source is the empty string. Texts of any length are
taken whole, one document at least to a shard and to a piece. Extra columns are not read. An empty table has no parts, so no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.buffers import SPACE, packed_words, spans_of, text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import shuffle_partitions, written
from millrace.session import scratch_dir

#: Texts of so many bytes make a shard.
SHARD_BYTES = 1 << 24
#: Texts of so many bytes make a piece. Its row in the JVM has less than the half megabyte that G1 gives regions of their own.
PIECE_BYTES = 1 << 18
#: Row groups of the shards' files; a reader holds one of them at a time.
GROUP_BYTES = 1 << 23
FILTERS = "ABCDE"
MARKS = np.isin(np.arange(256), np.frombuffer(b"#$%&*|", np.uint8))
CAPITALS = (np.arange(256) >= 65) & (np.arange(256) <= 90)
#: Keys with more than one row in so many are at most so many keys: they are joined by broadcast.
HOT = 4096

SHARD = (
    "shard bigint, ids array<bigint>, parts array<string>, points array<bigint>, capitals array<bigint>, marked array<boolean>, "
    "hashes array<binary>, row_ends array<bigint>, gaps array<int>, counts array<int>, start int, words array<string>"
)
ROW = "id bigint, part string, n_words bigint, n_distinct bigint, points bigint, capitals bigint, marked boolean, hash binary"


def one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def per_document(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each document has."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return np.diff(total[offsets])


def pieces_of(offsets: np.ndarray) -> list[tuple[int, int]]:
    """(first document, end document) of the pieces."""
    pieces, lo, n = [], 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + PIECE_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        pieces.append((lo, hi))
        lo = hi
    return pieces


def words_of(data: np.ndarray, offsets: np.ndarray, pieces: list[tuple[int, int]]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """How many words each document has; all words in order as terms of one dictionary."""
    sizes, words = [], []
    for lo, hi in pieces:
        part = data[offsets[lo] : offsets[hi]]
        solid = ~SPACE[part]
        starts, ends, doc = spans_of(solid, offsets[lo : hi + 1] - offsets[lo])
        sizes.append(np.bincount(doc, minlength=hi - lo))
        words.append(packed_words(part, solid, ends - starts))
    # Not over a chunked array, whose chunks would come with dictionaries of their own.
    return np.concatenate(sizes), pa.concat_arrays(words).dictionary_encode()


def entries_of(terms: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end of each row, gap and count of each entry) of documents of so many words.

    A row's terms rise; a gap is a term less the one before it in the row, which packs better.
    """
    cell, count = np.unique(np.repeat(np.arange(len(sizes)) * width, sizes) + terms, return_counts=True)
    row_ends = np.searchsorted(cell, np.arange(1, len(sizes) + 1) * width)
    term, row = cell % width, cell // width
    gap = term.copy()
    gap[1:] -= np.where(row[1:] == row[:-1], term[:-1], 0)
    return row_ends, gap.astype(np.int32), count.astype(np.int32)


def terms_of(gaps: np.ndarray, row_of: np.ndarray) -> np.ndarray:
    """The terms of entries from their gaps."""
    total = np.cumsum(gaps, dtype=np.int64)
    before = np.concatenate([[0], total])
    return total - before[np.searchsorted(row_of, row_of)]


def document_terms(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per piece of a shard: its rows of the CSR matrix and what else its documents' texts tell.

    The pieces of a shard have one dictionary; a piece holds the words of it from place ``start``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, _, whole, offsets in text_chunks(batch, "text", SHARD_BYTES):
                pieces = pieces_of(offsets)
                sizes, coded = words_of(whole, offsets, pieces)
                terms, words = coded.indices.to_numpy(), coded.dictionary
                word_ends = np.concatenate([[0], np.cumsum(sizes)])
                # The dictionary is dealt evenly, whichever piece has the words.
                shares = np.arange(len(pieces) + 1) * len(words) // len(pieces)
                for (lo, hi), start, end in zip(pieces, shares[:-1].tolist(), shares[1:].tolist(), strict=True):
                    data, ends = whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                    row_ends, gaps, counts = entries_of(terms[word_ends[lo] : word_ends[hi]], sizes[lo:hi], max(1, len(words)))
                    texts = data.tobytes()
                    hashes = [hashlib.sha256(texts[a:b]).digest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                    columns = [
                        pa.array([number], pa.int64()),
                        one_list(batch.column(0).slice(first + lo, hi - lo)),
                        one_list(batch.column(2).slice(first + lo, hi - lo)),
                        one_list(pa.array(per_document((data & 0xC0) != 0x80, ends))),
                        one_list(pa.array(per_document(CAPITALS[data], ends))),
                        one_list(pa.array(per_document(MARKS[data], ends) > 0)),
                        one_list(pa.array(hashes, pa.binary())),
                        one_list(pa.array(row_ends, pa.int64())),
                        one_list(pa.array(gaps)),
                        one_list(pa.array(counts)),
                        pa.array([start], pa.int32()),
                        one_list(words.slice(start, end - start).cast(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SHARD.split(", ")])
                number += 1

    chosen = df.select(df[key].cast("bigint").alias("id"), df[text].alias("text"), F.coalesce(df[part], F.lit("")).cast("string").alias("part"))
    return chosen.mapInArrow(run, SHARD)


def number_words(words: DataFrame) -> DataFrame:
    """(shard, place, term): the global number of each (shard, place, word); a word's rows stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId() << 40, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            word = batch.column(2)
            new = np.ones(n, np.int64)
            new[1:] = pc.not_equal(word.slice(1), word.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = last is None or last != word[0].as_py()
            term = number + np.cumsum(new)
            number, last = int(term[-1]), word[n - 1].as_py()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(term)], ["shard", "place", "term"])

    dealt = words.repartition(shuffle_partitions(words), "word").sortWithinPartitions("word")
    return dealt.mapInArrow(run, "shard bigint, place int, term bigint")


def matrix_rows(shards: DataFrame) -> DataFrame:
    """One row per document from the shards, whose terms get their global numbers on the way."""
    words = shards.select("shard", "start", F.posexplode("words").alias("place", "word"))
    words = words.select("shard", (F.col("start") + F.col("place")).alias("place"), "word")
    matrix = shards.drop("start", "words")

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        term = np.zeros(right.num_rows, np.int64)
        term[right["place"].to_numpy()] = right["term"].to_numpy()
        made = []
        for piece in (batch.slice(row, 1) for batch in left.to_batches() for row in range(batch.num_rows)):
            shard = {name: piece[name].flatten() for name in piece.schema.names if name != "shard"}
            ends = shard["row_ends"].to_numpy()
            row_of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            terms, counts = term[terms_of(shard["gaps"].to_numpy(), row_of)], shard["counts"].to_numpy()
            # Entries of a row are of different terms, as the global numbers are.
            order = np.lexsort((terms, row_of))
            new = np.ones(len(order), bool)
            new[1:] = (terms[order][1:] != terms[order][:-1]) | (row_of[order][1:] != row_of[order][:-1])
            made.append(
                pa.table(
                    {
                        "id": shard["ids"],
                        "part": shard["parts"],
                        "n_words": np.bincount(row_of, counts, len(ends)).astype(np.int64),
                        "n_distinct": np.bincount(row_of[order][new], minlength=len(ends)),
                        "points": shard["points"],
                        "capitals": shard["capitals"],
                        "marked": shard["marked"],
                        "hash": shard["hashes"],
                    }
                )
            )
        return pa.concat_tables(made).combine_chunks()

    return matrix.groupBy("shard").cogroup(number_words(words).groupBy("shard")).applyInArrow(merge, ROW)


def with_first_of_text(rows: DataFrame) -> DataFrame:
    """Adds ``first``, the least id of the row's text; a text that many rows share is joined by broadcast."""
    texts = rows.groupBy("hash").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    texts = written(texts, "texts")
    many = max(1, rows.count() // HOT)
    hot = texts.where(F.col("n") > many).select("hash", "first")  # fewer than HOT rows
    cold = texts.where(F.col("n") <= many).select("hash", "first")
    common = rows.join(F.broadcast(hot), "hash")
    rest = rows.join(F.broadcast(hot), "hash", "left_anti").join(cold, "hash", "left")
    return common.unionByName(rest)


def failures(rows: DataFrame) -> Column:
    """The set of filters a document fails, one bit each, A the lowest."""
    words = F.col("n_words")
    tests = [
        words < 50,
        100 * F.col("n_distinct") < 65 * words,
        100 * F.col("capitals") > 5 * F.col("points"),
        F.col("marked"),
        F.coalesce(F.col("id") > F.col("first"), F.lit(False)),
    ]
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)), F.lit(0)).cast("int")


def step_table(spark: SparkSession) -> DataFrame:
    """What happens to each set of failures at each step of each order: 19,200 rows whatever the data."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[i] for i in order)
        for step, f in enumerate(order, 1):
            before = sum(1 << i for i in order[: step - 1])
            for fails in range(1 << len(FILTERS)):
                gone, here = fails & before, fails >> f & 1
                rows.append((name, step, FILTERS[f], fails, int(not gone and not here), int(not gone and here), int(bool(gone and here)), int(fails == 1 << f)))
    schema = "filter_order string, step int, letter string, fails int, kept int, removed int, redundant int, alone int"
    return spark.createDataFrame(rows, T.StructType.fromDDL(schema))


def interactions(counted: DataFrame) -> DataFrame:
    """The report from (part, fails, n, good, toxic): one row per part, order and step."""
    steps = F.broadcast(step_table(counted.sparkSession))
    n = F.col("n")

    def total(what: Column, name: str) -> Column:
        return F.sum(what).cast("bigint").alias(name)

    # Every part has a row at each step, as each set of failures has.
    made = counted.join(steps, "fails").groupBy("part", "filter_order", "step", "letter").agg(
        total(n * F.col("kept"), "kept"),
        total(n * F.col("removed"), "removed"),
        total(n * F.col("redundant"), "redundant"),
        total(n * F.col("alone"), "unique_fails"),
        total(F.col("good") * F.col("removed"), "good_lost"),
        total(F.col("toxic") * F.col("removed"), "toxic_lost"),
    )
    by_filter = counted.join(steps, "fails").groupBy("part", "letter").agg(total(n * F.col("removed"), "shapley"))
    return made.join(by_filter, ["part", "letter"]).drop("letter")


def audit(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of the five filters over documents (doc_id, text, source) and labels (doc_id, quality, toxic)."""
    path = scratch_dir(df.sparkSession, "shards")
    document_terms(df).write.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).parquet(path)
    rows = written(matrix_rows(df.sparkSession.read.schema(SHARD).parquet(path)), "matrix-rows")
    flagged = with_first_of_text(rows)
    flagged = flagged.select("id", "part", failures(flagged).alias("fails"))
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # Rows without an id have no labels; in the join they would meet in one task.
    marked = flagged.where("id IS NOT NULL").join(known.where("id IS NOT NULL"), "id", "left")
    marked = marked.unionByName(flagged.where("id IS NULL"), allowMissingColumns=True)
    counted = marked.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )
    return interactions(written(counted, "failures"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT part, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM f LEFT JOIN l USING (doc_id)
), x AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, string_split(filter_order[1:step - 1], '') AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
), y AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails[letter] AS here,
         len(list_filter(before, lambda k: k <> '' AND fails[k])) > 0 AS gone,
         len(list_filter(map_values(fails), lambda v: v)) = 1 AS single
  FROM x, steps
), z AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT gone AND NOT here THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND here THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND here THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN here AND single THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND here THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND here THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM y GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM z
"""


@query("op11_filter_audit", SQL)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))
