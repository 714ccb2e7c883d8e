"""Line deduplication by a segment-partition edit join.

Lines are split at \\n and ordered by document id and place. A line with a word goes if an
earlier line has the same bytes, or if both have at least ``MIN_BYTES`` bytes and an earlier line
lies within the edits (insert, delete, replace a code point) that ``STEPS`` allow the shorter of both. A caller
may fix the number of edits instead; these are then edits of bytes. Lines of white space stay.

Each line is cut into one segment more than the edits allowed; a near line of the
same length or up to that many bytes longer must hold one of the segments unchanged
near its place. Segments and the substrings to probe, aware of both lengths, become hash
keys; lines that meet under a key are compared by a banded bit-parallel automaton, all pairs of a
batch at once, after a test on byte counts. Only the later line of a pair is emitted. Keys
with many lines are split into blocks that meet pairwise.

Null texts stay null, empty texts stay empty. Repeated rows: ids order them only as long
as they differ, so of rows with the same id and place one is kept and the others are the same place.
Rows with a null id are left as they are and compared with nothing. Extra columns stay; columns
named n_lines, n_removed and n_near are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.buffers import SPACE, U64, mix, prefix_hash, span_hash, text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import crowds, paired_blocks, shuffle_partitions, whole_groups, written

#: (code points, edits): lines of at least so many may differ by so many edits.
STEPS = ((0, 1), (40, 2))
MIN_BYTES = 40
#: Lines under one key that meet another such block in one task.
BLOCK = 4096
PAIRS = 1 << 14
INDEX, PROBE = 1, 2


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, number in it, start, end) of the lines that hold a word."""
    ends = np.flatnonzero(data == 10)
    doc = np.searchsorted(offsets, ends, "right") - 1
    last = np.arange(len(offsets) - 1)
    ends, doc = np.concatenate([ends, offsets[1:]]), np.concatenate([doc, last])
    order = np.lexsort((ends, doc))
    ends, doc = ends[order], doc[order]
    first = np.searchsorted(doc, last)
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1] + 1
    starts[first] = offsets[:-1]
    number = np.arange(len(ends)) - first[doc]
    solid = np.concatenate([[0], np.cumsum(~SPACE[data])])
    keep = solid[ends] > solid[starts]
    return doc[keep], number[keep], starts[keep], ends[keep]


def segments(length: np.ndarray, edits: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the i-th of edits + 1 even segments; the longer ones come last."""
    size, more = length // (edits + 1), length % (edits + 1)
    short = edits + 1 - more
    return i * size + np.maximum(0, i - short), size + (i >= short)


def allowed(length: np.ndarray, steps: tuple[tuple[int, int], ...]) -> np.ndarray:
    """The edits for pairs whose shorter line has these lengths."""
    out = np.zeros(len(length), np.int64)
    for least, edits in steps:
        out[length >= least] = edits
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(code points before each byte, first byte of each code point and the end); nothing where they are the bytes."""
    lead = (data & 0xC0) != 0x80
    if (data < 128).all():
        return None
    return np.r_[0, np.cumsum(lead)], np.r_[np.flatnonzero(lead), len(data)]


def as_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number per code point, the bytes of its encoding, and the offsets among these."""
    found = code_points(data)
    if found is None:
        return data, offsets
    index, place = found
    at, size = place[:-1], np.diff(place)
    codes = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = size > k
        codes[more] = (codes[more] << np.uint32(8)) | data[at[more] + k]
    return codes, index[offsets]


def segment_keys(
    prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: tuple[tuple[int, int], ...], first_byte: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(key, line, role) of every segment and probe; starts and ends count code points where first_byte is given."""
    length = ends - starts
    numbers = sorted({edits for _, edits in steps})
    for shorter in range(numbers[-1] + 1):
        limit = allowed(length - shorter, steps)
        for edits in numbers:
            every = np.flatnonzero(limit == edits)
            if shorter > edits or not len(every):
                continue
            other, begin, end = length[every] - shorter, starts[every], ends[every]
            for i in range(edits + 1):
                place, size = segments(other, edits, i)
                tag = mix(other.astype(U64) * U64(64) + U64(i))
                low = max(-i, shorter - (edits - i))
                high = min(i, shorter + (edits - i))
                for shift in range(low, high + 1):
                    at = begin + place + shift
                    good = (place + shift >= 0) & (at + size <= end)
                    a, b = at[good], (at + size)[good]
                    if first_byte is not None:
                        a, b = first_byte[a], first_byte[b]
                    key = mix(span_hash(prefix, a, b) ^ tag[good])
                    own = shorter == 0 and shift == 0
                    yield key, every[good], INDEX | PROBE if own else PROBE


def line_table(df: DataFrame) -> DataFrame:
    """(h, id, no) of every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, "text"):
                doc, number, starts, ends = line_spans(data, offsets)
                h = span_hash(prefix_hash(data), starts, ends).view(np.int64)
                owner = batch.column(0).slice(lo, hi - lo).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([pa.array(h), owner, pa.array(number, pa.int64())], ["h", "id", "no"])

    return df.mapInArrow(run, "h bigint, id bigint, no bigint")


def key_table(df: DataFrame, steps: tuple[tuple[int, int], ...], min_bytes: int, chars: bool) -> DataFrame:
    """(k, h, role): keys of the distinct lines of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch, "text"):
                _, _, starts, ends = line_spans(data, offsets)
                long = ends - starts >= min_bytes
                starts, ends = starts[long], ends[long]
                prefix = prefix_hash(data)
                h, first = np.unique(span_hash(prefix, starts, ends), return_index=True)
                starts, ends, first_byte = starts[first], ends[first], None
                if chars and (found := code_points(data)) is not None:
                    starts, ends, first_byte = found[0][starts], found[0][ends], found[1]
                for key, line, role in segment_keys(prefix, starts, ends, steps, first_byte):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(h[line].view(np.int64)), pa.array(np.full(len(key), role, np.int8))], ["k", "h", "role"]
                    )

    return df.mapInArrow(run, "k bigint, h bigint, role tinyint")


def meetings(keys: DataFrame) -> DataFrame:
    """The rows of keys under which an indexed line meets another line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["k"]):
            k, h, role = (rows[c].to_numpy() for c in ("k", "h", "role"))
            new = np.r_[True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])]
            start = np.flatnonzero(new)
            both = np.bitwise_or.reduceat(role, start)
            k, h = k[start], h[start]
            group = np.cumsum(np.r_[True, k[1:] != k[:-1]]) - 1
            size = np.bincount(group)
            indexed = np.bincount(group, both & INDEX)
            keep = ((size > 1) & (indexed > 0))[group]
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(h[keep]), pa.array(both[keep])], ["k", "h", "role"])

    n = shuffle_partitions(keys)
    return keys.repartition(n, "k").sortWithinPartitions("k", "h").mapInArrow(run, "k bigint, h bigint, role tinyint")


def within(x: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_size: np.ndarray, edits: int) -> np.ndarray:
    """Whether each pair of padded rows lies within so many edits.

    One automaton per number of edits; bit b of a state stands for a diagonal, ``edits`` of them
    on either side. A match or replacement keeps the bit, an insertion moves it down, a deletion up.
    """
    n, band = len(x), 2 * edits + 1
    full = (1 << band) - 1
    state = [np.full(n, sum(1 << (edits + i) for i in range(d + 1)) & full, np.uint32) for d in range(edits + 1)]
    result = np.zeros(n, bool)
    final = x_size - y_size + edits
    possible = (final >= 0) & (final < band)
    longest = int(y_size.max(initial=0))
    kind = np.uint32 if x.dtype == np.uint32 else np.uint16
    padded = np.zeros((n, edits + max(longest, x.shape[1]) + edits + 1), kind)
    padded[:, edits : edits + x.shape[1]] = x
    padded[:, edits : edits + x.shape[1]][np.arange(x.shape[1])[None, :] < x_size[:, None]] += 1
    cols = np.ascontiguousarray(padded.T)
    text = np.ascontiguousarray(y.T).astype(kind) + kind(1)
    for j in range(longest + 1):
        done = possible & (y_size == j)
        if done.any():
            result[done] = state[edits][done] >> final[done].astype(np.uint32) & 1
        if j == longest:
            break
        equal = np.zeros(n, np.uint32)
        for b in range(band):
            equal |= (cols[j + b] == text[j]).astype(np.uint32) << np.uint32(b)
        before = state[0]
        state[0] = before & equal
        for d in range(1, edits + 1):
            now = (state[d] & equal) | before | (before >> np.uint32(1)) | ((state[d - 1] << np.uint32(1)) & np.uint32(full))
            before, state[d] = state[d], now
    return result


def rows_of(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """Lines as rows of bytes or code points, padded with zeros."""
    at = offsets[rows][:, None] + np.arange(width)[None, :]
    out = data[np.minimum(at, len(data) - 1)]
    out[at >= offsets[rows + 1][:, None]] = 0
    return out


def near_pairs(data: np.ndarray, offsets: np.ndarray, group: np.ndarray, role: np.ndarray, side: np.ndarray, cross: np.ndarray, steps: tuple[tuple[int, int], ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group within the edits of its shorter row; groups are runs, ``cross`` ones pair unequal sides only."""
    size = np.diff(offsets)
    counts = np.zeros((len(size), 32), np.int16)
    np.add.at(counts, (np.repeat(np.arange(len(size)), size), data & 31), 1)
    start = np.searchsorted(group, group)
    longest = int((np.arange(len(group)) - start).max(initial=0))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    total = 0

    def settle() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        a, b = (np.concatenate(p) for p in zip(*held, strict=True))
        limit = allowed(np.minimum(size[a], size[b]), steps)
        for edits in np.unique(limit).tolist():
            order = np.flatnonzero(limit == edits)
            order = order[np.argsort(size[a[order]], kind="stable")]
            for lo in range(0, len(order), PAIRS // 8):
                p, q = a[order[lo : lo + PAIRS // 8]], b[order[lo : lo + PAIRS // 8]]
                width = int(max(size[p].max(), size[q].max()))
                good = within(rows_of(data, offsets, p, width), size[p], rows_of(data, offsets, q, width), size[q], edits)
                yield p[good], q[good]

    for o in range(1, longest + 1):
        a = np.flatnonzero(group[o:] == group[:-o])
        b = a + o
        good = ((role[a] & INDEX) | (role[b] & INDEX)) > 0
        good &= ~cross[a] | (side[a] != side[b])
        good &= np.abs(size[a] - size[b]) <= allowed(np.minimum(size[a], size[b]), steps)
        a, b = a[good], b[good]
        near = np.abs(counts[a] - counts[b]).sum(axis=1) <= 2 * allowed(np.minimum(size[a], size[b]), steps)
        a, b = a[near], b[near]
        if len(a):
            held.append((a, b))
            total += len(a)
        if total >= PAIRS:
            yield from settle()
            held, total = [], 0
    if held:
        yield from settle()


def later_lines(met: DataFrame, steps: tuple[tuple[int, int], ...], chars: bool) -> DataFrame:
    """(h) of lines with an earlier near line; met has (k, lo, hi, own, role, h, id, no, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["k", "lo", "hi"]):
            k, lo, hi, own, role, h, ids, no = (rows[c].to_numpy() for c in ("k", "lo", "hi", "own", "role", "h", "id", "no"))
            lines = rows["line"].combine_chunks().cast(pa.large_binary())
            _, offsets, data = lines.buffers()
            offsets = np.frombuffer(offsets, np.int64, len(lines) + 1, lines.offset * 8)
            data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
            data, offsets = as_codes(data, offsets - offsets[0]) if chars else (data, offsets - offsets[0])
            group = np.cumsum(np.r_[True, (k[1:] != k[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
            found = []
            for a, b in near_pairs(data, offsets, group, role, own, lo != hi, steps):
                after = (ids[a] > ids[b]) | ((ids[a] == ids[b]) & (no[a] > no[b]))
                found.append(np.where(after, h[a], h[b]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["h"])

    n = shuffle_partitions(met)
    key = ["k", "lo", "hi"]
    return met.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(run, "h bigint").distinct()


def cut_lines(texts: DataFrame) -> DataFrame:
    """(h, id, no, line): the wanted lines of each document; wanted is an array of (h, no)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if wanted:
                    lines = text.encode().split(b"\n")
                    out += [(w["h"], doc, w["no"], lines[w["no"]]) for w in wanted]
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["h", "id", "no", "line"]
            )

    return texts.mapInArrow(run, "h bigint, id bigint, no bigint, line binary")


def removals(df: DataFrame, key: str, text: str, edits: int | None, min_bytes: int) -> DataFrame:
    """(id, gone): per document, the (number, near) of lines to remove."""
    steps, chars = (STEPS, True) if edits is None else (((0, edits),), False)
    docs = df.where(df[key].isNotNull()).select(df[key].cast("bigint").alias("id"), df[text].alias("text"))
    lines = line_table(docs)
    first = lines.groupBy("h").agg(F.min(F.struct("id", "no")).alias("f"))
    met = written(meetings(key_table(docs, steps, min_bytes, chars)), "line-keys")
    wanted = met.select("h").distinct().join(first, "h").groupBy(F.col("f.id").alias("_id")).agg(F.collect_list(F.struct("h", "f.no")).alias("wanted"))
    # The same columns by the same key as when the lines are cut out: the texts are dealt once for both.
    placed = df.join(wanted.hint("shuffle_hash"), df[key].cast("bigint") == wanted["_id"], "left")
    found = cut_lines(placed.select("_id", F.when(F.col("wanted").isNotNull(), F.col(text)).alias("text"), "wanted"))
    blocked = paired_blocks(met, ["k"], "h", crowds(met, ["k"], BLOCK))
    late = later_lines(blocked.join(found, "h"), steps, chars).withColumn("near", F.lit(True))
    state = first.join(late, "h", "left")
    return (
        lines.join(state, "h")
        .withColumn("copy", (F.col("f.id") != F.col("id")) | (F.col("f.no") != F.col("no")))
        .where("copy or near")
        .groupBy("id")
        .agg(F.collect_set(F.struct("no", (~F.col("copy")).alias("near"))).alias("gone"))
    )


def dedupe_lines(df: DataFrame, key: str = "doc_id", text: str = "text", edits: int | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """All columns, the text without its removed lines; n_lines, n_removed and n_near appended."""
    base = df.drop("n_lines", "n_removed", "n_near")
    gone = removals(base, key, text, edits, min_bytes)
    gone = gone.select(F.col("id").alias("_id"), F.array_sort(F.transform("gone", lambda g: g["no"])).alias("_no"), F.size(F.filter("gone", lambda g: g["near"])).alias("_near"))
    joined = base.join(gone.hint("shuffle_hash"), base[key].cast("bigint") == gone["_id"], "left")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    marks = F.transform(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.array_contains("_no", i.cast("bigint")))
    kept = F.array_join(F.transform(F.filter(F.arrays_zip(lines.alias("l"), marks.alias("m")), lambda x: ~x["m"]), lambda x: x["l"]), "\n")
    return joined.withColumns(
        {
            "n_lines": F.size(F.filter(lines, lambda x: x.rlike("[^ \\t-\\r]"))).cast("long"),
            "n_removed": F.coalesce(F.size("_no"), F.lit(0)).cast("long"),
            "n_near": F.coalesce("_near", F.lit(0)).cast("long"),
            text: F.when(F.col("_no").isNull(), F.col(text)).otherwise(kept),
        }
    ).drop("_id", "_no", "_near")


@query("op7_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines with a word, lines removed, those of them without an exact copy, and the rest's hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedupe_lines(docs).select("doc_id", "n_lines", "n_removed", "n_near", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
