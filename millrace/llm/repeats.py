"""Removal of every byte that lies in a 200-byte string found at a second place.

A sparse suffix array: of the suffixes of all texts only those are sorted that start at an
anchor, the least of 153 neighbouring 48-byte hashes. Any 200 bytes hold the anchor of
exactly such a window, and the same bytes choose the same anchor wherever they stand, so no repeat is
missed. Sampled splitters range-partition the suffixes by their leading eight bytes and the
hash of their leading 48; each bucket is sorted locally by these and then by the hash of all
the bytes around the anchor that a 200-byte string through it can reach. The splitters cut between different
leading tokens, so equal ones never lie on both sides of a border.

Suffixes with equal surroundings repeat all 200-byte strings through the anchor. Where the surroundings
differ, the strings themselves are compared: those of one leading token and one place relative to the anchor meet
by hash. Equal strings are judged by 64-bit hashes within one 48-byte token, 128 bits together.

Copies within a chunk of texts are settled there and send one suffix on, which keeps large groups of
copies small. Null texts are empty. Repeated rows are copies of each other. Rows with a null id are left as
they are. Extra columns stay; columns named kept and removed are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.buffers import U64, mix, powers, prefix_hash, runs, span_hash, text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import crowds, extended, paired_blocks, shuffle_partitions, whole_groups, written

LENGTH = 200
TOKEN = 48
#: Suffixes of one token, with different surroundings, that meet another such block in one task.
CROWD = 8192
_SIDE = LENGTH - TOKEN
_NONE = U64(2**64 - 1)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values, by running minima within blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, _NONE, U64)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def gram_hashes(prefix: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all strings of this length, by their start."""
    n = len(prefix) - length
    return mix((prefix[length:] - prefix[:n]) * powers(len(prefix))[1][:n] + U64(length)) if n > 0 else np.zeros(0, U64)


def anchors(prefix: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, token hash) of the anchors of all documents of a buffer."""
    grams = gram_hashes(prefix, TOKEN)
    width = LENGTH - TOKEN + 1
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    bits = U64(max(1, int(len(grams)).bit_length()))
    mask = (U64(1) << bits) - U64(1)
    least = window_minima((grams & ~mask) | np.arange(len(grams), dtype=U64), width)
    # Windows count if their 200 bytes lie within one document.
    size = np.diff(offsets)
    edge = np.zeros(len(least) + 1, np.int32)
    full = size >= LENGTH
    np.add.at(edge, offsets[:-1][full], 1)
    np.add.at(edge, offsets[1:][full] - LENGTH + 1, -1)
    place = (least & mask)[np.cumsum(edge[:-1]) > 0].astype(np.int64)
    place = np.unique(place[np.r_[True, place[1:] != place[:-1]]]) if len(place) else place
    return place, grams[place]


def suffixes(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The anchors' sort columns, surroundings and copies within the buffer."""
    prefix = prefix_hash(data)
    place, token = anchors(prefix, offsets)
    doc = np.searchsorted(offsets, place, "right") - 1
    lo = np.maximum(offsets[doc], place - _SIDE)
    hi = np.minimum(offsets[doc + 1], place + LENGTH)
    around = mix(span_hash(prefix, lo, hi) + (place - lo).astype(U64))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lead = np.zeros(len(place), U64)
    for k in range(8):
        lead = (lead << U64(8)) | padded[place + k].astype(U64)
    order = np.lexsort((around, token))
    start, end = runs(mix(token ^ (around * U64(3)))[order])
    copies = np.empty(len(place), np.int64)
    copies[order] = np.repeat(end - start, end - start)
    first = np.zeros(len(place), bool)
    first[order[start]] = True
    return {"doc": doc, "place": place, "lo": lo, "hi": hi, "lead": lead ^ U64(1 << 63), "token": token, "around": around, "copies": copies, "first": first}


def suffix_table(docs: DataFrame) -> DataFrame:
    """(lead, token, around, id, at, done): one row for each anchor whose surroundings are new to its chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, "text"):
                s = suffixes(data, offsets)
                keep = s["first"]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(s[c][keep].view(np.int64)) for c in ("lead", "token", "around")),
                     batch.column(0).slice(lo, hi - lo).take(pa.array(s["doc"][keep])),
                     pa.array((s["place"] - offsets[s["doc"]])[keep].astype(np.int32)), pa.array(s["copies"][keep] > 1)],
                    ["lead", "token", "around", "id", "at", "done"],
                )

    return docs.mapInArrow(run, "lead bigint, token bigint, around bigint, id bigint, at int, done boolean")


def chunk_spans(docs: DataFrame) -> DataFrame:
    """(id, lo, hi) of what copies within a chunk cover, runs joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch, "text"):
                s = suffixes(data, offsets)
                keep = (s["copies"] > 1) & (s["hi"] - s["lo"] >= LENGTH)
                doc, lo, hi = s["doc"][keep], s["lo"][keep], s["hi"][keep]
                if not len(doc):
                    continue
                # Anchors come in order of place, and so do both bounds.
                new = np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])]
                last = np.r_[np.flatnonzero(new)[1:] - 1, len(doc) - 1]
                doc, lo, hi = doc[new], lo[new] - offsets[doc[new]], hi[last] - offsets[doc[new]]
                owner = batch.column(0).slice(first, end - first).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([owner, pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["id", "lo", "hi"])

    return docs.mapInArrow(run, "id bigint, lo int, hi int")


def neighbours(suffix: DataFrame) -> DataFrame:
    """(token, id, at, open): suffixes whose surroundings another one has (open false), or which share only the token.

    For a token with open suffixes, one suffix of each other surroundings comes too, with open null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["lead", "token"]):
            token, around, done = rows["token"].to_numpy(), rows["around"].to_numpy(), rows["done"].to_numpy()
            new = np.r_[True, token[1:] != token[:-1]]
            kind = np.r_[True, new[1:] | (around[1:] != around[:-1])]
            group, kinds = np.cumsum(new) - 1, np.cumsum(kind) - 1
            several = np.bincount(group, kind)[group] > 1
            same = (np.bincount(kinds) > 1)[kinds] | done
            wanting = several & ~same
            partner = kind & (np.bincount(group, wanting) > 0)[group] & same
            covered = (np.bincount(kinds) > 1)[kinds] | done
            for pick, value in ((covered, False), (wanting, True), (partner, None)):
                if pick.any():
                    part = rows.select(["token", "id", "at"]).filter(pa.array(pick)).combine_chunks().to_batches()[0]
                    flag = pa.nulls(len(part), pa.bool_()) if value is None else pa.array(np.full(len(part), value))
                    yield pa.RecordBatch.from_arrays([*part.columns, flag], ["token", "id", "at", "open"])

    n = shuffle_partitions(suffix)
    return (
        suffix.repartitionByRange(n, "lead", "token")
        .sortWithinPartitions("lead", "token", "around")
        .mapInArrow(run, "token bigint, id bigint, at int, open boolean")
    )


def surroundings(texts: DataFrame) -> DataFrame:
    """(token, id, at, left, around): the bytes around each wanted anchor that a string through it can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            ids, texts_, wanted = (batch.column(names.index(c)) for c in ("id", "text", "wanted"))
            out: list[tuple] = []
            for i in np.flatnonzero(wanted.is_valid().to_numpy(zero_copy_only=False)):
                data, key = (texts_[int(i)].as_py() or "").encode(), ids[int(i)].as_py()
                for w in wanted[int(i)].as_py():
                    lo = max(0, w["at"] - _SIDE)
                    out.append((w["token"], key, w["at"], w["at"] - lo, data[lo : w["at"] + LENGTH]))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["token", "id", "at", "left", "around"])

    return texts.mapInArrow(run, "token bigint, id bigint, at int, left int, around binary")


def string_spans(near: DataFrame, large: DataFrame) -> DataFrame:
    """(id, lo, hi) covered by 200-byte strings that suffixes of one token share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, key):
            lo, hi = rows["lo"].to_numpy(), rows["hi"].to_numpy()
            token, ids, at, left = (rows[c].to_numpy() for c in ("token", "id", "at", "left"))
            parts = rows["around"].to_pylist()
            size = np.array([len(p) for p in parts])
            data = np.frombuffer(b"".join(parts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum(size)])
            hashes = gram_hashes(prefix_hash(data), LENGTH)
            count = np.maximum(0, size - LENGTH + 1)
            row = np.repeat(np.arange(len(size)), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            group = mix(token.view(U64) + (lo.astype(U64) << U64(32)) + hi.astype(U64))
            string = mix(hashes[offsets[row] + step] + mix(group[row] + (step - left[row] + LENGTH).astype(U64)))
            _, inverse, times = np.unique(string, return_inverse=True, return_counts=True)
            found = np.flatnonzero(times[inverse] > 1)
            if not len(found):
                continue
            row, start = row[found], (at - left)[row[found]] + step[found]
            new = np.r_[True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + LENGTH)]
            last = np.r_[np.flatnonzero(new)[1:] - 1, len(row) - 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row[new]]), pa.array(start[new].astype(np.int32)), pa.array((start[last] + LENGTH).astype(np.int32))], ["id", "lo", "hi"]
            )

    n, key = shuffle_partitions(near), ["token", "lo", "hi"]
    met = paired_blocks(near, ["token"], "id", large).select(*key, "id", "at", "left", "around")
    return met.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(run, "id bigint, lo int, hi int")


def joined_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.r_[True, lo[1:] > hi[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(lo) - 1]
    return lo[new], hi[last]


def cut_spans(texts: DataFrame, text: str) -> DataFrame:
    """Appends kept (bytes) and removed (spans) to rows with an array of (lo, hi) in ``_spans``."""
    base = texts.drop("_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            names = batch.schema.names
            spans = batch.column(names.index("_spans"))
            kept: list[bytes] = []
            removed: list[list[dict]] = []
            for lo, hi, data, offsets in text_chunks(batch, text):
                for i in range(lo, hi):
                    raw = data[offsets[i - lo] : offsets[i - lo + 1]].tobytes()
                    if not spans[i].is_valid:
                        kept.append(raw)
                        removed.append([])
                        continue
                    flat = spans[i].values
                    starts, ends = joined_spans(flat.field("lo").to_numpy(), np.minimum(flat.field("hi").to_numpy(), len(raw)))
                    removed.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
                    kept.append(b"".join(raw[s:e] for s, e in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)], strict=True)))
            columns = [c for n, c in zip(names, batch.columns, strict=True) if n != "_spans"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()), pa.array(removed, kind)], [n for n in names if n != "_spans"] + ["kept", "removed"])

    return texts.mapInArrow(run, extended(base, ("kept", "binary"), ("removed", "array<struct<start:int,end:int>>")))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, with ``kept``, the bytes left of the text, and ``removed``, the spans cut out."""
    base = df.drop("kept", "removed")
    docs = base.where(base[key].isNotNull()).select(base[key].cast("bigint").alias("id"), base[text].alias("text"))
    found = written(neighbours(suffix_table(docs)), "suffixes")
    several = found.where("coalesce(open, true)")
    wanted = several.groupBy("id").agg(F.collect_list(F.struct("token", "at")).alias("wanted")).withColumnRenamed("id", "_id")
    # The same columns by the same key as in the last join: the texts are dealt once for both.
    placed = base.join(wanted.hint("shuffle_hash"), base[key].cast("bigint") == wanted["_id"], "left")
    near = surroundings(placed.select(F.col("_id").alias("id"), F.when(F.col("wanted").isNotNull(), F.col(text)).alias("text"), "wanted"))
    # A text with an anchor has 200 bytes around it; the end of the text is cut off below.
    whole = found.where("not open").select("id", F.greatest(F.lit(0), F.col("at") - _SIDE).alias("lo"), (F.col("at") + LENGTH).alias("hi"))
    spans = whole.union(string_spans(near, crowds(several, ["token"], CROWD))).union(chunk_spans(docs))
    spans = spans.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("_spans")).withColumnRenamed("id", "_id")
    return cut_spans(base.join(spans.hint("shuffle_hash"), base[key].cast("bigint") == spans["_id"], "left").drop("_id"), text)


@query("op5_repeated_strings")
def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        (F.octet_length(F.coalesce("text", F.lit(""))) - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
