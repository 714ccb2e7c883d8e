"""Join of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

MinHash LSH forest: a signature of ``TREES`` x 8 hash bytes is one path of eight steps in each tree.
The tries are sorted by path. Documents that share a whole path meet first; then prefixes are
shortened step by step, and each document stays in the tree until it is absorbed (below) or until, by the
forest's formula, a pair at the threshold is met in some tree with the probability ``recall``.
Within a prefix, sketches (half a byte per hash) leave pairs that may be similar; their components are
the candidate groups. All pairs within a group are then compared by their whole shingle sets, in blocks, so
that link counts are exact and have no cap, and no pair is ever a row.

Crowds are thinned twice without losing links: texts with the same words are one
class from the start, and within a prefix a document whose sketch is almost the
sketch of another only keeps its link to that one. A document that has absorbed others is itself absorbed by an
equal sketch only, so absorptions do not add up. Prefixes that stay crowded are cut into blocks
that meet pairwise.

A text of one to four words has one shingle, all its words. Null texts and texts without
a word link with nothing. Repeated rows are copies of each other; rows with a null id
keep a null class unless a copy has an id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.buffers import U64, forest, mix, powers, prefix_hash, span_hash, text_chunks, word_spans
from millrace.llm.registry import query, table
from millrace.llm.tables import components, crowds, paired_blocks, shuffle_partitions, whole_groups, written

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
TREES = 16
STEPS = 8
SLOTS = TREES * STEPS
#: Sketches almost alike: the document only keeps its link to the other one.
ABSORB = 0.9
#: The estimate of equal sketches, but for rounding.
SAME = 0.9999
#: Least estimate of a candidate: 0.6 by the triangle inequality over two absorptions, less noise.
CANDIDATE = 0.55
#: Links held before they are cut down to a spanning forest.
HELD = 1 << 20
BLOCK = 128
#: Documents under one prefix that meet another such block in one task.
CROWD = 4096
COLUMNS = 8192

_SEEDS = np.random.default_rng(97)
FLIP, TURN, SPIN = (_SEEDS.integers(0, 2**32, SLOTS, dtype=np.uint32) | np.uint32(1) for _ in range(3))
#: Equal half bytes in a byte of the exclusive or of two sketches.
EQUAL_HALVES = np.array([(x < 16) + (x % 16 == 0) for x in range(256)], np.uint8)


def depth_for(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES, steps: int = STEPS) -> int:
    """The longest prefix at which a pair of this similarity shares one in some tree with the wanted probability."""
    for depth in range(steps, 1, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    return 1


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, first word by document, shingle hashes, first shingle by document)."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hash(prefix_hash(data), starts, ends)
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(n)])
    begin = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], n)
    reach = np.repeat(np.minimum(counts, size), n)
    out = np.zeros(len(begin), U64)
    padded = np.concatenate([words, np.zeros(size, U64)])
    for k in range(size):
        step = mix(out + padded[begin + k] + U64(k + 1))
        out = np.where(reach > k, step, out) if (counts < size).any() else step
    return words, first, out, at


def signatures(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SLOTS bytes for each document that has a shingle."""
    full = np.flatnonzero(np.diff(at) > 0)
    low = (shingles ^ (shingles >> U64(32))).astype(np.uint32)
    out = np.empty((len(full), SLOTS), np.uint8)
    step = np.empty_like(low)
    for k in range(SLOTS):
        v = (low ^ FLIP[k]) * TURN[k]
        np.right_shift(v, np.uint32(15), out=step)
        v ^= step
        v *= SPIN[k]
        out[:, k] = np.minimum.reduceat(v, at[full]).astype(np.uint8)
    return out


def sequence_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each document's word sequence."""
    out = []
    for salt in (1, 2):
        sums = np.zeros(len(words) + 1, U64)
        p, inverse = powers(len(words) + 1)
        np.cumsum(mix(words + U64(salt)) * p[: len(words)], dtype=U64, out=sums[1:])
        out.append(mix((sums[first[1:]] - sums[first[:-1]]) * inverse[first[:-1]] + np.diff(first).astype(U64)))
    return np.stack(out)


def signed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, k1, k2, sig): identity of the word sequence, and the signature; null without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, "text"):
                words, first, shingles, at = shingle_hashes(data, offsets)
                keys = sequence_keys(words, first).astype(np.int64)
                none = np.diff(at) == 0
                sig = np.empty(hi - lo, object)
                sig[~none] = [r.tobytes() for r in signatures(shingles, at)] if len(shingles) else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(keys[0], mask=none), pa.array(keys[1], mask=none), pa.array(sig, pa.binary())],
                    ["id", "k1", "k2", "sig"],
                )

    return df.select(df[key].cast("bigint").alias("id"), df[text].alias("text")).mapInArrow(run, "id bigint, k1 bigint, k2 bigint, sig binary")


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of packed sketches."""
    return (EQUAL_HALVES[x ^ y].sum(axis=-1, dtype=np.int32) / SLOTS - 1 / 16) * (16 / 15)


def absorbs(near: np.ndarray, led: np.ndarray) -> np.ndarray:
    """Whether these estimates to a leader absorb a document; one that has absorbed others itself only by the same sketch."""
    return near >= np.where(led, SAME, ABSORB)


def bucket_links(ids: np.ndarray, sketch: np.ndarray, led: np.ndarray, leaders: int = 32, rows: int = 2048) -> tuple[list[np.ndarray], np.ndarray]:
    """Candidate pairs of one prefix, and which members were absorbed by another; marks those that absorbed in ``led``.

    A few members at a time are compared with all that are left; whatever is almost one of them drops out. A member
    that drops out absorbs nothing, so what it stood for is never further than one step away.
    """
    pairs: list[np.ndarray] = []
    absorbed = np.zeros(len(ids), bool)
    left = np.arange(len(ids))
    while len(left) > 1:
        lead = left[:leaders]
        own = absorbs(alike(sketch[lead][:, None, :], sketch[lead][None, :, :]), led[lead])
        stays = np.ones(len(lead), bool)
        for k in range(1, len(lead)):
            stays[k] = not (own[:k, k] & stays[:k]).any()
        gone = np.zeros(len(left), bool)
        gone[: len(lead)] = True
        lead = lead[stays]
        for lo in range(0, len(left), rows):
            part = left[lo : lo + rows]
            est = alike(sketch[lead][:, None, :], sketch[part][None, :, :])
            est[lead[:, None] >= part[None, :]] = 0
            a, b = np.nonzero(est >= CANDIDATE)
            pairs.append(np.stack([ids[lead[a]], ids[part[b]]]))
            near = absorbs(est, led[part])
            absorbed[part[near.any(axis=0)]] = True
            led[lead[near.any(axis=1)]] = True
            gone[lo : lo + rows] |= near.any(axis=0)
        left = left[~gone]
    return pairs, absorbed


def descend(
    ids: np.ndarray, sketch: np.ndarray, group: np.ndarray, path: np.ndarray, led: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, absorbed) of rows sorted by group and path, from whole paths to prefixes of ``depth`` steps.

    At each step the rows of a prefix that are not absorbed yet meet; a prefix that gained no row by
    being shortened is passed over. A document's prefix is shortened until it is absorbed or has the recall.
    """
    absorbed = np.zeros(len(ids), bool)
    links = [np.zeros((2, 0), np.int64)]
    held = 0
    alive = np.arange(len(ids))
    before = np.ones(len(ids), np.int64)
    for level in range(STEPS, depth - 1, -1):
        if len(alive) < 2:
            break
        prefix, own = path[alive] >> np.uint64(64 - 8 * level), group[alive]
        start = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (own[1:] != own[:-1])])
        end = np.r_[start[1:], len(alive)]
        size = end - start
        grown = size > before[alive[start]]
        two = start[grown & (size == 2)]
        x, y = alive[two], alive[two + 1]
        near = alike(sketch[x], sketch[y])
        links.append(np.stack([ids[x], ids[y]])[:, near >= CANDIDATE])
        gone = absorbs(near, led[y])
        absorbed[y[gone]] = True
        led[x[gone]] = True
        for k in np.flatnonzero(grown & (size > 2)):
            members = alive[start[k] : end[k]]
            marks = led[members]
            more, gone = bucket_links(ids[members], sketch[members], marks)
            absorbed[members[gone]] = True
            led[members] = marks
            links += more
            held += sum(m.shape[1] for m in more)
            if held > HELD:
                links, held = [np.stack(forest(*np.concatenate(links, axis=1)))], 0
        stays = ~absorbed[alive]
        before[alive] = np.repeat(np.add.reduceat(stays.astype(np.int64), start), size)
        alive = alive[stays]
    both = np.concatenate(links, axis=1)
    return both[0], both[1], absorbed


EDGE = "a bigint, b bigint"
TREE = "tree int, prefix bigint, path bigint, id bigint, sketch binary, led boolean, a bigint, b bigint"


def planted(reps: DataFrame, depth: int) -> DataFrame:
    """Rows of the trees; members that are almost another one of this partition leave only their link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - 8 * depth)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, SLOTS)
            packed = (sig[:, 0::2] & 15) << 4 | (sig[:, 1::2] & 15)
            paths = sig.reshape(n, TREES, STEPS).copy().view(">u8")[:, :, 0].astype(np.uint64)
            ids, sketches = batch.column(0), pa.array([r.tobytes() for r in packed], pa.binary())
            numbers, same = ids.to_numpy(), np.zeros(n, np.int8)
            links = []
            for t in range(TREES):
                order = np.argsort(paths[:, t], kind="stable")
                led = np.zeros(n, bool)
                a, b, absorbed = descend(numbers[order], packed[order], same, paths[order, t], led, depth)
                keep = order[~absorbed]
                none = pa.nulls(len(keep), pa.int64())
                signed_path = pa.array(paths[keep, t].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keep), t, np.int32)), pa.array((paths[keep, t] >> shift).view(np.int64)), signed_path,
                     ids.take(pa.array(keep)), sketches.take(pa.array(keep)), pa.array(led[~absorbed]), none, none],
                    schema_of(TREE),
                )
                links.append(np.stack([a, b]))
            # One spanning link per document, whatever the number of trees and pairs.
            a, b = forest(*np.concatenate(links, axis=1))
            rest = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(a), pa.int32()), rest, rest, rest, pa.nulls(len(a), pa.binary()), pa.nulls(len(a), pa.bool_()), pa.array(a), pa.array(b)],
                schema_of(TREE),
            )

    return reps.select("id", "sig").mapInArrow(run, TREE)


def schema_of(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def candidate_links(reps: DataFrame, depth: int) -> DataFrame:
    """Links (a, b) between documents that may be similar; enough to join each group."""
    rows = written(planted(reps, depth), "forest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 0), np.int64)
        for group in whole_groups(batches, key):
            tree, prefix, lo, hi = (group[c].to_numpy() for c in key)
            new = (tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            if new.all():
                continue
            ids, paths = group["id"].to_numpy(), group["path"].to_numpy().view(np.uint64)
            sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
            led = group["led"].to_numpy().copy()
            a, b, _ = descend(ids, sketch, np.r_[0, np.cumsum(new)], paths, led, depth)
            held = np.stack(forest(*np.concatenate([held, np.stack([a, b])], axis=1)))
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["a", "b"])

    n, key = shuffle_partitions(reps), ["tree", "prefix", "lo", "hi"]
    leaves = rows.where("tree is not null").select("tree", "prefix", "path", "id", "sketch", "led")
    large = crowds(leaves, ["tree", "prefix"], CROWD)
    met = (
        paired_blocks(leaves, ["tree", "prefix"], "id", large)
        .select(*key, "path", "id", "sketch", "led")
        .repartition(n, *key)
        .sortWithinPartitions(*key, "path", "id")
        .mapInArrow(run, EDGE)
    )
    return met.union(rows.where("a is not null").select("a", "b"))


def shingle_sets(members: DataFrame) -> DataFrame:
    """(component, lo, hi, own, id, copies, grams): the sorted distinct shingles instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, "text"):
                _, _, grams, at = shingle_hashes(data, offsets)
                sets = [np.unique(grams[s:e]).tobytes() for s, e in zip(at, at[1:], strict=False)]
                rest = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*rest.columns[:-1], pa.array(sets, pa.binary())], [*batch.schema.names[:-1], "grams"])

    sized = members.select("component", "n", "id", "copies", "text").mapInArrow(
        run, "component bigint, n int, id bigint, copies bigint, grams binary"
    )
    return (
        sized.withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "id", "copies", "grams")
    )


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[sizes[0], both], [both, sizes[1]]])
    _, index, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    place = np.cumsum(count > 1) - 1
    kept = (count > 1)[index]
    place, owner = place[index[kept]], owner[kept]
    out = np.zeros((len(sets), len(sets)))
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for lo in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        s, e = np.searchsorted(place, [lo, lo + COLUMNS])
        m = np.zeros((len(sets), COLUMNS), np.float32)
        m[owner[s:e], place[s:e] - lo] = 1
        out += m @ m.T
    np.fill_diagonal(out, sizes)
    return out


def verified(sets: DataFrame, similarity: float) -> DataFrame:
    """(id, n, to): copies linked within one meeting of blocks, and the least id of the links' component there."""
    num = round(similarity * 1000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["component", "lo", "hi"]):
            comp, lo, hi, own, ids, copies = (rows[c].to_numpy() for c in ("component", "lo", "hi", "own", "id", "copies"))
            grams = rows["grams"].combine_chunks()
            cut = np.flatnonzero((comp[1:] != comp[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            out: list[list[np.ndarray]] = [[], [], []]
            for s, e in zip(np.r_[0, cut], np.r_[cut, len(comp)], strict=True):
                _, first = np.unique(ids[s:e], return_index=True)
                at = s + first
                sets_ = [np.frombuffer(grams[int(i)].as_py(), np.uint64) for i in at]
                if len(sets_) < 2:
                    continue
                both = shared(sets_)
                sizes = np.diag(both)
                linked = 1000 * both >= num * (sizes[:, None] + sizes[None, :] - both)
                np.fill_diagonal(linked, False)
                if lo[s] != hi[s]:
                    linked &= own[at][:, None] != own[at][None, :]
                here = ids[at]
                to = here.copy()
                a, b = np.nonzero(np.triu(linked))
                if len(a):
                    node, root = forest(here[a], here[b])
                    to[np.searchsorted(here, node)] = root
                out[0].append(here)
                out[1].append(linked @ copies[at])
                out[2].append(to)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o).astype(np.int64)) for o in out], ["id", "n", "to"])

    n = shuffle_partitions(sets)
    key = ["component", "lo", "hi"]
    return sets.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(run, "id bigint, n bigint, to bigint")


def jaccard_join(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """(id, class_id, n_links): the least id that links reach, and how many other documents are linked directly."""
    signs = written(signed(df, key, text), "signatures")
    classes = written(
        signs.where("sig is not null")
        .groupBy("k1", "k2")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.min("sig").alias("sig")),
        "classes",
    )
    groups = components(candidate_links(classes.where("id is not null"), depth_for(similarity, recall)))
    groups = written(groups.select(F.col("node").alias("id"), "component"), "candidate-groups")
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    members = groups.join(sizes, "component").join(classes.select("id", "copies"), "id")
    texts = df.select(df[key].cast("bigint").alias("id"), df[text].alias("text"))
    links = written(verified(shingle_sets(members.join(texts, "id")), similarity), "verified")
    joined = components(links.select(F.col("id").alias("a"), F.col("to").alias("b")))
    counts = links.groupBy("id").agg(F.sum("n").alias("linked"))
    found = (
        classes.join(counts, "id", "left")
        .join(joined.select(F.col("node").alias("id"), "component"), "id", "left")
        .select("k1", "k2", F.coalesce("component", "id").alias("class_id"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return signs.select("id", "k1", "k2").join(found, ["k1", "k2"], "left").select(
        "id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i : i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS gram
  FROM w WHERE len(words) > 0
), s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT p.a, p.b FROM p JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b WHERE 5 * p.n >= 4 * (x.n + y.n - p.n)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a AS doc_id, min(b) AS class_id FROM r GROUP BY a),
k AS (SELECT a AS doc_id, count(*) AS n FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0)::BIGINT AS n_links, doc_id = class_id AS kept FROM c LEFT JOIN k USING (doc_id)
"""


@query("op3_ngram_jaccard", SQL)
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", (F.col("id") == F.col("class_id")).alias("kept"))
