"""Near-duplicate embeddings by sorted projection passes.

Each pass orders the vectors of a label by concatenated random hashes, the signs of random projections, and
compares every vector with the ``WINDOW`` ones after it. The order is cut by rank into blocks of equal size, each with the
first rows of the next one, so a large label or many equal hashes fall on many tasks. The number of signs and of passes follows the
label's size, so that a pair at the threshold shares the first signs of no pass with a chance of ``MISS``. A window that
ends among vectors of the same first signs may have cut such a pair: its rows go into further
passes, of these rows alone and with windows ``WIDER`` times as wide, until no window ends so. No number of neighbours is a cap.

Windows compare sketches of 512 further signs; rows with a near sketch get their vectors back and the exact cosine
decides. Only a spanning forest of a block's true links leaves its task; links of all passes are united.
Once components are known, all pairs within each are compared exactly, in blocks, so link counts have
no cap. The passes move sketches, not vectors.

Equal vectors of a label are folded before the passes into the one of least id, which stands for all of
them in the passes and counts as often in the links; equality is by 128 bits of hash.

Rows whose label, id or vector is null, or whose vector is zero or holds null or non-finite
components, link with nothing and stay alone; so do vectors of different lengths. Of rows that
repeat an id one is compared, and each is returned. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.buffers import forest
from millrace.llm.registry import query, table
from millrace.llm.tables import components, extended, shuffle_partitions, whole_groups, written

MIN_COSINE = 0.98
#: Chance that a pair at the threshold meets in no pass.
MISS = 1e-5
#: Vectors that each one is compared with on either side, in the first passes.
WINDOW = 32
SKETCH_BITS = 512
#: By chance a quarter of a window shares the first signs; this many more signs order these.
SPARE, FURTHER = 2, 8
#: How much wider windows get for the rows whose windows were cut.
WIDER = 8
#: Ranks of a block, and at least four windows.
RANKS = 4096
#: Vectors of a component that meet another such block in one task.
BLOCK = 512
ORDER = ["pass", "grp", "dim", "place", "id"]


def planes(dim: int, signs: int) -> np.ndarray:
    """The projections of the sketch and then of all passes; fixed by the dimension and their number."""
    return np.random.default_rng(dim).standard_normal((dim, SKETCH_BITS + signs)).astype(np.float32)


def agreement(min_cosine: float) -> float:
    """The chance that a projection has the same sign for two vectors at this cosine."""
    return 1 - math.acos(min_cosine) / math.pi


def depths(sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The first signs that decide, for labels of these sizes; none where a window holds the label."""
    return np.where(sizes <= window, 0, np.ceil(np.log2(np.maximum(sizes, window) / window)).astype(np.int64) + SPARE)


def passes_for(depth: int, min_cosine: float = MIN_COSINE) -> int:
    """As many passes as a pair at the threshold needs to share a whole prefix in one of them."""
    return max(1, math.ceil(math.log(MISS) / math.log1p(-(agreement(min_cosine) ** depth)))) if depth and min_cosine < 1 else 1


def sketch_limit(min_cosine: float) -> int:
    """Signs in which sketches at the threshold may differ: five deviations more than expected."""
    p = 1 - agreement(min_cosine)
    return int(SKETCH_BITS * p + 5 * math.sqrt(SKETCH_BITS * p * (1 - p)))


def usable(vector: str, label: str, key: str) -> Column:
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sketched(df: DataFrame, window: int = WINDOW, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(pass, grp, dim, place, id, sketch) for each vector and pass; df has (id, grp, v).

    ``place`` is the concatenated hash, its first signs ahead; ``FURTHER`` ones come last.
    """
    sized = df.withColumn("dim", F.size("v"))
    sized = sized.join(sized.groupBy("grp", "dim").agg(F.count("*").alias("size")), ["grp", "dim"]).select("id", "grp", "v", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            dims = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            depth = depths(batch.column(3).to_numpy(), window)
            for dim, d in np.unique(np.stack([dims, depth], axis=1), axis=0).tolist():
                part = batch.take(pa.array(np.flatnonzero((dims == dim) & (depth == d))))
                passes, bits = passes_for(d, min_cosine), d + FURTHER
                if (dim, d) not in kept:
                    kept[dim, d] = planes(dim, passes * bits)
                signs = unit(as_matrix(part.column(2), dim)).astype(np.float32) @ kept[dim, d] > 0
                sketch = pa.array([r.tobytes() for r in np.packbits(signs[:, :SKETCH_BITS], axis=1)], pa.binary())
                n = len(part)
                for p in range(passes):
                    place = signs[:, SKETCH_BITS + p * bits : SKETCH_BITS + (p + 1) * bits] @ (np.int64(1) << np.arange(bits)[::-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, p, np.int32)), part.column(1), pa.array(np.full(n, dim, np.int32)),
                         pa.array(place, pa.int64()), part.column(0), sketch],
                        ["pass", "grp", "dim", "place", "id", "sketch"],
                    )

    kind = df.schema["grp"].dataType.simpleString()
    return sized.mapInArrow(run, f"pass int, grp {kind}, dim int, place bigint, id bigint, sketch binary")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank``, the place of each row in the order, which must be total; no row is moved but by the sort."""
    schema = extended(rows, ("_part", "int"), ("_index", "bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            more = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema.names)
            at += n

    dealt = rows.repartitionByRange(shuffle_partitions(rows), *order).sortWithinPartitions(*order)
    placed = written(dealt.mapInArrow(run, schema), "sorted")
    # One row per partition.
    before = F.sum("n").over(Window.orderBy("_part")) - F.col("n")
    bases = placed.groupBy("_part").agg(F.count("*").alias("n")).select("_part", before.alias("_base"))
    return placed.join(F.broadcast(bases), "_part").withColumn("rank", F.col("_base") + F.col("_index")).drop("_part", "_index", "_base")


def runs_of(rows: pa.Table, columns: list[str]) -> np.ndarray:
    """The number of the run of equal values that each row lies in."""
    new = np.zeros(len(rows), bool)
    for name in columns:
        c = rows[name].to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def windows(rank: np.ndarray, run: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one run whose ranks lie at most ``width`` apart; rows are in the order of runs and ranks."""
    for o in range(1, width + 1):
        a = np.flatnonzero(run[o:] == run[:-o]) if o < len(run) else np.zeros(0, np.int64)
        if not len(a):
            return
        yield a[rank[a + o] - rank[a] <= width], a[rank[a + o] - rank[a] <= width] + o


def met_in_windows(sketches: DataFrame, window: int, limit: int) -> DataFrame:
    """(block, run, rank, id, cut): the rows with a near sketch in a window, and with ``cut`` those whose window ends too early."""
    block = max(RANKS, 4 * window)
    rank = F.col("rank")
    own = F.floor(rank / block)
    # The first rows of a block are compared with the last ones of the block before, too.
    blocks = F.when((rank % block < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = ranked(sketches, ORDER).withColumn("block", F.explode(blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["block"]):
            sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint64).reshape(len(rows), -1)
            label = runs_of(rows, ["block", "pass", "grp", "dim"])
            rank, first = rows["rank"].to_numpy(), rows["place"].to_numpy() >> FURTHER
            near, cut = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
            for a, b in windows(rank, label, window):
                differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
                hit = differ <= limit
                near[a[hit]] = near[b[hit]] = True
            a = np.flatnonzero((label[window:] == label[:-window]) & (first[window:] == first[:-window])) if len(rows) > window else []
            cut[a] = True
            cut[np.asarray(a, np.int64) + window] = True
            keep = np.flatnonzero(near | cut)
            yield pa.RecordBatch.from_arrays(
                [rows["block"].combine_chunks().take(pa.array(keep)), pa.array(label[keep]), pa.array(rank[keep]),
                 rows["id"].combine_chunks().take(pa.array(keep)), pa.array(near[keep]), pa.array(cut[keep])],
                ["block", "run", "rank", "id", "near", "cut"],
            )

    schema = "block bigint, run bigint, rank bigint, id bigint, near boolean, cut boolean"
    return dealt.repartition(shuffle_partitions(sketches), "block").sortWithinPartitions("block", "rank").mapInArrow(run, schema)


def true_links(met: DataFrame, vectors: DataFrame, window: int, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(a, b) that span the links of each block, by cosines in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["block"]):
            rows = rows.combine_chunks()
            lengths = rows["v"].combine_chunks().value_lengths().to_numpy()
            for dim in np.unique(lengths).tolist():
                part = rows.take(pa.array(np.flatnonzero(lengths == dim))).combine_chunks()
                x = unit(as_matrix(part["v"].combine_chunks(), dim))
                ids, rank = part["id"].to_numpy(), part["rank"].to_numpy()
                left, right = [], []
                for a, b in windows(rank, runs_of(part, ["block", "run"]), window):
                    good = np.einsum("ij,ij->i", x[a], x[b]) >= min_cosine
                    left.append(ids[a[good]])
                    right.append(ids[b[good]])
                if left and sum(map(len, left)):
                    low, high = forest(np.concatenate(left), np.concatenate(right))
                    yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    joined = met.join(vectors.select("id", "v"), "id").select("block", "run", "rank", "id", "v")
    dealt = joined.repartition(shuffle_partitions(met), "block").sortWithinPartitions("block", "rank")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def linked_in_passes(vectors: DataFrame, min_cosine: float = MIN_COSINE, window: int = WINDOW) -> DataFrame:
    """(a, b) that span the links among vectors (id, grp, v), from as many rounds of passes as windows need."""
    active, edges = vectors, None
    while True:
        met = written(met_in_windows(sketched(active, window, min_cosine), window, sketch_limit(min_cosine)), "vector-windows")
        found = written(true_links(met.where("near"), vectors, window, min_cosine), "vector-edges")
        edges = found if edges is None else edges.union(found)
        again = met.where("cut").select("id").distinct()
        if again.isEmpty():
            return edges.distinct()
        active, window = vectors.join(again, "id", "left_semi"), WIDER * window


def counted_links(members: DataFrame, min_cosine: float = MIN_COSINE, block: int = BLOCK) -> DataFrame:
    """(id, n_links) over all pairs within components; members has (id, component, v) and may have copies.

    A vector counts once for each of its copies in the links of others, and as one where there is no such column.
    A component of m vectors is cut into m / block blocks; each pair of blocks meets in one group.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    copies = F.col("copies") if "copies" in members.columns else F.lit(1)
    blocked = (
        members.withColumn("copies", copies.cast("bigint")).join(sizes, "component")
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "id", "copies", "v")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["component", "lo", "hi"]):
            rows = rows.combine_chunks()
            comp, lo, hi, own, ids, copies = (rows[c].to_numpy() for c in ("component", "lo", "hi", "own", "id", "copies"))
            vectors = rows["v"].chunk(0) if rows["v"].num_chunks else rows["v"].combine_chunks()
            cut = np.flatnonzero((comp[1:] != comp[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            found_ids, found = [], []
            for s, e in zip(np.r_[0, cut], np.r_[cut, len(rows)], strict=True):
                x = unit(as_matrix(vectors.slice(s, e - s), len(vectors[s])))
                _, first = np.unique(ids[s:e], return_index=True)
                at, mine = x[first], own[s:e][first]
                near = at @ at.T >= min_cosine
                if lo[s] == hi[s]:
                    np.fill_diagonal(near, False)
                else:
                    near &= mine[:, None] != mine[None, :]
                found_ids.append(ids[s:e][first])
                found.append(near @ copies[s:e][first])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_ids)), pa.array(np.concatenate(found), pa.int64())], ["id", "n"])

    n = shuffle_partitions(members)
    key = ["component", "lo", "hi"]
    parts = blocked.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(run, "id bigint, n bigint")
    return parts.groupBy("id").agg(F.sum("n").alias("n_links"))


def folded(vectors: DataFrame) -> DataFrame:
    """(id, first, copies) of the vectors with an equal one in their label: the least id among them, and how many they are."""
    hashes = vectors.select("id", F.xxhash64("grp", "v").alias("h"), F.xxhash64(F.lit(1), "v", "grp").alias("g"))
    equal = hashes.groupBy("h", "g").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    return hashes.join(equal, ["h", "g"]).select("id", "first", "copies")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(id, n_links, component) of each vector that has a link."""
    good = df.where(usable(vector, label, key)).select(
        F.col(key).cast("bigint").alias("id"), F.col(label).alias("grp"), F.col(vector).alias("v")
    )
    good = written(good.groupBy("id").agg(F.min(F.struct("grp", "v")).alias("x")).select("id", "x.grp", "x.v"), "vectors")
    equal = written(folded(good), "vector-copies")
    alone = good.join(equal.where("id <> first").select("id"), "id", "left_anti")
    edges = linked_in_passes(written(alone, "vectors-alone"), min_cosine)
    groups = written(components(edges).select(F.col("node").alias("id"), "component"), "vector-groups")
    counts = equal.where("id = first").select("id", "copies")
    members = groups.join(good.select("id", "v"), "id").join(counts, "id", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    linked = written(groups.join(counted_links(members, min_cosine), "id").select("id", "n_links", "component"), "vector-links")
    copied = equal.join(linked.withColumnRenamed("id", "first"), "first", "left").select(
        "id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "first").alias("component")
    )
    return linked.join(equal.select("id"), "id", "left_anti").union(copied)


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c
"""


@query("op1_embedding_neardup", SQL)
def embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = near_duplicates(vectors).withColumnRenamed("id", "vec_id")
    return vectors.select("vec_id").join(found, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
