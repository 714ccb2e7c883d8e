"""Operators that compare documents or vectors, against loops over all pairs."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from edge import awkward, empty, prose
from millrace.llm import jaccard, lines, repeats, vectors
from millrace.llm.queries import QUERIES


def groups(nodes, links):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        low[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 16))
    rows = []
    for i in range(900):
        base = centre[i % 6] + rng.normal(size=16) * (0.03 if i % 3 else 1.0)
        rows.append((i, int(i % 2), base.tolist()))
    rows += [(1000, None, rows[0][2]), (1001, 0, None), (1002, 0, [0.0] * 16), (1003, 0, [float("nan")] * 16), (1004, 0, [None] * 16)]
    rows += [(1005, 0, [float("inf")] + [1.0] * 15), (1006, 0, [1.0, 2.0]), (1007, 0, [2.0, 4.0]), (1008, 0, []), (None, 0, rows[0][2])]
    rows += [rows[4], rows[4]]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id bigint, label int, embedding array<float>, component string")
    unit = {i: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for i, _, v in rows[:900]}
    unit |= {1006: np.array([1, 2]) / 5**0.5, 1007: np.array([1, 2]) / 5**0.5}
    label = {i: g for i, g, _ in rows}
    links = [(a, b) for a, b in combinations(sorted(unit), 2) if label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    degree = dict.fromkeys(unit, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    low = groups(unit, links)
    found = {r["id"]: (r["n_links"], r["component"]) for r in vectors.near_duplicates(df).collect()}
    assert found == {i: (degree[i], low[i]) for i in unit if degree[i]}
    assert max(degree.values()) > 2 * vectors.WINDOW
    blocks = vectors.counted_links(
        df.where("vec_id < 900").selectExpr("vec_id as id", "label as component", "embedding as v").dropDuplicates(["id"]).selectExpr("id", "cast(component as bigint) as component", "v"), block=64
    )
    assert {r["id"]: r["n_links"] for r in blocks.collect() if r["n_links"]} == {i: d for i, d in degree.items() if d and i < 900}
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def settled(spark, vecs):
    """What the operator finds for these vectors of one label, and what all pairs give."""
    unit = np.float32(vecs).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    low = groups(range(len(vecs)), zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
    expected = {i: (int(n), low[i]) for i, n in enumerate(near.sum(axis=1)) if n}
    df = spark.createDataFrame([(i, 0, np.float32(v).tolist()) for i, v in enumerate(vecs)], "vec_id bigint, label int, embedding array<float>")
    return {r["id"]: (r["n_links"], r["component"]) for r in vectors.near_duplicates(df).collect()}, expected


def at_cosine(rng, x, cosine):
    """A unit vector at this cosine from the unit vector x."""
    y = rng.normal(size=len(x))
    y -= (y @ x) * x
    return cosine * x + (1 - cosine**2) ** 0.5 * y / np.linalg.norm(y)


def test_vectors_link_groups_of_copies(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=32)
    x /= np.linalg.norm(x)
    y = at_cosine(rng, x, 0.985)
    z = rng.normal(size=32)
    vecs = [x, y, z] * 50
    found, expected = settled(spark, vecs)
    assert found == expected
    assert expected[0] == (99, 0) and expected[1] == (99, 0) and expected[2] == (49, 2)


@pytest.mark.parametrize("ranks", [4096, 200])
def test_vectors_link_a_crowd_to_its_centre(spark, monkeypatch, ranks):
    """More linked vectors than any first window holds: the windows grow until none is cut."""
    monkeypatch.setattr(vectors, "RANKS", ranks)
    windows = []
    met = vectors.met_in_windows

    def noted(sketches, window, limit):
        windows.append(window)
        return met(sketches, window, limit)

    monkeypatch.setattr(vectors, "met_in_windows", noted)
    rng = np.random.default_rng(5)
    x = rng.normal(size=256)
    x /= np.linalg.norm(x)
    vecs = [at_cosine(rng, x, 0.985) for _ in range(1500)] + [x] + [2.0**i * x for i in range(-20, 20)]
    found, expected = settled(spark, vecs)
    assert found == expected
    assert expected[1500] == (1540, 0) and expected[0] == (41, 0)
    assert windows == [vectors.WINDOW * vectors.WIDER**i for i in range(len(windows))] and len(windows) > 1


def test_vectors_sort_labels_of_any_size_in_windows(spark):
    """Passes and windows run for small labels too, and every rank is in its block and, if early, in the one before."""
    rng = np.random.default_rng(6)
    vecs = [(i, i % 3, rng.normal(size=8).tolist()) for i in range(300)]
    df = spark.createDataFrame(vecs, "id bigint, grp int, v array<float>")
    made = vectors.sketched(df).persist()
    passes = vectors.passes_for(int(vectors.depths(np.array([100]))[0]))
    assert passes > 5 and made.count() == 300 * passes
    placed = vectors.ranked(made, vectors.ORDER).collect()
    placed.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in placed] == list(range(300 * passes))
    keys = [tuple(r[c] for c in vectors.ORDER) for r in placed]
    assert keys == sorted(keys)
    made.unpersist()


def test_windows_pair_all_near_ranks():
    rank, run = np.array([0, 1, 2, 5, 6, 7, 8]), np.array([0, 0, 0, 0, 1, 1, 1])
    pairs = {(int(x), int(y)) for a, b in vectors.windows(rank, run, 3) for x, y in zip(a, b, strict=True)}
    assert pairs == {(i, j) for i in range(7) for j in range(i + 1, 7) if run[i] == run[j] and rank[j] - rank[i] <= 3}


def test_passes_follow_the_label():
    for n in (10, 100, 10**4, 10**9):
        d = int(vectors.depths(np.array([n]))[0])
        assert (1 - vectors.agreement(0.98) ** d) ** vectors.passes_for(d) <= vectors.MISS
        assert n <= vectors.WINDOW and d == 0 or vectors.WINDOW / 8 < n / 2**d <= vectors.WINDOW / 4


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def near_texts(rng, crowd):
    """A crowd of near copies of one text, some pairs, exact copies, and texts on their own."""
    base = prose(rng, 200).split()
    texts = [prose(rng, 90) for _ in range(40)]
    for i in range(crowd):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(200)] = f"w{i}"
        texts.append(" ".join(words))
    for i in range(30):
        words = texts[i].split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    return texts + [texts[3]] * 5 + ["a b c", "a b  c", "a b", None, "", " \n"]


@pytest.mark.parametrize("crowd", [4096, 12])
def test_jaccard_against_all_pairs(spark, monkeypatch, crowd):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    texts = near_texts(random.Random(3), 300)
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    degree = dict.fromkeys(sets, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    low = groups(sets, links)
    found = {r["id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {i: (low[i], degree[i]) for i in sets}
    assert max(degree.values()) > jaccard.BLOCK


def test_jaccard_on_awkward_tables(spark):
    found = [(r["id"], r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(awkward(spark)).collect()]
    assert len(found) == 12
    by_id = {i: (c, n) for i, c, n in found}
    assert by_id[5] == (4, 1) and by_id[8] == (7, 3) and by_id[7] == (7, 3) and by_id[None] == (7, 3)
    assert by_id[1] == (1, 0) and by_id[2] == (2, 0) and by_id[3] == (3, 0)
    assert jaccard.jaccard_join(empty(spark)).count() == 0


def test_chains_of_versions_over_partitions(spark):
    rng = random.Random(21)
    texts = []
    for chain in range(12):
        words = [f"w{chain}x{rng.randrange(400)}" for _ in range(150)]
        for _ in range(25):
            for _ in range(rng.choice([1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    low = groups(sets, links)
    degree = Counter(x for link in links for x in link)
    for parts in (1, 40):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        assert {r["id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(df).collect()} == {i: (low[i], degree[i]) for i in sets}


def test_prefixes_are_shortened_until_rows_are_absorbed():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (30, 64), dtype=np.uint8)
    sketch = base[np.sort(rng.integers(0, 30, 400))].copy()
    for row in sketch:
        row[rng.integers(0, 64, rng.integers(0, 8))] = 7
    path = np.sort(rng.integers(0, 4, (400, 8), dtype=np.uint8).view(">u8")[:, 0].astype(np.uint64))
    ids, led = np.arange(400), np.zeros(400, bool)
    a, b, absorbed = jaccard.descend(ids, sketch, np.zeros(400, np.int8), path, led, 2)
    linked = set(zip(a.tolist(), b.tolist(), strict=True))
    prefix = path >> np.uint64(48)
    near = jaccard.alike(sketch[:, None, :], sketch[None, :, :])
    for i in np.flatnonzero(absorbed):
        own = [x for x, y in linked if y == i and near[x, i] >= jaccard.ABSORB and prefix[x] == prefix[i]]
        # Its leader is still there, or an equal sketch stands for it.
        assert any(not absorbed[x] or (near[x][~absorbed] >= jaccard.SAME).any() for x in own)
    for i, j in combinations(np.flatnonzero(~absorbed), 2):
        if prefix[i] == prefix[j] and near[i, j] >= jaccard.CANDIDATE:
            assert (i, j) in linked or (j, i) in linked
    assert absorbed.any() and led.any() and not absorbed.all()


def test_prefix_depth_meets_the_recall():
    d = jaccard.depth_for(0.8, 0.999)
    assert 1 - (1 - 0.8**d) ** jaccard.TREES >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TREES
    assert jaccard.depth_for(0.01, 0.999999) == 1


def marked(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for i, r in enumerate(raw):
        for p in range(len(r) - length + 1):
            seen.setdefault(r[p : p + length], []).append((i, p))
    mark = [bytearray(len(r)) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                mark[i][p : p + length] = b"\1" * length
    return [(bytes(c for c, m in zip(r, k, strict=True) if not m), [m.span() for m in re.finditer(b"\1+", bytes(k))]) for r, k in zip(raw, mark, strict=True)]


@pytest.mark.parametrize("crowd", [8192, 3])
def test_repeats_against_all_strings(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(7)
    passages = [prose(rng, n) for n in (20, 38, 45, 80, 160)]
    texts = [None, "", "x" * 199, "x" * 200, "x" * 430, "ab" * 300, "é" * 150]
    for i in range(80):
        parts = [prose(rng, rng.randrange(30)) + str(i)]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = rng.randrange(60)
            parts += [p[cut:] if rng.random() < 0.5 else p, prose(rng, rng.randrange(20)) + str(rng.random())]
        texts.append(rng.choice(["", " ", "ü"]).join(parts))
    texts += [texts[20]] * 3
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = {r["doc_id"]: (bytes(r["kept"]), [(s["start"], s["end"]) for s in r["removed"]]) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()}
    for i, expected in enumerate(marked(texts)):
        assert found[i] == expected, i


def test_repeats_on_awkward_tables(spark):
    rows = repeats.remove_repeats(awkward(spark)).collect()
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] is None:
            assert bytes(r["kept"]).decode() == r["text"]
        if r["doc_id"] == 7:
            assert bytes(r["kept"]) == b""
    assert repeats.remove_repeats(empty(spark)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_edit_automaton(limit):
    rng = random.Random(limit)
    left = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) for _ in range(1500)]
    right = [bytes([c for c in x if rng.random() > 0.1] + [97] * (rng.random() < 0.5)) or b"a" for x in left]
    pad = lambda rows: np.array([list(r.ljust(16, b"\0")) for r in rows], np.uint8)
    size = lambda rows: np.array([len(r) for r in rows])
    got = lines.within(pad(left), size(left), pad(right), size(right), limit)
    assert got.tolist() == [edits(a, b) <= limit for a, b in zip(left, right, strict=True)]


@pytest.mark.parametrize(("limit", "block"), [(1, 4096), (2, 4096), (1, 16)])
def test_lines_against_all_pairs(spark, monkeypatch, limit, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    rng = random.Random(10 * limit)
    pool = [prose(rng, 9) for _ in range(25)] + ["short", "é" * 30, "a", "  "]
    crowd = prose(rng, 10)
    texts = [None, "", "\n\n"]
    for i in range(70):
        made = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(pool) if rng.random() < 0.7 else crowd)
            for _ in range(rng.randrange(limit + 2) if rng.random() < 0.6 else 0):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randrange(2)] = rng.choice(["", "z", str(i)])
            made.append("".join(line))
        texts.append("\n".join(made))
    kept_lines, expected = [], {}
    for i, text in enumerate(texts):
        kept, removed = [], 0
        for line in (text or "").split("\n"):
            raw = line.encode()
            if not re.search(r"[^\x20\x09-\x0D]", line):
                kept.append(line)
                continue
            if any(raw == o or (min(len(raw), len(o)) >= lines.MIN_BYTES and abs(len(raw) - len(o)) <= limit and edits(raw, o) <= limit) for o in kept_lines):
                removed += 1
            else:
                kept.append(line)
            kept_lines.append(raw)
        expected[i] = (removed, None if text is None else "\n".join(kept))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r["doc_id"]: (r["n_removed"], r["text"]) for r in lines.dedupe_lines(df, edits=limit).collect()}
    assert found == expected
    assert sum(n for n, _ in expected.values()) > 50


def test_lines_within_the_edits_of_their_length(spark):
    rng = random.Random(4)
    pool = [prose(rng, n) for n in (7, 8, 9, 12, 60)] + ["é" * 25, "漢字仮名交じり文の長い行をここに置く", "河" * 20 + "石を運ぶ人々の長い列が町まで続く" * 3]
    pool.append(prose(rng, 6)[:39].strip() + "ü" * 3)
    rows = []
    for i in range(150):
        line = list(rng.choice(pool))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(line) + 1)
            line[at : at + rng.randrange(2)] = rng.choice(["", "ö", "語", "z", "😀"])
        rows.append((i, "".join(line)))
    expected = {}
    for i, line in rows:
        limit = lambda o: 2 if min(len(line), len(o)) >= 40 else 1  # noqa: E731, B023
        long = [o for _, o in rows[:i] if min(len(o.encode()), len(line.encode())) >= lines.MIN_BYTES]
        expected[i] = int(any(o == line for _, o in rows[:i]) or any(abs(len(o) - len(line)) <= 2 and edits(line, o) <= limit(o) for o in long))
    found = {r["doc_id"]: r["n_removed"] for r in lines.dedupe_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert found == expected
    assert 20 < sum(expected.values()) < 145


def test_lines_on_awkward_tables(spark):
    rows = lines.dedupe_lines(awkward(spark)).collect()
    assert len(rows) == 12 and sum(r["text"] is None for r in rows) == 1
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5]["text"] == "" and by_id[4]["n_removed"] == 0 and by_id[None]["n_removed"] == 0
    assert by_id[3]["text"] == " \n\t " and by_id[3]["n_lines"] == 0
    assert lines.dedupe_lines(empty(spark)).count() == 0


def test_stages_keep_columns_and_handle_awkward_documents(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for make, n in ((awkward, None), (empty, 0)):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, ""), f"test-{name}")
            assert docs.columns == columns
            assert n is None or docs.count() == n
        ids = {r["doc_id"] for r in docs.collect()}
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
        assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids


def test_pipeline_drops_copies_and_keeps_clean_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs = table.union(table.where("doc_id < 20").selectExpr("doc_id + 100000", "text", "lang", "source", "n_chars"))
    kept = corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.keep_languages(spark, docs, ""), "")
    ids = {r["doc_id"] for r in kept.collect()}
    assert max(ids) < 100000
    sets = {r["doc_id"]: shingles(r["text"]) for r in table.collect()}
    alone = {i for i in sets if not any(j < i and len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]) for j in sets)}
    assert alone <= ids


def test_every_dealt_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES} == set(range(1, 14))
