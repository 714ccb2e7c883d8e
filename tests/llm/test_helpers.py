import random
import re

import numpy as np
import pyarrow as pa

from millrace.llm import buffers
from millrace.llm.tables import components, whole_groups

SAMPLES = ["", " ", "a b", "\n", "x\ty\r\nz", "é è", None, "one", " lead", "trail ", "日本 語"]


def chunks(texts, limit=1 << 21):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    return list(buffers.text_chunks(batch, "text", limit))


def test_text_chunks_cover_all_rows_in_order():
    for limit in (1, 3, 1 << 21):
        rows = []
        for lo, hi, data, offsets in chunks(SAMPLES, limit):
            assert hi > lo and len(offsets) == hi - lo + 1
            rows += [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:], strict=False)]
        assert rows == [t or "" for t in SAMPLES]
    assert chunks([]) == []


def test_word_spans_and_hashes_depend_on_content_only():
    seen = {}
    for _, _, data, offsets in chunks(SAMPLES * 3):
        starts, ends, first = buffers.word_spans(data, offsets)
        for i, text in enumerate(SAMPLES * 3):
            words = [data[s:e].tobytes().decode() for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
            assert words == re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for s, e, h in zip(starts, ends, buffers.span_hash(buffers.prefix_hash(data), starts, ends), strict=True):
            assert seen.setdefault(data[s:e].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_forest_and_components_agree(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    links += [(200, i) for i in range(201, 260)]
    low = {}

    def find(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        low[max(x, y)] = min(x, y)
    expected = {n: find(n) for n in low if any(n in e and e[0] != e[1] for e in links)}
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in rows} == expected and len(rows) == len(expected)
    a, b = np.array(links).T
    node, root = buffers.forest(a, b)
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == {n: c for n, c in expected.items() if n != c}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_whole_groups_never_split_a_key():
    keys = np.sort(np.random.default_rng(1).integers(0, 40, 500))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 7])], ["k"]) for i in range(0, 500, 7)]
    tables = list(whole_groups(iter(batches), ["k"]))
    assert np.array_equal(np.concatenate([t["k"].to_numpy() for t in tables]), keys)
    ends = [set(t["k"].to_pylist()) for t in tables]
    assert all(not (x & y) for x, y in zip(ends, ends[1:], strict=False))
