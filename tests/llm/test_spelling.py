"""Spelling variants against loops over all words and pairs."""

import random
import re
import zlib

import pytest
from edge import awkward, empty

from millrace.llm import spelling

LETTERS = "abcdefghijklmnopqrstuvwxyzàéîõüÿ"


def plain_words(rows, min_points=7, min_count=2):
    counts = {}
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_points:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= min_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts):
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def edited(rng, word):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(LETTERS) + word[at:]
    return word[:at] + ("" if kind == 1 else rng.choice(LETTERS)) + word[at + 1 :]


def crowd(rng, stems, tries):
    """Words with chains of edits, repeated letters and few letters, so that many share bigrams."""
    words = {}
    for _ in range(stems):
        letters = rng.choice(["ab", "abé", "aaab", LETTERS])
        stem = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 14)))
        for _ in range(tries):
            words[stem] = rng.choice([2, 3, 25, 40, 400, 5000])
            stem = edited(rng, stem)
    return {w: n for w, n in words.items() if len(w) >= 7}


@pytest.mark.parametrize("block", [3, spelling.BLOCK])
def test_forms_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    counts = crowd(random.Random(block), 60, 9)
    counts |= {"é" * 64: 2, "é" * 65: 20, "é" * 66: 200, "ab" * 40: 2, "ab" * 39 + "b": 30}
    made = spelling.variant_forms(spark.createDataFrame(sorted(counts.items()), "word string, n bigint"))
    want = plain_forms(counts)
    assert found(made) == want
    assert sum(v[0] is not None for v in want.values()) > 20
    assert any(v[0] != v[1] and v[0] is not None for v in want.values())


def test_words_equal_the_loop(spark, tmp_path):
    rng = random.Random(5)
    stems = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(5, 12))) for _ in range(40)]
    rows = []
    for i in range(900):
        words = [rng.choice(stems) if rng.random() < 0.95 else edited(rng, rng.choice(stems)) for _ in range(40)]
        rows.append((i if i % 50 else None, rng.choice([" ", "-", "1", "×", "日", "\n"]).join(w.title() for w in words)))
    rows += [(7, None), (8, ""), (9, "Straße " * 3 + "ÀÉÎÕÜŸ ÀÉÎÕÜÝab"), (10, "a" * 300_000 + " " + "é" * 70_001 + " " + "é" * 70_001)]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert found(spelling.spelling_variants(spark, str(tmp_path))) == plain_forms(plain_words(rows))
    counted = {r["word"]: r["n"] for r in spelling.count_words(docs).collect()}
    assert counted == plain_words(rows, min_count=1)


def test_pivots_are_the_rarest_that_share_no_letter():
    import numpy as np

    rng = np.random.default_rng(3)
    place = np.sort(np.array([rng.choice(9, 3, replace=False) for _ in range(500)]), axis=1)
    cost = rng.integers(1, 30, place.shape).astype(float)
    a, b = spelling.pivots_of(place, cost)
    for p, c, i, j in zip(place, cost, a, b, strict=True):
        fits = [c[x] + c[y] for x in range(3) for y in range(x) if p[x] - p[y] >= 2]
        assert p[j] - p[i] >= 2
        assert c[i] + c[j] == min(fits)


def test_awkward_and_empty_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    assert {r["word"]: r["n"] for r in spelling.count_words(awkward(spark)).collect()} == plain_words(rows, min_count=1)
    assert spelling.variant_forms(spelling.count_words(empty(spark))).count() == 0
