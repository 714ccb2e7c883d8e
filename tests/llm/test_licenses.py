"""License scans against loops over all blocks and templates."""

import random
import re

import pytest
from edge import awkward, empty, prose

from millrace.llm import licenses


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def plain(text, notices, containment):
    found = words(text)
    places = [
        (label, i)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(found))
        if found[i : i + len(phrase.split())] == phrase.split()
    ]
    blocks = set()
    for label, texts in notices.items():
        for notice in texts:
            wanted = words(notice)
            reach = 8
            while reach < len(wanted):
                reach *= 2
            for start in range(0, max(1, len(found)), reach):
                shared = len(set(wanted) & set(found[start : start + 2 * reach])) / len(set(wanted))
                if shared >= containment - 1e-12:
                    blocks.add((label, start, start + 2 * reach, round(shared, 12)))
    return len(found), sorted(places), sorted(blocks)


def made(row):
    blocks = {(b["label"], b["start"], b["end"], round(b["containment"], 12)) for b in row["blocks"]}
    return row["n_words"], sorted((p["label"], p["start"]) for p in row["places"]), sorted(blocks)


@pytest.mark.parametrize("containment", [0.5, 0.75, licenses.CONTAINMENT, 1.0])
def test_blocks_equal_all_pairs(spark, monkeypatch, containment):
    monkeypatch.setattr(licenses, "TEXT_BYTES", 3000)
    rng = random.Random(8)
    notices = licenses.TEMPLATES | {"odd": ["the of and red", "the of and red green stone river house paper light seven under", "one", "é ß 日本 the"]}
    every = [n for texts in notices.values() for n in texts]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(1, 7)):
            notice = rng.choice(every).split()
            if rng.random() < 0.6:
                notice = [w for w in notice if rng.random() < 0.9]
            if rng.random() < 0.3:
                rng.shuffle(notice)
            parts += [prose(rng, rng.randrange(0, 20)), rng.choice(["\n", " "]).join(notice), rng.choice([*licenses.PHRASES, "CC-BY", "cc\nBy nc", ""])]
        rows.append((i, rng.choice([" ", "\n", ". "]).join(parts)))
    rows += [(901, None), (902, ""), (903, " .\n"), (904, "cc"), (905, "by cc"), (906, "All Rights Reserved"), (907, (every[0] + " ") * 4000), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = licenses.scan_licenses(docs, notices=notices, containment=containment).collect()
    assert len(found) == len(rows)
    for row in found:
        assert made(row) == plain(row["text"], notices, containment), row["doc_id"]
    assert sum(len(r["blocks"]) > 0 for r in found) > 60


def test_phrases_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "text cc"), (2, "by all rights"), (3, "reserved")], "doc_id bigint, text string").coalesce(1)
    assert all(r["places"] == [] for r in licenses.scan_licenses(docs).collect())


def test_notices_must_have_words():
    with pytest.raises(ValueError):
        licenses.templates_of({"x": ["..."]})


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark).withColumnRenamed("pii", "blocks")
    rows = licenses.scan_licenses(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert made(row) == plain(row["text"], licenses.TEMPLATES, licenses.CONTAINMENT)
    assert licenses.scan_licenses(empty(spark)).count() == 0
