"""The filter audit against loops over all documents and orders."""

import random
import re
from itertools import permutations

import pytest
from edge import awkward, empty, prose

from millrace.llm import audit


def plain(docs, labels):
    good, toxic = {}, {}
    for key, quality, bad in labels:
        good[key] = good.get(key, 0) or int(quality == 1)
        toxic[key] = toxic.get(key, 0) or int(bad == 1)
    rows = []
    for key, text, source in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        copies = [k for k, t, _ in docs if (t or "") == text and k is not None]
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": key is not None and key > min(copies),
        }
        known = (good.get(key, 0), toxic.get(key, 0)) if key is not None else (0, 0)
        rows.append((source or "", fails, *known))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [r for r in left if r[1][f]]
                redundant = sum(r[1][f] for r in gone)
                left = [r for r in left if not r[1][f]]
                gone += here
                alone = sum(r[0] == part and r[1][f] and sum(r[1].values()) == 1 for r in rows)
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
                out[part, "".join(order), step] = [len(left), len(here), redundant, alone, sum(r[2] for r in here), sum(r[3] for r in here)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def made(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("shard_bytes, hot", [(2000, 3), (audit.SHARD_BYTES, audit.HOT)])
def test_report_equals_the_loop(spark, monkeypatch, shard_bytes, hot):
    monkeypatch.setattr(audit, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(audit, "HOT", hot)
    rng = random.Random(4)
    common = prose(rng, 70)
    docs = []
    for i in range(160):
        text = rng.choice([common, prose(rng, rng.randrange(1, 120)), " ".join(f"w{rng.randrange(400)}" for _ in range(90))])
        if rng.random() < 0.3:
            text = text.title() + rng.choice(["", " #", "\n|", " é\x0bñ"])
        docs.append((rng.choice([i, i, 7, None]), text, rng.choice(["hot", "hot", "s", None])))
    docs += [(500, None, "s"), (501, "", "t"), (502, None, None), (503, "ab " * 30_000, "t")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in rng.sample(range(160), 90)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(5)
    report = audit.audit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    want = plain(docs, labels)
    assert made(report) == want
    assert len(want) == 600 * 4


def test_terms_have_one_number_each(spark, monkeypatch):
    monkeypatch.setattr(audit, "SHARD_BYTES", 50)
    docs = spark.createDataFrame([(i, f"one two two w{i} é", "s") for i in range(40)], "doc_id bigint, text string, source string")
    shards = audit.document_terms(docs.repartition(3)).persist()
    from pyspark.sql import functions as F

    words = shards.select("shard", F.posexplode("words").alias("place", "word"))
    numbered = audit.number_words(words).join(words, ["shard", "place"]).select("word", "term").distinct().collect()
    assert len(numbered) == len({r["word"] for r in numbered}) == len({r["term"] for r in numbered}) == 43
    shards.unpersist()


def test_awkward_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 1), (7, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward(spark).collect()]
    assert made(audit.audit(awkward(spark), labels)) == plain(rows, [(1, 1, 1), (7, 1, 0)])
    assert made(audit.audit(awkward(spark), labels.limit(0))) == plain(rows, [])
    assert audit.audit(empty(spark), labels).count() == 0


def test_pieces_of_a_shard_equal_the_loop(spark, monkeypatch):
    monkeypatch.setattr(audit, "PIECE_BYTES", 300)
    rng = random.Random(9)
    texts = [prose(rng, rng.randrange(60)) for _ in range(60)] + [None, "", " \n", "one", "ab " * 3000, "é# " + "A" * 900, ""]
    texts += rng.sample(texts, 20)
    docs = [(rng.choice([i, i, None, 3]), text, rng.choice(["s", "t", None])) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(2)
    shards = audit.document_terms(frame).select("shard", "start", "ids", "words").collect()
    assert len({r["shard"] for r in shards}) == 2 < len(shards)
    for shard in {r["shard"] for r in shards}:
        words, at = [], 0
        for r in (r for r in shards if r["shard"] == shard):
            assert r["start"] == at
            words += r["words"]
            at += len(r["words"])
        assert len(words) == len(set(words))
    labels = [(i, rng.choice([0, 1]), rng.choice([0, 1])) for i in range(40)]
    report = audit.audit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert made(report) == plain(docs, labels)


def test_rows_of_a_shard_stay_small(spark):
    """A shard of megabytes comes in rows of a quarter megabyte; each is a batch of its own in Python and one array in the JVM."""
    docs = [(i, " ".join(f"w{i * j % 9973}" for j in range(4000)), "s") for i in range(100)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").coalesce(1)
    rows = audit.document_terms(frame).selectExpr("shard", "size(ids) AS n", "aggregate(points, 0L, (a, b) -> a + b) AS size", "size(words) AS words").collect()
    assert sum(r["n"] for r in rows) == 100 and sum(r["size"] for r in rows) == sum(len(text) for _, text, _ in docs)
    assert max(r["size"] for r in rows) <= 1 << 18
    assert len({r["shard"] for r in rows}) == 1 and max(r["words"] for r in rows) < 9973 / 5
