"""License scans: an exact set-similarity join of text blocks with templates.

Words are runs of digits, letters and code points from U+0080 on, A-Z in lower case. A template is a notice of a known
license, taken as a set of words. Templates of up to m words, m a power of two, meet blocks of 2 m words that start every m
words, so that any m neighbouring words lie in one block. A block matches if it holds ``CONTAINMENT`` of a template's words.

The join orders all template words by how often they stand in all documents, the rarest first. A template that must share c of
its t words is indexed by its first t - c + 1 only, as every match holds one of these (prefix filter). A block of fewer than c
template words is no match (length filter), and of a pair only the words after the first shared one on either side can
still agree (positional filter). The pairs left are counted exactly. So every block at the threshold is found.
Templates are a parameter, bounded by ``MAX_TEMPLATE_WORDS``, and go to every task.

Besides, fixed phrases are found where their words follow each other.

Null and empty texts have no words, no labels and score 0. Texts of any length are taken whole. Every row is judged on
its own, so repeated rows and ids get the same result each, and ties need no rule. Extra columns are kept, those named like a
result are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.buffers import packed_words, spans_of, text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import extended

#: Texts of so many bytes are scanned together in a task.
TEXT_BYTES = 1 << 23
#: Share of a template's words that a block must hold.
CONTAINMENT = 0.9
MIN_BLOCK = 8
MAX_TEMPLATE_WORDS = 1_000_000

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices by which the public licenses are commonly named.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Released under the BSD License",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "gpl-3.0": [
        "licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain",
    ],
}

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
#: Bytes of words once A-Z are in lower case.
WORD = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(words of a chunk of documents in order, the document of each)."""
    data = LOWER[data]
    inside = WORD[data]
    starts, ends, doc = spans_of(inside, offsets)
    return packed_words(data, inside, ends - starts).dictionary_encode(), doc


def split_words(text: str) -> list[str]:
    raw = np.frombuffer(text.encode(), np.uint8)
    words, _ = words_of(raw, np.array([0, len(raw)]))
    return words.to_pylist()


@dataclass(frozen=True)
class Template:
    """A notice: its label, its distinct words, the most words of a passage, and how many words a block must hold."""

    label: str
    words: tuple[str, ...]
    reach: int
    need: int


def templates_of(notices: Mapping[str, Sequence[str]], containment: float = CONTAINMENT) -> list[Template]:
    """The notices by label as templates; a notice without words, or more words than tasks can hold, is an error."""
    made = []
    for label, texts in notices.items():
        for text in texts:
            words = split_words(text)
            if not words:
                raise ValueError(f"a notice of {label} has no words")
            reach = max(MIN_BLOCK, 1 << (len(words) - 1).bit_length())
            distinct = tuple(dict.fromkeys(words))
            made.append(Template(label, distinct, reach, ceil(containment * len(distinct) - 1e-9)))
    if sum(len(t.words) for t in made) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words for one task")
    return made


def word_counts(df: DataFrame, text: str, vocabulary: Sequence[str]) -> DataFrame:
    """(word, n) over all texts, for the words given; one row per word and batch is shuffled at most."""
    known = pa.array(vocabulary, pa.large_string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch, "text", TEXT_BYTES):
                words, _ = words_of(data, offsets)
                place = pc.index_in(words.dictionary, known).fill_null(-1).to_numpy()
                counts = np.bincount(words.indices.to_numpy(), minlength=len(place))
                total[place[place >= 0]] += counts[place >= 0]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([known.take(pa.array(some)).cast(pa.string()), pa.array(total[some])], ["word", "n"])

    return df.select(df[text].alias("text")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """The templates of one block size with their words as ranks, and the postings of their prefixes."""

    def __init__(self, templates: Sequence[Template], rank: Mapping[str, int]) -> None:
        self.reach = templates[0].reach
        self.label = [t.label for t in templates]
        sets = [np.sort([rank[w] for w in t.words]) for t in templates]
        self.size = np.array([len(s) for s in sets])
        self.need = np.array([t.need for t in templates])
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.ranks = np.concatenate(sets)
        posting = [
            (int(word), t, i)
            for t, (s, need) in enumerate(zip(sets, self.need, strict=True))
            for i, word in enumerate(s[: len(s) - need + 1])
        ]
        self.word, self.template, self.place = (np.array(c) for c in zip(*sorted(posting), strict=True))


def matches(doc: np.ndarray, place: np.ndarray, rank: np.ndarray, index: Index) -> tuple[np.ndarray, ...]:
    """(document, block, template, shared words) of every match, from the places of template words, rank by rank.

    ``place`` counts a document's words. Block b holds its words from b * reach on, twice ``reach`` of them.
    """
    block = place // index.reach
    # A word lies in the block that starts before it and in the one before that.
    doc = np.concatenate([doc, doc[block > 0]])
    rank = np.concatenate([rank, rank[block > 0]])
    block = np.concatenate([block, block[block > 0] - 1])
    width = int(block.max(initial=0)) + 1
    key = doc * width + block
    keep = np.isin(key, key[np.isin(rank, index.word)])
    many = int(rank.max(initial=0)) + 1
    cell = np.unique(key[keep] * many + rank[keep])
    key, rank = cell // many, cell % many
    first, last = np.searchsorted(key, key, "left"), np.searchsorted(key, key, "right")
    # Probe the postings with every word of a block, in the global order.
    low, high = np.searchsorted(index.word, rank, "left"), np.searchsorted(index.word, rank, "right")
    n = high - low
    entry = np.repeat(np.arange(len(cell)), n)
    post = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    template, i = index.template[post], index.place[post]
    pair = key[entry] * len(index.label) + template
    order = np.lexsort((i, pair))
    order = order[np.concatenate([[True], pair[order][1:] != pair[order][:-1]])] if len(order) else order
    entry, template, i = entry[order], template[order], i[order]
    need, size = index.need[template], last[entry] - first[entry]
    ahead = 1 + np.minimum(index.size[template] - i - 1, last[entry] - entry - 1)
    keep = (size >= need) & (ahead >= need)
    entry, template = entry[keep], template[keep]
    n = index.size[template]
    owner = np.repeat(np.arange(len(entry)), n)
    word = index.ranks[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(index.start[template], n)]
    wanted = key[entry][owner] * many + np.minimum(word, many - 1)
    at = np.minimum(np.searchsorted(cell, wanted), max(len(cell) - 1, 0))
    held = (cell[at] == wanted) & (word < many) if len(cell) else np.zeros(0, bool)
    shared = np.bincount(owner[held], minlength=len(entry))
    good = shared >= index.need[template]
    entry, template, shared = entry[good], template[good], shared[good]
    return key[entry] // width, key[entry] % width, template, shared


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    notices: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """All columns with n_words, places (array of phrase label and start) and blocks (label, start, end, containment).

    Starts and ends count words of the text, ends exclusive; a block's end may lie beyond the text's.
    """
    templates = templates_of(notices, containment)
    counts = {r["word"]: r["n"] for r in word_counts(df, text, sorted({w for t in templates for w in t.words})).collect()}
    order = sorted({w for t in templates for w in t.words}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    indexes = [Index([t for t in templates if t.reach == m], rank) for m in sorted({t.reach for t in templates})]
    spoken = [(label, split_words(phrase)) for phrase, label in phrases.items()]
    extra = sorted({w for _, words in spoken for w in words} - set(rank))
    known = pa.array([*order, *extra], pa.large_string())
    number = {w: i for i, w in enumerate([*order, *extra])}
    base = df.drop("n_words", "places", "blocks")
    schema = extended(
        base,
        ("n_words", "bigint"),
        ("places", "array<struct<label:string,start:bigint>>"),
        ("blocks", "array<struct<label:string,start:bigint,end:bigint,containment:double>>"),
    )

    def lists(n: int, doc: np.ndarray, names: list[str], columns: list[pa.Array]) -> pa.Array:
        by = np.argsort(doc, kind="stable")
        ends = np.searchsorted(doc[by], np.arange(n + 1))
        items = pa.StructArray.from_arrays([c.take(pa.array(by)) for c in columns], names)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, text, TEXT_BYTES):
                n = hi - lo
                words, doc = words_of(data, offsets)
                code = pc.index_in(words.dictionary, known).fill_null(-1).to_numpy()[words.indices.to_numpy()]
                first = np.searchsorted(doc, np.arange(n + 1))
                place = np.arange(len(doc)) - first[doc]
                found, labels = [], []
                for label, parts in spoken:
                    at = np.flatnonzero(code == number[parts[0]])
                    at = at[at + len(parts) <= len(code)]
                    for k, part in enumerate(parts[1:], 1):
                        at = at[(code[at + k] == number[part]) & (doc[at + k] == doc[at])]
                    found.append(at)
                    labels += [label] * len(at)
                at = np.concatenate([np.zeros(0, np.int64), *found])
                places = lists(n, doc[at], ["label", "start"], [pa.array(labels, pa.string()), pa.array(place[at])])
                some = np.flatnonzero((code >= 0) & (code < len(order)))
                made: list[tuple[np.ndarray, ...]] = []
                labels = []
                for index in indexes:
                    owner, block, template, shared = matches(doc[some], place[some], code[some], index)
                    start = block * index.reach
                    made.append((owner, start, start + 2 * index.reach, shared / index.size[template]))
                    labels += [index.label[t] for t in template.tolist()]
                owner, start, end, share = (np.concatenate([c for c in column]) for column in zip(*made, strict=True)) if made else [np.zeros(0, np.int64)] * 4
                columns = [pa.array(labels, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(share, pa.float64())]
                blocks = lists(n, owner, ["label", "start", "end", "containment"], columns)
                rows = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.diff(first)), places, blocks], schema.names)

    return base.mapInArrow(run, schema)


def joined(labels: object) -> object:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def oracle(notices: Mapping[str, Sequence[str]] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """The query in SQL: blocks and templates compared pair by pair."""
    values = ", ".join(
        f"({i}, '{t.label}', {t.reach}, {t.need}, {len(t.words)}, [{', '.join(repr(w) for w in t.words)}])"
        for i, t in enumerate(templates_of(notices, containment))
    )
    return rf"""
WITH t AS (SELECT * FROM (VALUES {values}) v(tid, label, reach, need, size, words)
), tw AS (SELECT tid, label, reach, need, size, unnest(words) AS word FROM t
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM d
), s AS (
  SELECT doc_id, i, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), b AS (
  SELECT doc_id, i, CASE WHEN word = 'cc' AND w1 = 'by' THEN 'cc-by'
    WHEN word = 'general' AND w1 = 'public' AND w2 = 'license' THEN 'gpl'
    WHEN word = 'all' AND w1 = 'rights' AND w2 = 'reserved' THEN 'reserved' END AS label FROM s
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM b WHERE label IS NOT NULL GROUP BY doc_id
), hits AS (
  SELECT doc_id, tid, label, need, size, word, unnest(CASE WHEN i >= reach THEN [i // reach, i // reach - 1] ELSE [0] END) AS block
  FROM w JOIN tw USING (word)
), m AS (
  SELECT doc_id, label, count(DISTINCT word)::DOUBLE / size AS share FROM hits
  GROUP BY doc_id, tid, label, block, need, size HAVING count(DISTINCT word) >= need
), found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS score FROM m GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op12_license_scan", oracle())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"),
        joined(F.concat("places.label", "blocks.label")).alias("labels"),
        F.coalesce(F.array_max("blocks.containment"), F.lit(0.0)).alias("score"),
    )
