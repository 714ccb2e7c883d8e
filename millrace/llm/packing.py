"""Packing: documents as token ids in sequences of at most 2048, by length combinations.

A window of documents (whole rows of a partition, ``WINDOW_DOCS`` of them) is packed on its own,
so nothing is shuffled. Lengths beyond a sequence are cut into full sequences first. The rest fall
into ``CLASSES`` length classes. All combinations of two to ``DEPTH`` classes that can fill a sequence
exactly are enumerated; non-negative least squares finds how often to repeat each so that the
histogram of lengths is used up, and the counts are rounded down. A combination takes documents of its
classes whose lengths add up to the sequence: the last two are searched as a pair of the wanted sum. Documents
left over are packed greedily, longest first, as long as others fill the sequence exactly; what no others
fill is laid end to end and cut at full sequences, and the window's remainder is cut into powers of two,
which are not padded. So there is no padding at all, and a document that fits a sequence is cut only at the end.

Null and empty texts have the end-of-text id only. A document of any length is cut as often
as needed. Repeated rows are packed each. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.buffers import text_chunks
from millrace.llm.registry import query, table

SEQUENCE = 2048
CLASSES = 32
DEPTH = 4
WINDOW_DOCS = 4096
#: Ids held of one window, at least one document's.
WINDOW_IDS = 1 << 24
END_ID = 1
CACHE_WORDS = 1_000_000
#: The tokenizer's own cuts, for words of Latin characters without numbers other than digits.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
ODD = re.compile("[\x80-\xa0\xad\xb2\xb3\xb9\xbc-\xbe\u0130]")
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint"
)


class WordEncoder:
    """Ids of a word-level BPE: each distinct word is encoded once.

    Texts are cut at spaces and line ends, which this vocabulary drops. Words of Latin characters
    are put in small letters and cut as the tokenizer does it, and the parts go to its BPE model;
    all others go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.raw = [np.array([i], "<u4").tobytes() for i in range(self.whole.get_vocab_size())]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        # Byte-level vocabularies write a byte without a visible character as one from 256 on.
        self.bytes_as = {b: chr(256 + i) for i, b in enumerate(hidden)}

    def part(self, part: str) -> bytes:
        """Ids of a run of letters, a digit or a run of signs, in small letters."""
        found = self.parts.get(part)
        if found is None:
            as_bytes = part if part.isascii() else part.encode().decode("latin-1").translate(self.bytes_as)
            found = self.parts[part] = b"".join([self.raw[t.id] for t in self.whole.model.tokenize(as_bytes)])
        return found

    def word(self, word: str) -> bytes:
        simple = word.isascii() or (max(word) < "\u0180" and not ODD.search(word))
        if simple and min(word) > " " and "<|" not in word:
            parts = PARTS.findall(word.lower())
            out = self.part(parts[0]) if len(parts) == 1 else b"".join([self.part(p) for p in parts])
        else:
            out = self.full(word)
        self.known[word] = out
        return out

    def full(self, word: str) -> bytes:
        return b"".join([self.raw[i] for i in self.whole.encode(word, add_special_tokens=False).ids])

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.parts = {"": b""}, {}
        known, parts = self.known, []
        for word in text.replace("\n", " ").split(" "):
            ids = known.get(word)
            parts.append(self.word(word) if ids is None else ids)
        return b"".join(parts)


def combinations(classes: int = CLASSES, depth: int = DEPTH) -> np.ndarray:
    """Counts by class of two to ``depth`` documents that can fill a sequence exactly, one column each.

    Class c holds lengths from c / classes of a sequence up to the next class; of the sums of lower ends that leave
    room for an exact fill, those are taken where half the documents' places within their class fill it.
    """
    found = {}
    for k in range(2, depth + 1):
        for combo in combinations_with_replacement(range(classes), k):
            if classes - (k + 1) // 2 <= sum(combo) <= classes - k // 2:
                column = np.bincount(combo, minlength=classes)
                found[column.tobytes()] = column
    return np.array(list(found.values())).T.astype(float)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    gram, target = a.T @ a, a.T @ b
    for _ in range(rounds):
        w = target - gram @ x
        w[active] = -np.inf
        j = int(np.argmax(w))
        if not np.isfinite(w[j]) or w[j] <= 1e-7 * max(1.0, np.abs(target).max()):
            break
        active[j] = True
        while True:
            idx = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if (s > 1e-10).all():
                x[:] = 0
                x[idx] = s
                break
            low = s <= 1e-10
            step = np.min(x[idx][low] / (x[idx][low] - s[low] + 1e-300))
            x[idx] += step * (s - x[idx])
            drop = idx[x[idx] <= 1e-10]
            x[drop] = 0
            active[drop] = False
            if not len(drop):
                break
    return x


def plan(histogram: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Repeats of each combination, rounded down and within the histogram."""
    used = (columns[histogram == 0] == 0).all(axis=0)
    repeats = np.zeros(columns.shape[1], np.int64)
    if used.any() and histogram.any():
        repeats[used] = np.floor(nnls(columns[:, used], histogram.astype(float)) + 1e-9)
    left = histogram - (columns @ repeats).astype(np.int64)
    for j in np.flatnonzero(repeats):
        over = columns[:, j] > 0
        while repeats[j] and (left[over] < 0).any():
            repeats[j] -= 1
            left += columns[:, j].astype(np.int64)
    return repeats


class Stock:
    """Documents by length that are not packed yet."""

    def __init__(self, rest: np.ndarray, sequence: int) -> None:
        self.docs: list[list[int]] = [[] for _ in range(sequence)]
        for i in np.flatnonzero(rest)[::-1].tolist():
            self.docs[rest[i]].append(i)
        self.count = np.array([len(d) for d in self.docs], np.int64)

    def take(self, length: int) -> int:
        self.count[length] -= 1
        return self.docs[length].pop()

    def back(self, length: int, doc: int) -> None:
        self.count[length] += 1
        self.docs[length].append(doc)

    def longest(self, lo: int, hi: int) -> int:
        """The largest length in stock from lo up to and without hi; 0 without one."""
        found = np.flatnonzero(self.count[lo:hi])
        return lo + int(found[-1]) if len(found) else 0

    def pair(self, need: int, first: tuple[int, int], second: tuple[int, int]) -> int:
        """The largest x of the first range in stock where need - x is of the second and in stock; 0 without one."""
        lo, hi = max(first[0], need - second[1] + 1, 1), min(first[1], need - second[0] + 1, need)
        if lo >= hi:
            return 0
        both = (self.count[lo:hi] > 0) & (self.count[need - hi + 1 : need - lo + 1][::-1] > 0)
        if need % 2 == 0 and lo <= need // 2 < hi:
            both[need // 2 - lo] = self.count[need // 2] > 1
        found = np.flatnonzero(both)
        return lo + int(found[-1]) if len(found) else 0


def exact_member(stock: Stock, members: list[int], width: int, sequence: int) -> list[tuple[int, int]]:
    """(length, document) of one document per class that fill the sequence exactly, taken from stock; empty without any.

    All but two classes give their longest, then their shortest document; the last two are searched for a pair.
    """
    ranges = [(max(1, c * width), min((c + 1) * width, sequence)) for c in members]
    for shortest in (False, True):
        got: list[tuple[int, int]] = []
        need = sequence
        for lo, hi in ranges[:-2]:
            inside = np.flatnonzero(stock.count[lo:hi])
            if not len(inside):
                break
            length = lo + int(inside[0 if shortest else -1])
            got.append((length, stock.take(length)))
            need -= length
        else:
            x = stock.pair(need, *ranges[-2:]) if need > 1 else 0
            if x:
                return [*got, (x, stock.take(x)), (need - x, stock.take(need - x))]
        for length, doc in got:
            stock.back(length, doc)
    return []


def exact_rest(stock: Stock, length: int, sequence: int) -> list[tuple[int, int]]:
    """A document of this length and others that fill the rest exactly, taken from stock; only itself where none do.

    Longest first: each step looks for one document, then for two, and else takes the longest that leaves room.
    """
    got = [(length, stock.take(length))]
    need = sequence - length
    while need:
        if stock.count[need]:
            return [*got, (need, stock.take(need))]
        x = stock.pair(need, (1, sequence), (1, sequence))
        if x:
            return [*got, (x, stock.take(x)), (need - x, stock.take(need - x))]
        x = stock.longest(1, need)
        if not x:
            break
        got.append((x, stock.take(x)))
        need -= x
    for x, doc in got[1:]:
        stock.back(x, doc)
    return got[:1]


def pack(lengths: np.ndarray, columns: np.ndarray, sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; lengths are positive."""
    out: list[tuple[int, int, int, int, int]] = []
    seq = 0
    classes = columns.shape[0]
    width = sequence // classes
    rest = lengths % sequence
    for i in np.flatnonzero(lengths >= sequence):
        for start in range(0, int(lengths[i] - rest[i]), sequence):
            out.append((int(i), start, sequence, seq, 0))
            seq += 1
    stock = Stock(rest, sequence)

    def laid(members: list[tuple[int, int]]) -> None:
        nonlocal seq
        offset = 0
        for length, i in members:
            out.append((i, int(lengths[i]) - length, length, seq, offset))
            offset += length
        seq += 1

    histogram = np.bincount(rest[rest > 0] // width, minlength=classes)
    repeats = plan(histogram, columns)
    for j in np.flatnonzero(repeats):
        # Classes of few documents first, so that the pair is searched in the two with most.
        members = sorted(np.repeat(np.arange(classes), columns[:, j].astype(int)).tolist(), key=lambda c: histogram[c])
        for _ in range(int(repeats[j])):
            found = exact_member(stock, members, width, sequence)
            if not found:
                break
            laid(found)
    ends: list[tuple[int, int]] = []
    while length := stock.longest(1, sequence):
        found = exact_rest(stock, length, sequence)
        if len(found) > 1:
            laid(found)
        else:
            # Others of this length would fail alike, so that many equal short documents are not tried one by one.
            ends += found + [(length, stock.take(length)) for _ in range(int(stock.count[length]))]
    total = sum(length for length, _ in ends)
    room = [sequence] * (total // sequence) + [1 << k for k in range(sequence.bit_length(), -1, -1) if (total % sequence) >> k & 1]
    offset, at = 0, 0
    for size, i in ends:
        start = int(lengths[i]) - size
        while size:
            fits = min(size, room[at] - offset)
            out.append((i, start, fits, seq + at, offset))
            start, size, offset = start + fits, size - fits, offset + fits
            if offset == room[at]:
                at, offset = at + 1, 0
    return out


def pack_ids(df: DataFrame, encoder: Callable[[], Callable[[str], bytes]], key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece. ``encoder`` makes, once per task, a function from a text to its ids' bytes."""
    columns = combinations()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        end = np.array([END_ID], "<u4").tobytes()
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        keys: list[int] = []
        held: list[bytes] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, size
            lengths = np.array([len(h) // 4 for h in held], np.int64)
            doc, start, length, seq, offset = np.array(pack(lengths, columns, sequence), np.int64).T
            crc = [zlib.crc32(held[i][4 * s : 4 * (s + n)]) for i, s, n in zip(doc, start, length, strict=True)]
            owners = pa.array(keys, pa.int64()).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays(
                [owners, pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(lengths[doc]), pa.array(seq + first), pa.array(offset)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            first += int(seq.max()) + 1
            keys.clear()
            held.clear()
            size = 0

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, offsets in text_chunks(batch, "text"):
                for i in range(lo, hi):
                    value = data[offsets[i - lo] : offsets[i - lo + 1]].tobytes().decode()
                    keys.append(ids[i])
                    held.append(encode(value) + end)
                    size += len(held[-1]) // 4
                    if len(held) >= WINDOW_DOCS or size >= WINDOW_IDS:
                        yield from flush()
        if held:
            yield from flush()

    return df.select(df[key].cast("bigint").alias("doc_id"), df[text].alias("text")).mapInArrow(run, PIECES)


def word_encoder(path: str) -> Callable[[], Callable[[str], bytes]]:
    return lambda: WordEncoder(path).encode


@query("op6_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_ids(table(spark, sf_dir, "documents"), word_encoder(public_tokenizers.path("word_bpe_49k.json")))
