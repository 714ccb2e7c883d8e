"""Texts of an Arrow batch as one byte buffer, and vectorised hashing over it.

The helpers work on whole texts. A chunk holds some documents, at least one and
otherwise at most ``limit`` bytes, so that memory follows the longest document and
not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
#: Bytes that separate words: space and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    kept = _powers.get(0)
    if kept is None or len(kept[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for base in (_BASE, _INVERSE):
            out = np.full(size, base, U64)
            out[0] = 1
            both.append(np.cumprod(out, dtype=U64))
        kept = (both[0], both[1])
        if size <= 4 * CHUNK_BYTES:
            _powers[0] = kept
    return kept[0][:n], kept[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_chunks(
    batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of documents; a null text is empty."""
    array = batch.column(batch.schema.get_field_index(column))
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    n = len(array)
    if not n:
        return
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, array.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums of a polynomial hash; one longer than the data."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODES[data] * powers(len(data) + 1)[0][1:], dtype=U64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans that depend on their content alone."""
    inverse = powers(len(prefix))[1]
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(U64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the end) of runs without white space."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = cuts[cuts > 0] - 1
    last[ends_at] = inside[ends_at]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of equal runs in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.r_[0, cuts], np.r_[cuts, len(keys)]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links a-b: every node that is not the least of its component, and that least node."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    rest = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[rest], nodes[root[rest]]


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of the runs of marked bytes; no run crosses a document's end."""
    edge = np.diff(np.r_[np.int8(0), inside.view(np.int8), np.int8(0)])
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    if len(cuts):
        starts, ends = np.sort(np.r_[starts, cuts]), np.sort(np.r_[ends, cuts])
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def packed_words(data: np.ndarray, taken: np.ndarray, sizes: np.ndarray) -> pa.LargeStringArray:
    """The marked bytes as strings of these sizes, in order."""
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[taken].tobytes()))


def filled(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Marks the bytes of spans that do not overlap."""
    edge = np.zeros(size + 1, np.int8)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1], dtype=np.int8).view(bool)
