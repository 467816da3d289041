"""Words and word shingles of whole Arrow columns as 64-bit hashes, without a Python loop over words.

Words are the runs of other than ASCII white space, with A-Z in lower case. A word's hash is a polynomial in its bytes
modulo 2^64, taken from running sums over the column's bytes and then mixed; a shingle's hash mixes those of its words.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# bytes hashed at a time: the running sums take 8 bytes for each
CHUNK = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: U64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def give_back() -> None:
    """Memory that is free goes back to the system, as a worker outlives its task and others need room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batches, limit: int = 1 << 20):
    """Arrow batches as smaller ones of about ``limit`` bytes, so that the arrays a task derives from them stay small."""
    try:
        for batch in batches:
            rows = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
            if rows >= batch.num_rows:
                yield batch
                continue
            for s in range(0, batch.num_rows, rows):
                yield batch.slice(s, rows)
    finally:
        give_back()


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row starts, with the end as last entry; nulls are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def word_bounds(data: np.ndarray, row_starts: np.ndarray, outside: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are not ``outside``; the end of a row ends a run too."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~outside[data]
    cut = np.zeros(n + 1, bool)
    cut[row_starts] = True
    starts = np.flatnonzero(inside & (cut[:n] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (cut[1:] | np.r_[~inside[1:], True])) + 1
    return starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, heads: tuple[int, ...] = ()) -> list[np.ndarray]:
    """Hashes of disjoint, ascending spans of the bytes as they are.

    For each length in ``heads`` another array has the hashes of the first so many bytes of the spans that have them.
    """
    out: list[list[np.ndarray]] = [[np.zeros(0, U64)] for _ in range(1 + len(heads))]
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(int(np.searchsorted(ends, base + CHUNK, side="right")), at + 1)
        size = int(ends[to - 1] - base)
        up = _powers(BASE, size)
        sums = np.empty(size + 1, U64)
        sums[0] = 0
        np.cumsum((data[base : base + size].astype(U64) + U64(1)) * up, out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        down = _powers(BASE_INVERSE, size)[s]
        low = sums[s]
        out[0].append((sums[e] - low) * down)
        for k, head in enumerate(heads, 1):
            has = e - s >= head
            out[k].append((sums[s[has] + head] - low[has]) * down[has])
        at = to
    return [mixed(np.concatenate(x) ^ U64(0x2545F4914F6CDD1D)) for x in out]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the column, and the offset of each row's first word (with the end as last entry)."""
    data, rows = flat_bytes(texts)
    starts, ends = word_bounds(data, rows)
    return hash_spans(LOWER[data], starts, ends)[0], np.searchsorted(starts, rows)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries, by the position of the first; shorter by k - 1."""
    n = max(len(hashes) - k + 1, 0)
    acc = np.full(n, k, U64)
    for j in range(k):
        acc = mixed(acc + hashes[j : j + n] * U64(2 * j + 3))
    return acc


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row, ascending as signed numbers: all values, and offsets by row.

    A row with fewer words has its whole sequence as one shingle, a row without words has none.
    """
    hashes, rows = words(texts)
    every = runs(hashes, k).view(np.int64)
    counts = np.diff(rows)
    parts, sizes = [], np.zeros(len(counts), np.int64)
    for i, (at, c) in enumerate(zip(rows[:-1].tolist(), counts.tolist(), strict=True)):
        if c >= k:
            own = np.sort(every[at : at + c - k + 1])
            if len(own) > 1:
                own = own[np.r_[True, own[1:] != own[:-1]]]
        elif c:
            own = runs(hashes[at : at + c], c).view(np.int64)
        else:
            continue
        parts.append(own)
        sizes[i] = len(own)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.r_[0, np.cumsum(sizes)]
