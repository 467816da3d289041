"""Stretches of words that repeat with a period, found by uniting suffix classes from the longest common prefix downwards.

Two suffixes of a text are in one class at level L if they share their first L words. Going down from the largest L, classes are
united with a union-find whose classes hold their positions in order. Say i < j become neighbours in such an order at level L:
they share exactly L words, so the words from i to j + L have the period j - i, and end there. If L reaches j - i this
is a repetition; nothing nearer than j follows i in its class, so the period is the smallest; and if the words before i
and j differ, nothing extends it to the left. So each run of words is met once, at its first word. A run of at least
``MIN_WORDS`` words and ``MIN_TIMES`` periods has L of at least two thirds of the shortest length, so
levels below that are not visited, and texts in which no window of that many words comes twice have no run.

Each row is worked on by itself: nothing is shuffled, and memory is proportional to the longest text. Windows are first compared
by hashes, which can only let too many texts through; classes are made of the words themselves.

Null, empty and short texts have no run; white space at the ends and between words is dropped. Null and repeated ids are kept, a row
for each row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.hashing import U64, mixed, pieces, runs, words

MIN_WORDS = 24
MIN_TIMES = 3


def least_level(min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> int:
    """The least common prefix of the first word of a run and the word a period later.

    It is the length less the period; the period is at most the length over ``min_times``.
    """
    return min(n - n // min_times for n in range(min_words, 2 * min_words))


def suffix_ranks(codes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of every suffix by prefix doubling; with it the positions that share ``level`` words with another, and their classes' first ranks.

    Only suffixes that are still tied take part in a round. ``level`` is a power of two.
    """
    n = len(codes)
    if not n:
        return codes, codes, codes
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = starts
    tied = order[~(first & np.r_[first[1:], True])]
    width, deep, deep_first = 1, None, None
    while True:
        if width == level:
            deep, deep_first = np.sort(tied), rank.copy()
        if not len(tied) or (deep is not None and width >= n):
            break
        at = tied + width
        follows = np.where(at < n, rank[np.minimum(at, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + follows
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        old = rank[tied]
        place = np.arange(len(tied))
        new = np.r_[True, key[1:] != key[:-1]]
        old_new = np.r_[True, old[1:] != old[:-1]]
        rank[tied] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(old_new, place, 0))
        tied = tied[~(new & np.r_[new[1:], True])]
        width *= 2
    if deep is None:
        deep, deep_first = tied, rank
    return rank, deep, deep_first


def links(codes: np.ndarray, level: int) -> tuple[list[int], list[int], list[int]]:
    """Neighbours in suffix order with at least ``level`` words in common, from the most down: (common words, position, position)."""
    power = 1 << (level.bit_length() - 1)
    rank, deep, deep_first = suffix_ranks(codes, power)
    if not len(deep):
        return [], [], []
    # places in suffix order of the deep positions; the one before such a place is deep too, but for the first of a class
    place = rank[deep]
    by_place = np.argsort(place)
    near = np.empty(len(deep), np.int64)
    near[by_place[0]] = -1
    near[by_place[1:]] = deep[by_place[:-1]]
    near[deep_first[deep] == place] = -1
    word, n = memoryview(np.ascontiguousarray(codes, np.int64)), len(codes)
    lengths = np.zeros(len(deep), np.int64)
    common = last = 0
    for k, (i, j) in enumerate(zip(deep.tolist(), near.tolist())):
        if j < 0:
            common = 0
        else:
            # the suffix before had one word more in common, if it was the position before
            common = max(common - (i - last), 0)
            while i + common < n and j + common < n and word[i + common] == word[j + common]:
                common += 1
            lengths[k] = common
        last = i
    good = np.flatnonzero(lengths >= level)
    good = good[np.argsort(-lengths[good], kind="stable")]
    return lengths[good].tolist(), near[good].tolist(), deep[good].tolist()


def periodic_runs(codes: np.ndarray, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of the codes that are long enough, by start, then period."""
    found: list[tuple[int, int, int]] = []
    word = memoryview(np.ascontiguousarray(codes, np.int64))

    def seed(i: int, j: int, common: int) -> None:
        period = j - i
        if common >= (min_times - 1) * period and common + period >= min_words and (i == 0 or word[i - 1] != word[j - 1]):
            found.append((i, common + period, period))

    place: dict[int, list[int]] = {}  # class of a position: its positions in order
    for common, a, b in zip(*links(codes, least_level(min_words, min_times))):
        small, large = place.get(a) or [a], place.get(b) or [b]
        if len(small) > len(large):
            small, large = large, small
        n, after_last = len(large), -1
        for k, x in enumerate(small):
            at = bisect_left(large, x)
            # neighbours from the other class only: x follows one of them, or stands before one, with none of its own between
            if at and large[at - 1] > after_last:
                seed(large[at - 1], x, common)
            if at < n and (k + 1 == len(small) or small[k + 1] > large[at]):
                seed(x, large[at], common)
            after_last = x
        if len(small) == 1:
            large.insert(bisect_left(large, small[0]), small[0])
        else:
            large += small
            large.sort()  # two ascending stretches: linear
        if n == 1:
            place[large[0]] = place[large[1]] = large
        for x in small:
            place[x] = large
    return sorted(found, key=lambda r: (r[0], r[2]))


def coded(found: list[bytes], first: int = 0) -> np.ndarray:
    """Words as numbers from ``first`` on, equal for equal words."""
    names: dict[bytes, int] = {}
    return np.array([names.setdefault(w, first + len(names)) for w in found], np.int64)


def has_twice(texts: pa.Array, k: int) -> np.ndarray:
    """Which rows may hold the same k consecutive words at two places (by hashes: never missed, seldom too many)."""
    hashes, rows = words(texts)
    counts = np.diff(rows)
    row = np.repeat(np.arange(len(counts)), counts)
    window = runs(hashes, k)
    inside = np.arange(len(window)) + k <= rows[1:][row[: len(window)]]
    row, window = row[: len(window)][inside], window[inside]
    key = mixed(window ^ mixed(row.astype(U64) + U64(1)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(counts), bool)
    out[row[order[1:][same]]] = True
    return out


def repeated_tail(found: list[bytes], doc_id) -> list[bytes] | None:
    """The rule of the query's test stretches: every tenth id has its words from some place on replaced by a repetition; else None."""
    if doc_id is None or not found:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g, n = h // 10, len(found)
    a = g % n
    block = found[a : a + 1 + (n - a) // (3 + g % 8)]
    return found[:a] + (block * (-(-(n - a) // len(block))))[: n - a]


NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
SCHEMA = ", ".join(f"{name} {'string' if 'sha256' in name else 'long'}" for name in NAMES)


def described(found: list[bytes], held: list[tuple[int, int, int]]) -> tuple:
    """The values of SCHEMA for one text and its runs."""
    best = None
    for run in held:  # by start, then period: of equal exponents the first stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    listed = "".join([f"{s},{n},{p}\n" for s, n, p in held])
    if held:
        gone = bytearray(len(found))
        for start, length, period in held:
            gone[start + period : start + length] = b"\1" * (length - period)
        found = [w for w, g in zip(found, gone) if not g]
    kept = hashlib.sha256(b" ".join(found)).hexdigest()
    top = (None, None, None, None) if best is None else (*best, 1000 * best[1] // best[2])
    return len(held), *top, hashlib.sha256(listed.encode()).hexdigest(), kept


def run_rows(docs: DataFrame, change=None, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: the id, number of runs, the run with the greatest length over period, and digests.

    ``runs_sha256`` is of all runs as ``start,length,period`` lines; ``collapsed_sha256`` of the text in which each run keeps its
    first period only. ``change`` (words, id) may give other words for a text, or None to leave it as it is.
    """
    level = least_level(min_words, min_times)

    def run(batches):
        for batch in pieces((b for b in batches if b.num_rows), 1 << 20):
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            twice = has_twice(texts, level).tolist()
            rows = []
            for doc_id, text, again in zip(batch.column("id").to_pylist(), texts.to_pylist(), twice):
                found = text.split()  # of bytes: at ASCII white space only
                other = change(found, doc_id) if change else None
                if other is not None:
                    found, again = other, True
                rows.append(described(found, periodic_runs(coded(found), min_words, min_times) if again and len(found) >= min_words else []))
            columns = [pa.array(c, pa.string() if "sha256" in name else pa.int64()) for c, name in zip(zip(*rows), NAMES)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=[id_col, *NAMES])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"`{id_col}` {dict(picked.dtypes)['id']}, {SCHEMA}")
