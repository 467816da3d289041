"""Exact cosine joins of vector tables, block by block.

Rows of each side are dealt into blocks by hash, and a task has one block of either side. There are about as many pairs of blocks as
keep all cores busy; only beyond MOST_ROWS rows a block, which bound a task's memory, there are more. The blocks are stored once in the
shared folder and each task reads its two, so a row takes room on disk once, however many blocks it meets. Rows that meet only inside
their groups are shuffled instead, a copy for each block met. Inside its task a pair of blocks is compared tile by tile, and what is
found leaves the task a tile at a time, so neither the pairs nor a dense matrix of a block are ever held.

Most pairs are told apart without their exact similarity. A task sorts its terms into a few classes that come together (the words of a
language, say); a row's weight in each class bounds its similarity to a tile, and tiles out of reach are not met. In the others, terms that
seldom meet share a column, where a row has the length of its part in them: the product of such columns, in single precision, is no less than
the similarity. Only pairs that it leaves in reach are compared, in double precision and entry by entry, or as matrices if they are many.

If each left row's last partner, or any one, is asked for, a task has one part of the left rows and meets the right blocks one after the other,
from the last rows on, so a row leaves as soon as it is matched.

``cell_join`` is for vectors of a known width. ``term_join`` is for any number of terms: a task keeps the entries of terms that both blocks
use; the most frequent of these become columns, the others are postings that meet term by term. Both are exact.

Inputs have ``pos`` (unique), ``idx`` and ``val``; zero vectors match nothing. Results have ``l``, ``r`` and ``sim``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.session import Workspace

# rows of one block that a task of the dense comparison holds, at most
MOST_ROWS = 65_536
# a term's postings are split until one task sees at most this many from either side, since a block has no more rows
POSTINGS_PER_TASK = 65_536
# found pairs that leave a task at once
PAIRS_PER_GROUP = 16384
# rows of one tile of the comparison; no block is smaller unless the table is
BLOCK_ROWS = 1024
# pairs of blocks for each core, if there are rows enough
TASKS_PER_CORE = 3
# terms that become columns if the width is not known; products of other terms' postings, and of pairs one by one, that are formed at once
COLUMNS = 1024
PRODUCTS_AT_ONCE = 4_000_000
ENTRIES_AT_ONCE = 250_000
# slack against rounding; final decisions use the rounded sims
SLACK = 1e-9
# sims are rounded so that a comparison does not depend on summation order
SIM_DIGITS = 12
# single precision errs by less than this for each column, four times the bound on a sum's rounding
SINGLE = 2.0**-22
# classes of terms that bound similarities, and the rows of a task that they are drawn from
CLASSES = 8
CLASS_ROWS = 1024
# numbers of columns that bounds may have, the rows on which they are tried, and the pairs from which on that pays
BOUND_COLUMNS = (64, 96, 128, 192, 256, 320, 384, 512, 768, 1024)
TRIAL_ROWS = 512
TRIAL_PAIRS = 16_000_000
# terms that are dealt to shared columns one by one, from the heaviest
DEALT_TERMS = 8_192
# a product of two entries met one by one takes as long as this many columns of a pair in a matrix product
ENTRY_COLUMNS = 1_000
# partners of a row in a tile that are tried one by one before all are
TRIES = 4
# numbers in the columns of a block that are held, not made anew for each tile
HELD_BOUNDS = 24_000_000

PAIR = pa.schema([("l", pa.int64()), ("r", pa.int64()), ("sim", pa.float64())])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row each belongs to."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


def _matrix(idx: pa.Array, val: pa.Array, width: int) -> np.ndarray:
    values, row = _flat(val)
    columns, _ = _flat(idx)
    out = np.zeros((len(val), width))
    out[row, columns] = values
    return out


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _stars(l: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the given ones connect: each id, but for the smallest of its component, to the smallest."""
    ids, at = np.unique(np.r_[l, r], return_inverse=True)
    a, b = at[: len(l)], at[len(l) :]
    low = np.arange(len(ids))
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, low[a], least)
        np.minimum.at(new, low[b], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == low).all():
            break
        low = new
    moved = np.flatnonzero(low != np.arange(len(ids)))
    return ids[low[moved]], ids[moved]


class _Block:
    """One side's rows of a task, in the order of ``pos``, with their entries (term, weight) row after row."""

    def __init__(self, rows: pa.Table):
        self.pos = rows["pos"].to_numpy()
        if (self.pos[1:] < self.pos[:-1]).any():
            rows = rows.sort_by("pos")
            self.pos = rows["pos"].to_numpy()
        self.term, row = _flat(_one(rows["idx"]))
        self.weight, _ = _flat(_one(rows["val"]))
        self._cut(row)
        self.earlier = self.since = None
        if "earlier" in rows.column_names:
            self.earlier = _flat(_one(rows["earlier"]))[0].reshape(len(self.pos), -1)
        if "since" in rows.column_names:
            self.since = rows["since"].to_numpy()

    def _cut(self, row: np.ndarray) -> None:
        self.terms = 1 + int(self.term.max(initial=0))
        self.start = np.r_[0, np.cumsum(np.bincount(row, minlength=len(self.pos)))]

    def copy(self) -> _Block:
        """For entries under other numbers."""
        other = _Block.__new__(_Block)
        other.__dict__.update(self.__dict__)
        return other

    def held(self) -> np.ndarray:
        """The ``pos`` that a row's partners are to be after."""
        return np.full(len(self.pos), np.iinfo(np.int64).min) if self.since is None else self.since - 1

    def renumber(self, terms: np.ndarray, numbers: np.ndarray) -> None:
        """Keep the entries of ``terms`` (ascending), under their new numbers."""
        row = np.repeat(np.arange(len(self.pos)), np.diff(self.start))
        at = np.minimum(np.searchsorted(terms, self.term), len(terms) - 1)
        kept = np.flatnonzero(terms[at] == self.term)
        self.term, self.weight = numbers[at[kept]], self.weight[kept]
        self._cut(row[kept])

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the tile, term, weight) of the given rows."""
        lengths = self.start[rows + 1] - self.start[rows]
        at = np.arange(lengths.sum()) + np.repeat(self.start[rows] - np.r_[0, np.cumsum(lengths)[:-1]], lengths)
        return np.repeat(np.arange(len(rows)), lengths), self.term[at], self.weight[at]


def _share_terms(left: _Block, right: _Block) -> int:
    """Drop the terms that only one side uses and number the others from the most frequent; the number of columns."""
    (a, n_a), (b, n_b) = (np.unique(x.term, return_counts=True) for x in (left, right))
    terms, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(terms) == 0:
        return 0
    numbers = np.empty(len(terms), np.int64)
    numbers[np.argsort(-(n_a[at_a] * n_b[at_b].astype(float)), kind="stable")] = np.arange(len(terms))
    for block in (left, right) if right is not left else (left,):
        block.renumber(terms, numbers)
    return min(len(terms), COLUMNS)


def _tile(block: _Block, rows: np.ndarray, width: int, kind: type = np.float64) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The rows' weights in columns, and their entries of the other terms in the order of the terms."""
    row, term, weight = block.entries(rows)
    x = np.zeros((len(rows), width), kind)
    rare = np.flatnonzero(term >= width)
    if len(rare) == 0:
        x[row, term] = weight
        return x, (row[:0], term[:0], weight[:0])
    dense = term < width
    x[row[dense], term[dense]] = weight[dense]
    rare = rare[np.argsort(term[rare], kind="stable")]
    return x, (row[rare], term[rare], weight[rare])


def _sims(left: tuple, right: tuple) -> np.ndarray:
    """Similarities of two tiles: the columns' product, and the products of the postings that meet at the other terms."""
    (x, (l_row, l_term, l_w)), (y, (r_row, r_term, r_w)) = left, right
    sims = x @ y.T
    if len(l_term) == 0 or len(r_term) == 0:
        return sims
    first = np.searchsorted(r_term, l_term)
    met = np.searchsorted(r_term, l_term, "right") - first
    until = np.cumsum(met)
    cuts = np.unique(np.r_[0, np.searchsorted(until, np.arange(PRODUCTS_AT_ONCE, until[-1], PRODUCTS_AT_ONCE)), len(met)])
    for a, b in zip(cuts[:-1], cuts[1:]):
        n = met[a:b]
        i = np.repeat(np.arange(a, b), n)
        j = np.arange(n.sum()) + np.repeat(first[a:b] - np.r_[0, np.cumsum(n)[:-1]], n)
        sims += np.bincount(l_row[i] * sims.shape[1] + r_row[j], l_w[i] * r_w[j], sims.size).reshape(sims.shape)
    return sims


def _pairs(l: np.ndarray, r: np.ndarray, sim: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(l), PAIRS_PER_GROUP):
        some = slice(k, k + PAIRS_PER_GROUP)
        yield pa.RecordBatch.from_arrays([pa.array(l[some], pa.int64()), pa.array(r[some], pa.int64()), pa.array(sim[some])], schema=PAIR)


def _term_classes(block: _Block) -> np.ndarray:
    """A class for each term, from terms that come together in some of the block's rows. Any classes give right bounds; these give low ones."""
    rows = np.arange(0, len(block.pos), math.ceil(len(block.pos) / CLASS_ROWS))
    row, term, weight = block.entries(rows)
    terms, at = np.unique(term, return_inverse=True)
    often = np.argsort(-np.bincount(at, weight * weight), kind="stable")[:COLUMNS]
    column = np.full(len(terms), -1)
    column[often] = np.arange(len(often))
    kept = np.flatnonzero(column[at] >= 0)
    x = np.zeros((len(rows), len(often)))
    x[row[kept], column[at[kept]]] = weight[kept]
    centre = x[[int(x.any(axis=1).argmax())]]
    while len(centre) < min(CLASSES, len(rows)):  # each the row that is farthest from those before
        near = (x @ centre.T).max(axis=1) / np.maximum(np.linalg.norm(x, axis=1), SLACK)
        centre = np.r_[centre, x[[int(near.argmin())]]]
    for _ in range(4):
        own = (x @ centre.T).argmax(axis=1)
        mean = np.array([x[own == c].sum(axis=0) for c in range(len(centre))])
        centre = mean / np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), SLACK)
    classes = np.zeros(int(term.max(initial=0)) + 1, np.int64)
    classes[terms[often]] = centre.argmax(axis=0)
    return classes


def _masses(block: _Block, classes: np.ndarray) -> np.ndarray:
    """The length of each row's part in each class: two rows' similarity is at most the product of theirs."""
    row = np.repeat(np.arange(len(block.pos)), np.diff(block.start))
    own = np.where(block.term < len(classes), classes[np.minimum(block.term, len(classes) - 1)], 0)
    return np.sqrt(np.bincount(row * CLASSES + own, block.weight**2, len(block.pos) * CLASSES)).reshape(-1, CLASSES)


def _class_tiles(mass: np.ndarray, descending: bool = False) -> list[np.ndarray]:
    """Tiles of rows whose weight is in the same class for the most part, pure and mixed rows apart; each ascends, and so do those of a class."""
    own, pure = mass.argmax(axis=1), mass.max(axis=1) > 0.9 * np.linalg.norm(mass, axis=1)
    tiles = []
    for group in range(2 * CLASSES):
        rows = np.flatnonzero((own == group // 2) & (pure == (group % 2 == 0)))
        cut = [rows[k : k + BLOCK_ROWS] for k in range(0, len(rows), BLOCK_ROWS)]
        tiles += reversed(cut) if descending else cut
    return tiles


def _bundles(mean: np.ndarray, many: int) -> np.ndarray:
    """A column for each term: the heaviest have one each, every other joins where it meets least, by the mean weights in each class of rows."""
    order = np.argsort(-mean.max(axis=0), kind="stable")
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order)) % many
    held = mean[:, order[:many]].T.copy()
    for term in order[many:DEALT_TERMS]:
        column[term] = (held @ mean[:, term]).argmin()
        held[column[term]] += mean[:, term]
    return column


class _Bounds:
    """Rows in the given columns of terms, in single precision; the product of two rows is no less than their similarity, but for rounding."""

    def __init__(self, column: np.ndarray):
        self.column, self.many = column, int(column.max(initial=0)) + 1
        self.alone = (np.bincount(column, minlength=self.many) == 1)[column]

    def of(self, block: _Block, rows: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        row, term, weight = block.entries(rows)
        alone = self.alone[term]
        if alone.all():
            x = np.zeros((len(rows), self.many), np.float32)
            x[row, self.column[term]] = weight
        else:
            at = row * self.many + self.column[term]
            x = np.sqrt(np.bincount(at, weight * weight, len(rows) * self.many)).astype(np.float32).reshape(len(rows), self.many)
            x.flat[at[alone]] = weight[alone]
        return x, (row[:0], term[:0], weight[:0])

    def slack(self, mass_l: np.ndarray, mass_r: np.ndarray) -> float:
        longest = float(np.linalg.norm(mass_l, axis=1).max() * np.linalg.norm(mass_r, axis=1).max())
        return SLACK + SINGLE * (self.many + 2) * max(1.0, longest)


def _bounds(left: _Block, right: _Block, mass_l: np.ndarray, mass_r: np.ndarray, t: float, width: int, leave: bool) -> _Bounds:
    """The columns that promise the least work, tried on some rows; any give right bounds. With ``leave``, rows leave as they are matched."""
    terms = max(left.terms, right.terms)
    plain = _Bounds(np.arange(terms) % width)
    if len(left.pos) * len(right.pos) < TRIAL_PAIRS:
        return plain
    l_rows, r_rows = (np.arange(0, len(b.pos), math.ceil(len(b.pos) / TRIAL_ROWS)) for b in (left, right))
    mean, entries = np.zeros((CLASSES, terms)), 0
    for block, rows, mass in ((left, l_rows, mass_l), (right, r_rows, mass_r)):
        row, term, weight = block.entries(rows)
        own = mass[rows].argmax(axis=1)[row]
        mean += np.bincount(own * terms + term, np.abs(weight), CLASSES * terms).reshape(CLASSES, terms)
        entries = len(row) / len(rows)

    def price(bounds: _Bounds, rows: np.ndarray) -> tuple[float, np.ndarray]:
        near = bounds.of(left, rows)[0] @ bounds.of(right, r_rows)[0].T >= t
        return bounds.many + min(ENTRY_COLUMNS * entries * near.mean(), 2 * width), near.any(axis=1)

    _, matched = price(plain, l_rows)
    if leave and (~matched).sum() >= len(l_rows) / 16:
        l_rows = l_rows[~matched]
    best, least = plain, price(plain, l_rows)[0] if terms <= width else math.inf
    for many in BOUND_COLUMNS:
        if many < min(least, terms):
            bounds = _Bounds(_bundles(mean, many))
            asked = price(bounds, l_rows)[0]
            if asked < least:
                best, least = bounds, asked
    return best


class _Partners:
    """Rows of a tile whose similarities are asked for, as matrix and postings once they are."""

    def __init__(self, block: _Block, rows: np.ndarray, width: int):
        self.block, self.rows, self.width, self._tile = block, rows, width, None

    def tile(self) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        if self._tile is None:
            self._tile = _tile(self.block, self.rows, self.width)
        return self._tile

    def matrix(self, left: _Block, rows: np.ndarray) -> np.ndarray:
        return np.round(_sims(_tile(left, rows, self.width), self.tile()), SIM_DIGITS)

    def pairs(self, left: _Block, rows: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Similarity of each of the left rows and the row of the tile beside it."""
        y, (p_row, p_term, p_weight) = self.tile()
        flat, n = y.ravel(), len(y)
        sims = np.empty(len(rows))
        length = left.start[rows + 1] - left.start[rows]
        until = np.cumsum(length)
        cuts = np.unique(np.r_[0, np.searchsorted(until, np.arange(ENTRIES_AT_ONCE, until[-1], ENTRIES_AT_ONCE)), len(rows)])
        for a, b in zip(cuts[:-1], cuts[1:]):
            lengths, before = length[a:b], until[a:b] - length[a:b]
            at = np.arange(before[0], until[b - 1]) + np.repeat(left.start[rows[a:b]] - before, lengths)
            term, first = left.term.take(at), np.repeat(col[a:b] * self.width, lengths)
            if left.terms <= self.width:
                product = flat.take(first + term)
            else:
                product = flat.take(first + np.minimum(term, self.width - 1))
                rare = np.flatnonzero(term >= self.width)
                keys, key = np.r_[p_term.astype(np.int64) * n + p_row, -1], term[rare].astype(np.int64) * n + first[rare] // self.width
                found = np.searchsorted(keys[:-1], key)
                product[rare] = np.where(keys[found] == key, np.r_[p_weight, 0.0][found], 0.0)
            product *= left.weight.take(at)
            sims[a:b] = np.bincount(np.repeat(np.arange(b - a), lengths), product, b - a)
        return np.round(sims, SIM_DIGITS)

    def many(self, left: _Block, rows: np.ndarray, number: int) -> bool:
        """Whether so many pairs of these rows take longer one by one than all of them as matrices."""
        entries = (left.start[rows + 1] - left.start[rows]).mean()
        return number * entries * ENTRY_COLUMNS > 2 * self.width * len(rows) * len(self.rows)


def _all_pairs(left: _Block, right: _Block, t: float, width: int, self_join: bool) -> Iterator[pa.RecordBatch]:
    same = left is right
    classes = _term_classes(right)
    mass_r = _masses(right, classes)
    mass_l = mass_r if same else _masses(left, classes)
    tiles_r = _class_tiles(mass_r)
    tiles_l = tiles_r if same else _class_tiles(mass_l)
    bounds = _bounds(left, right, mass_l, mass_r, t, width, False)
    slack = bounds.slack(mass_l, mass_r)
    held = [bounds.of(left, rows) for rows in tiles_l] if len(left.pos) * bounds.many <= HELD_BOUNDS else None
    for j, r_rows in enumerate(tiles_r):
        reach = mass_r[r_rows].max(axis=0)
        y, partners = held[j] if held and same else bounds.of(right, r_rows), _Partners(right, r_rows, width)
        for i, l_rows in enumerate(tiles_l):
            if same and i > j:
                break
            some = np.flatnonzero(mass_l[l_rows] @ reach >= t - slack)
            if len(some) == 0:
                continue
            l_rows = l_rows[some]
            near = _sims((held[i][0][some], y[1]) if held else bounds.of(left, l_rows), y) >= t - slack
            some = np.flatnonzero(near.any(axis=1))
            if len(some) == 0:
                continue
            l_rows, near = l_rows[some], near[some]
            row, col = np.divmod(np.flatnonzero(near), near.shape[1])
            if partners.many(left, l_rows, len(row)):
                sims = partners.matrix(left, l_rows)
                row, col = np.nonzero(sims >= t)
                sim = sims[row, col]
            else:
                sim = partners.pairs(left, l_rows[row], col)
                kept = sim >= t
                row, col, sim = row[kept], col[kept], sim[kept]
            l, r = left.pos[l_rows[row]], right.pos[r_rows[col]]
            # a tile that meets itself has each pair twice; tiles of one block need not be in the order of pos
            kept = l < r if same and i == j else np.ones(len(l), bool)
            if left.earlier is not None:
                kept &= ~(left.earlier[l_rows[row]] == right.earlier[r_rows[col]]).any(axis=1)
            l, r, sim = l[kept], r[kept], sim[kept]
            yield from _pairs(np.minimum(l, r), np.maximum(l, r), sim) if self_join else _pairs(l, r, sim)


def _best_of_each(left: _Block, right: _Block, t: float, width: int) -> Iterator[pa.RecordBatch]:
    """Each left row's best partner above ``t``, the first of equal ones."""
    best, partner = np.full(len(left.pos), t), np.full(len(left.pos), -1)
    for k in range(0, len(right.pos), BLOCK_ROWS):
        r_rows = np.arange(k, min(k + BLOCK_ROWS, len(right.pos)))
        y = _tile(right, r_rows, width)
        for n in range(0, len(left.pos), BLOCK_ROWS):
            l_rows = np.arange(n, min(n + BLOCK_ROWS, len(left.pos)))
            sims = _sims(_tile(left, l_rows, width), y)
            sims[left.pos[l_rows][:, None] == right.pos[r_rows][None, :]] = -2.0
            row = np.flatnonzero(sims.max(axis=1) > best[l_rows] - SLACK)
            sims = np.round(sims[row], SIM_DIGITS)
            col = sims.argmax(axis=1)
            sim = sims[np.arange(len(row)), col]
            better = sim > best[l_rows[row]]
            at = l_rows[row[better]]
            best[at], partner[at] = sim[better], r_rows[col[better]]
    found = np.flatnonzero(partner >= 0)
    yield from _pairs(left.pos[found], right.pos[partner[found]], best[found])


def _match(left: _Block, right: _Block, t: float, width: int, last: bool, held: np.ndarray, found: np.ndarray) -> None:
    """Mark left rows that have a partner here as ``found`` and hold its ``pos``: the last one, if that is after what they hold, or any one."""
    classes = _term_classes(right)
    mass_l, mass_r = _masses(left, classes), _masses(right, classes)
    # the number of the last row that is not asked for any more
    partner = np.searchsorted(right.pos, held, "right") - 1 if last else np.where(found, len(right.pos), -1)
    order = np.concatenate(_class_tiles(mass_l))  # rows of a class side by side
    order = order[partner[order] < len(right.pos) - 1 if last else ~found[order]]
    if len(order) == 0:
        return
    before = partner.copy()
    bounds = _bounds(left, right, mass_l, mass_r, t, width, True)
    slack = bounds.slack(mass_l, mass_r)
    x = None
    if len(order) * bounds.many <= HELD_BOUNDS:
        x = np.empty((len(order), bounds.many), np.float32)
        for n in range(0, len(order), BLOCK_ROWS):
            x[n : n + BLOCK_ROWS] = bounds.of(left, order[n : n + BLOCK_ROWS])[0]
    for r_rows in _class_tiles(mass_r, descending=last):
        still = np.flatnonzero(partner[order] < (r_rows[-1] if last else 0))
        still = still[mass_l[order[still]] @ mass_r[r_rows].max(axis=0) >= t - slack]
        if len(still) == 0:
            continue
        y, partners = bounds.of(right, r_rows), _Partners(right, r_rows, width)
        for n in range(0, len(still), BLOCK_ROWS):
            some = still[n : n + BLOCK_ROWS]
            l_rows = order[some]
            near = _sims((x[some], y[1]) if x is not None else bounds.of(left, l_rows), y) >= t - slack
            row = np.flatnonzero(near.any(axis=1))
            for _ in range(TRIES):
                col = _last_at(near[row])
                ahead = r_rows[col] > partner[l_rows[row]]
                row, col = row[ahead], col[ahead]
                if len(row) == 0:
                    break
                near[row, col] = False
                hit = partners.pairs(left, l_rows[row], col) >= t
                partner[l_rows[row[hit]]] = r_rows[col[hit]]
                row = row[~hit]
                row = row[near[row].any(axis=1)]
            if len(row) == 0:
                continue
            if partners.many(left, l_rows[row], int(near[row].sum())):
                col = _last_at(near[row] & (partners.matrix(left, l_rows[row]) >= t))
            else:
                at, col = np.divmod(np.flatnonzero(near[row]), near.shape[1])
                hit = partners.pairs(left, l_rows[row[at]], col) >= t
                best = np.full(len(row), -1)
                np.maximum.at(best, at[hit], col[hit])
                col = best
            row, col = row[col >= 0], col[col >= 0]
            partner[l_rows[row]] = np.maximum(partner[l_rows[row]], r_rows[col])
    new = np.flatnonzero(partner > before)
    held[new], found[new] = right.pos[partner[new]], True


def _one_of_each(left: _Block, right: _Block, t: float, width: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Each left row's last partner, or any one; a row is not compared with those before what it has."""
    held, found = left.held(), np.zeros(len(left.pos), bool)
    _match(left, right, t, width, last, held, found)
    yield from _pairs(left.pos[found], held[found], np.full(int(found.sum()), t))


def _last_at(hit: np.ndarray) -> np.ndarray:
    """The last column of each row that holds true, -1 if none does."""
    return np.where(hit.any(axis=1), hit.shape[1] - 1 - hit[:, ::-1].argmax(axis=1), -1)


def _connecting(left: _Block, right: _Block, t: float, width: int) -> Iterator[pa.RecordBatch]:
    """Edges that connect what pairs above ``t`` connect, fewer than the two blocks have rows."""
    l, r = np.empty(0, np.int64), np.empty(0, np.int64)
    for k in range(0, len(right.pos), BLOCK_ROWS):
        r_rows = np.arange(k, min(k + BLOCK_ROWS, len(right.pos)))
        y = _tile(right, r_rows, width)
        for n in range(0, min(len(left.pos), r_rows[-1] + 1) if left is right else len(left.pos), BLOCK_ROWS):
            l_rows = np.arange(n, min(n + BLOCK_ROWS, len(left.pos)))
            sims = _sims(_tile(left, l_rows, width), y)
            row, col = np.nonzero(sims > t - SLACK)
            sure = np.round(sims[row, col], SIM_DIGITS) > t
            a, b = _stars(left.pos[l_rows[row[sure]]], right.pos[r_rows[col[sure]]])
            l, r = np.r_[l, a], np.r_[r, b]
        l, r = _stars(l, r)
    yield from _pairs(l, r, np.full(len(l), t))


def _meet(left: _Block, right: _Block, t: float, width: int | None, self_join: bool, mode: str) -> Iterator[pa.RecordBatch]:
    columns = _share_terms(left, right) if width is None else width
    if columns == 0:
        return
    if mode == "all":
        yield from _all_pairs(left, right, t, columns, self_join)
    elif mode in ("any", "last"):
        yield from _one_of_each(left, right, t, columns, mode == "last")
    else:
        yield from {"best": _best_of_each, "connect": _connecting}[mode](left, right, t, columns)


def _read_rows(path: str, block: int) -> pa.Table | None:
    """A block's rows of a stored table, None if it has no rows."""
    fs, folder = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    folder = f"{folder}/block={block}"
    if fs.get_file_info(folder).type == pafs.FileType.NotFound:
        return None
    return pq.read_table(folder, filesystem=fs, partitioning=None, use_threads=False)


def _read_block(path: str, block: int) -> _Block | None:
    rows = _read_rows(path, block)
    return None if rows is None else _Block(rows)


def _compare(t: float, width: int | None, self_join: bool, mode: str, stored: tuple[str, str] | None = None):
    """A task's rows, those of the left side marked 0 and those of the right side 1; rows of a block that meets itself come once.

    With ``stored``, a task's rows are pairs of blocks of the tables at these two paths, or slices of the left one if one partner is asked for.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        side = rows["side"].to_numpy()
        own = self_join and rows["block_l"][0] == rows["block_r"][0]
        if rows.num_rows == 0 or (not own and (side.min() == 1 or side.max() == 0)):
            return
        left = _Block(rows.filter(pa.array(side == 0)))
        right = left if own else _Block(rows.filter(pa.array(side == 1)))
        del rows
        yield from _meet(left, right, t, width, self_join, mode)

    def match_stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of the left side, all at once, and the blocks of the right side from the last one on."""
        asked = pa.Table.from_batches(list(batches))
        tables = [_read_rows(stored[0], b) for b in asked["block_l"].to_pylist()]
        tables = [x for x in tables if x is not None]
        if not tables:
            return
        left = _Block(pa.concat_tables(tables))
        del tables
        held, found = left.held(), np.zeros(len(left.pos), bool)
        for r in range(asked["blocks_r"][0].as_py() - 1, -1, -1):
            right = _read_block(stored[1], r)
            if right is None:
                continue
            own = left if width is not None else left.copy()
            columns = _share_terms(own, right) if width is None else width
            if columns:
                _match(own, right, t, columns, mode == "last", held, found)
            if mode == "any" and found.all():
                break
        yield from _pairs(left.pos[found], held[found], np.full(int(found.sum()), t))

    def compare_stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for l, r in zip(batch.column("block_l").to_pylist(), batch.column("block_r").to_pylist()):
                left = _read_block(stored[0], l)
                right = left if self_join and l == r else left and _read_block(stored[1], r)
                if left is not None and right is not None:
                    yield from _meet(left, right, t, width, self_join, mode)

    if stored:
        return match_stored if mode in ("any", "last") else compare_stored
    return compare


def _store_blocks(ws: Workspace, rows: DataFrame, blocks: int, ranges: bool = False) -> str:
    """Write the rows once in their order, a folder for each block: dealt by hash, or by ``ranges`` of pos."""
    path = ws.path("blocks")
    block = F.pmod(F.xxhash64("pos"), F.lit(blocks))
    if ranges:
        cuts = rows.agg(F.percentile_approx("pos", [n / blocks for n in range(1, blocks)], 100 * blocks)).first()[0] if blocks > 1 else []
        block = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda cut: cut < F.col("pos")))
    dealt = rows.withColumn("block", block).repartition(blocks, "block")
    dealt.sortWithinPartitions("block", "pos").write.option("compression", "zstd").partitionBy("block").parquet(path)
    return path


def _stored_join(
    ws: Workspace, left: DataFrame, right: DataFrame, t: float, width: int | None, mode: str, rows_l: int, rows_r: int, side: int, most: int
) -> DataFrame:
    """The pairs of blocks of ``side`` rows, one at a time in a task; a table that meets itself has each pair once.

    If one partner of a left row is asked for, there are as many slices of the left side as there would be pairs. A task takes as many of
    them as it may hold, since it reads all of the right side, in blocks of ``most`` rows.
    """
    self_join = left is right
    cores = ws.spark.sparkContext.defaultParallelism
    blocks_l, blocks_r = (max(1, math.ceil(rows / side)) for rows in (rows_l, rows_r))
    if mode in ("any", "last"):
        slices, met_by_all = blocks_l * blocks_r, max(1, math.ceil(rows_r / most))
        stored = _store_blocks(ws, left, slices), _store_blocks(ws, right, met_by_all, True)
        tasks = min(slices, cores * max(1, math.ceil(rows_l / most / cores)))
        met = ws.spark.range(0, slices, 1, tasks).select(F.col("id").alias("block_l"), F.lit(met_by_all).alias("blocks_r"))
        return met.mapInArrow(_compare(t, width, self_join, mode, stored), "l long, r long, sim double").select("l", "r")
    path_l = _store_blocks(ws, left, blocks_l)
    path_r = path_l if self_join else _store_blocks(ws, right, blocks_r)
    if self_join:  # block i meets the blocks at distance d on a circle of all blocks
        tasks = blocks_l * (blocks_l + 1) // 2
        other = F.col("id") % blocks_l, (F.col("id") % blocks_l + F.floor(F.col("id") / blocks_l)) % blocks_l
        pair = F.least(*other).alias("block_l"), F.greatest(*other).alias("block_r")
    else:
        tasks = blocks_l * blocks_r
        pair = F.floor(F.col("id") / blocks_r).alias("block_l"), (F.col("id") % blocks_r).alias("block_r")
    most = 16 * TASKS_PER_CORE * cores
    met = ws.spark.range(0, tasks, 1, min(tasks, most)).select(*pair)
    return met.mapInArrow(_compare(t, width, self_join, mode, (path_l, path_r)), "l long, r long, sim double")


def _shuffled_join(
    ws: Workspace, left: DataFrame, right: DataFrame, t: float, width: int | None, mode: str, sizes: DataFrame, side: int,
    tasks: int, fields: list[str],
) -> DataFrame:
    """Rows that meet inside their groups only: a copy of each for each block of the other side in its group; ``tasks`` pairs of blocks at most."""
    self_join = left is right
    cores = ws.spark.sparkContext.defaultParallelism
    blocks = lambda c: F.ceil(F.col(c) / side).alias(c.replace("rows", "blocks"))
    splits = sizes.select("grp", blocks("rows_l"), blocks("rows_r"))
    parallel = max(int(ws.spark.conf.get("spark.sql.shuffle.partitions")), min(2 * tasks, 16 * TASKS_PER_CORE * cores))
    key = ["grp", "block_l", "block_r"]

    def spread(df: DataFrame, own: str, other: str, which: int) -> DataFrame:
        """Each row in the block of its own side, a copy for each block of the other side it meets there."""
        own_block, other_block = own.replace("blocks", "block"), other.replace("blocks", "block")
        first, last = F.lit(0).cast("bigint"), F.col(other) - 1
        placed = df.join(splits, "grp").withColumn(own_block, F.pmod(F.xxhash64("pos"), F.col(own)))
        if self_join:  # pairs of different blocks in one order only
            first, last = (F.col(own_block), last) if which == 0 else (first, F.col(own_block) - 1)
            placed = placed if which == 0 else placed.where(F.col(own_block) > 0)
        return placed.withColumn(other_block, F.explode(F.sequence(first, last))).select(*key, F.lit(which).alias("side"), *fields)

    both = spread(left, "blocks_l", "blocks_r", 0).unionByName(spread(right, "blocks_r", "blocks_l", 1))
    # the work is in the comparing, not in the bytes AQE goes by
    return both.repartition(parallel, *key).groupBy(*key).applyInArrow(_compare(t, width, self_join, mode), "l long, r long, sim double")


def _block_join(
    ws: Workspace, left: DataFrame, right: DataFrame | None, t: float, width: int | None, mode: str, most: int,
    group: str | None = None, earlier: str | None = None, since: str | None = None,
) -> DataFrame:
    if since and (group or mode != "last"):
        raise ValueError("since goes with last partners of all groups")
    self_join = right is None
    fields = ["pos", "idx", "val", *(["earlier"] if earlier else [])]
    grp = F.col(group).cast("string") if group else F.lit("")

    def usable(df: DataFrame, since: str | None = None) -> DataFrame:
        more = [F.col(name).alias(alias) for name, alias in ((earlier, "earlier"), (since, "since")) if name]
        return df.where((F.size("idx") > 0) & F.col("pos").isNotNull()).select(grp.alias("grp"), "pos", "idx", "val", *more)

    left = usable(left, since)
    right = left if self_join else usable(right)
    count = lambda df, name: df.groupBy("grp").agg(F.count("*").alias(name))
    sizes = count(left, "rows_l").withColumn("rows_r", F.col("rows_l")) if self_join else count(left, "rows_l").join(count(right, "rows_r"), "grp")
    sizes = ws.save(sizes, "sizes")
    product = F.col("rows_l").cast("double") * F.col("rows_r")
    work, rows_l, rows_r, groups = (x or 0 for x in sizes.agg(F.sum(product), F.sum("rows_l"), F.sum("rows_r"), F.count("*")).first())
    cores = ws.spark.sparkContext.defaultParallelism
    side = math.isqrt(int(work / (2 if self_join else 1) / (TASKS_PER_CORE * cores)))
    side = min(max(side, BLOCK_ROWS), most)
    if group is None:
        left = left.drop("grp")
        right = left if self_join else right.drop("grp")
        found = _stored_join(ws, left, right, t, width, mode, rows_l, rows_r, side, most)
    else:
        found = _shuffled_join(ws, left, right, t, width, mode, sizes, side, math.ceil(work / side**2 + (rows_l + rows_r) / side + groups), fields)
    if mode in ("any", "last") and group is not None:
        return found.groupBy("l").agg(F.max("r").alias("r"))
    if mode != "best":
        return found  # a row is in one slice, so it has its last partner already
    best = F.max_by(F.struct("r", "sim"), F.struct(F.col("sim"), -F.col("r")))
    return found.groupBy("l").agg(best.alias("b")).select("l", F.col("b.r").alias("r"), F.col("b.sim").alias("sim"))


def term_join(
    ws: Workspace, left: DataFrame, right: DataFrame | None, t: float, last_only: bool = False, any_only: bool = False, since: str | None = None
) -> DataFrame:
    """All pairs of sparse vectors with similarity at least ``t`` > 0; a self-join gives l < r only.

    With ``last_only``, of each left row's partners the one with the greatest ``pos``, in (l, r), and not before ``since``, if that column
    of the left rows is named; with ``any_only`` any one.
    """
    return _block_join(ws, left, right, t, None, "any" if any_only else "last" if last_only else "all", POSTINGS_PER_TASK, since=since)


def cell_join(
    ws: Workspace,
    left: DataFrame,
    right: DataFrame | None,
    t: float,
    width: int,
    best_only: bool = False,
    group: str | None = None,
    connect: bool = False,
    last_only: bool = False,
    earlier: str | None = None,
    any_only: bool = False,
    since: str | None = None,
) -> DataFrame:
    """All pairs with similarity at least ``t`` > 0, or only the best partner above ``t`` of each left row.

    With ``last_only``, of each left row's partners the one with the greatest ``pos``, in (l, r), and not before ``since``, if that column
    of the left rows is named: one row for each left row, however many are similar. With ``any_only``, any one of the partners.

    With ``connect``, edges that connect the rows that pairs above ``t`` connect: fewer from a pair of blocks than
    it has rows, however many pairs there are.

    With ``group``, only rows of the same group meet. ``earlier`` names a list column, of equal length inside a group: pairs that agree
    anywhere in it are left out, as those that have met under another group already.
    """
    mode = "best" if best_only else "any" if any_only else "last" if last_only else "connect" if connect else "all"
    return _block_join(ws, left, right, t, width, mode, MOST_ROWS, group, earlier, since)
