"""What is compared on the way to leaders and similar pairs, and that pairs at the threshold itself are told apart."""

import numpy as np
import pyarrow as pa
import pytest

from ticketmill.operators import leaders as ld
from ticketmill.operators import similarity as sm


def unit(seed, n, dims, terms, first=0):
    rng = np.random.default_rng(seed)
    x = np.zeros((n, dims))
    for v in x:
        v[first + rng.choice(dims // 2, terms, replace=False)] = rng.random(terms) + 0.1
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def block(x):
    idx = [[int(k) for k in np.flatnonzero(v)] for v in x]
    return sm._Block(pa.table({"pos": pa.array(range(len(x)), pa.int64()), "idx": pa.array(idx, pa.list_(pa.int32())), "val": [v[v != 0].tolist() for v in x]}))


def table(spark, x):
    rows = [(i, [int(k) for k in np.flatnonzero(v)], [float(w) for w in v[v != 0]]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "pos long, idx array<int>, val array<double>")


def pairs(batches, *columns):
    return [p for b in batches for p in zip(*(b.column(c).to_pylist() for c in columns))]


def test_a_row_meets_the_leaders_twice_at_most(spark, ws):
    """Once to be set aside, once to find its last one; rows decided before were met again in each later batch, leaders too."""
    x = unit(3, 90, 40, 3)
    near, asked = ld.dense_near(ws, 0.6, 40), []

    def counting(left, right, **more):
        if right is not None:
            asked.append(left.count())
        return near(left, right, **more)

    leaders, links = ld.leader_links(ws, table(spark, x), counting, first_batch=6)
    similar = np.round(x @ x.T, sm.SIM_DIGITS) >= 0.6
    heads = sorted(r.pos for r in leaders.collect())
    assert {r.l: r.r for r in links.collect()} == {i: max(h for h in heads if similar[i, h]) for i in range(90)}
    assert links.count() == 90 and 10 < len(heads) < 80
    assert sum(asked) <= (90 - 6) + (90 - len(heads))


def test_tiles_of_other_words_are_not_multiplied(monkeypatch):
    monkeypatch.setattr(sm, "BLOCK_ROWS", 8)
    x = np.r_[unit(4, 64, 40, 6), unit(5, 64, 40, 6, first=20)]
    x = x[np.random.default_rng(6).permutation(128)]
    done, sims = [], sm._sims
    monkeypatch.setattr(sm, "_sims", lambda a, b: done.append(len(a[0]) * len(b[0])) or sims(a, b))
    whole = block(x)
    found = pairs(sm._all_pairs(whole, whole, 0.7, 40, True), "l", "r")
    want = np.round(x @ x.T, sm.SIM_DIGITS) >= 0.7
    assert sorted(found) == [(i, j) for i, j in np.argwhere(want) if i < j] and found
    assert sum(done) < 0.75 * 128 * 128 / 2  # with both precisions


@pytest.mark.parametrize("step", [0, 1e-12, -1e-12, 1e-7, -1e-7])
def test_pairs_at_the_threshold(step, monkeypatch):
    """Single precision cannot tell them apart; the result is that of the rounded similarities in double."""
    monkeypatch.setattr(sm, "BLOCK_ROWS", 16)
    x = unit(7, 80, 30, 8)
    sims = np.round(x @ x.T, sm.SIM_DIGITS)
    for t in np.round(np.quantile(sims[np.triu_indices(80, 1)], [0.9, 0.97]), sm.SIM_DIGITS) + step:
        want = sims >= t
        whole, other = block(x), block(x)
        assert sorted(pairs(sm._all_pairs(whole, whole, t, 30, True), "l", "r")) == [(i, j) for i, j in np.argwhere(want) if i < j]
        last = dict(pairs(sm._one_of_each(whole, other, t, 30, True), "l", "r"))
        assert last == {i: int(np.flatnonzero(row)[-1]) for i, row in enumerate(want)}
        some = dict(pairs(sm._one_of_each(whole, block(x[:20]), t, 30, False), "l", "r"))
        assert some.keys() == set(np.flatnonzero(want[:, :20].any(axis=1))) and all(want[p] for p in some.items())
