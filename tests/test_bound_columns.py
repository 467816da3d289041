"""Columns that several terms share tell most pairs apart with fewer products, and a row leaves once it is matched; results stay exact."""

import numpy as np
import pyarrow as pa
import pytest

from ticketmill.operators import leaders as ld
from ticketmill.operators import similarity as sm

WIDTH = 400


def texts(seed, n, negative=False):
    """Rows of a few frequent and many rare terms, some near copies among them."""
    rng = np.random.default_rng(seed)
    x = np.zeros((n, WIDTH))
    for k, v in enumerate(x):
        if k % 5 == 4:
            v[:] = x[rng.integers(k)] * (rng.random(WIDTH) < 0.9)
        v[rng.choice(8, 3, replace=False)] += 0.5 + rng.random(3)
        v[8 + rng.choice(WIDTH - 8, 12, replace=False)] += rng.random(12) * (rng.choice([-1, 1], 12) if negative else 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def entries(x):
    return [(i, [int(k) for k in np.flatnonzero(v)], [float(w) for w in v[v != 0]]) for i, v in enumerate(x)]


def block(x):
    pos, idx, val = zip(*entries(x))
    return sm._Block(pa.table({"pos": pa.array(pos, pa.int64()), "idx": pa.array(idx, pa.list_(pa.int32())), "val": list(val)}))


def table(spark, x):
    return spark.createDataFrame(entries(x), "pos long, idx array<int>, val array<double>")


def pairs(batches):
    return [p for b in batches for p in zip(*(b.column(c).to_pylist() for c in ("l", "r")))]


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("BLOCK_ROWS", 64), ("TRIAL_PAIRS", 0), ("TRIAL_ROWS", 128), ("BOUND_COLUMNS", (64, 96, 128, 192)), ("ENTRY_COLUMNS", 20)):
        monkeypatch.setattr(sm, name, value, raising=False)


@pytest.mark.parametrize("negative", [False, True])
@pytest.mark.parametrize("held", [0, 10**9])
def test_fewer_products_and_the_same_pairs(small, monkeypatch, negative, held):
    monkeypatch.setattr(sm, "HELD_BOUNDS", held, raising=False)
    x = texts(1, 640, negative)
    done, sims = [], sm._sims
    monkeypatch.setattr(sm, "_sims", lambda a, b: done.append(len(a[0]) * len(b[0]) * a[0].shape[1]) or sims(a, b))
    whole, first = block(x), block(x[:320])
    near = np.round(x @ x.T, sm.SIM_DIGITS) >= 0.8
    assert sorted(pairs(sm._all_pairs(whole, whole, 0.8, WIDTH, True))) == [(i, j) for i, j in np.argwhere(near) if i < j]
    if not negative:
        assert sum(done) < 0.6 * WIDTH * len(x) ** 2 / 2
    last = {i: int(np.flatnonzero(row)[-1]) for i, row in enumerate(near[:, :320]) if row.any()}
    assert dict(pairs(sm._one_of_each(whole, first, 0.8, WIDTH, True))) == last and len(last) > 320
    some = dict(pairs(sm._one_of_each(whole, first, 0.8, WIDTH, False)))
    assert some.keys() == last.keys() and all(near[p] for p in some.items())


def test_terms_without_a_column_are_bounded_too(small, monkeypatch):
    monkeypatch.setattr(sm, "COLUMNS", 70)
    monkeypatch.setattr(sm, "ENTRIES_AT_ONCE", 100, raising=False)
    x = texts(2, 300)
    near = np.round(x @ x.T, sm.SIM_DIGITS) >= 0.8
    whole = block(x)
    assert sorted(pairs(sm._meet(whole, whole, 0.8, None, True, "all"))) == [(i, j) for i, j in np.argwhere(near) if i < j]


def test_last_partners_over_several_blocks(spark, ws, monkeypatch):
    monkeypatch.setattr(sm, "BLOCK_ROWS", 16)
    monkeypatch.setattr(sm, "MOST_ROWS", 40)
    x, y = texts(3, 150), texts(3, 300)
    near = np.round(x @ y.T, sm.SIM_DIGITS) >= 0.8
    since = np.arange(1, 151)
    left = table(spark, x).withColumn("since", sm.F.col("pos") + 1)
    found = sm.cell_join(ws, left, table(spark, y), 0.8, WIDTH, last_only=True, since="since").collect()
    want = {i: int(np.flatnonzero(row)[-1]) for i, row in enumerate(near) if row[since[i] :].any()}
    assert {p.l: p.r for p in found} == want and len(found) == len(want) and 10 < len(want) < 150
    every = sm.cell_join(ws, left, table(spark, y), 0.8, WIDTH, any_only=True).collect()
    assert sorted(p.l for p in every) == list(range(150)) and all(near[p.l, p.r] for p in every)


def test_rows_ask_only_later_leaders_at_the_end(spark, ws):
    """Leaders of batches before a row's own have been looked through when it was set aside."""
    x = texts(4, 200)
    near, asked = ld.dense_near(ws, 0.8, WIDTH), []

    def noting(left, right, **more):
        if "since" in left.columns:
            asked.extend((r.pos, r.since) for r in left.select("pos", "since").collect())
        return near(left, right, **more)

    leaders, links = ld.leader_links(ws, table(spark, x), noting, first_batch=20)
    similar = np.round(x @ x.T, sm.SIM_DIGITS) >= 0.8
    heads = sorted(r.pos for r in leaders.collect())
    assert {r.l: r.r for r in links.collect()} == {i: max(h for h in heads if similar[i, h]) for i in range(200)}
    starts = [0, 20, 60, 140]
    assert sorted(asked) == [(i, max(s for s in starts if s <= i)) for i in range(200) if i not in heads] and asked
