"""Without groups, a row is stored in its block once and read from there; no copy of it is shuffled for each block that it meets."""

import numpy as np
import pytest

from ticketmill.operators import similarity as sm


def rows(spark, x):
    entries = [(i, [int(k) for k in np.flatnonzero(v)], [float(w) for w in v[v != 0]]) for i, v in enumerate(x)]
    return spark.createDataFrame(entries, "pos long, idx array<int>, val array<double>")


def unit(seed, n, dims, terms):
    rng = np.random.default_rng(seed)
    x = np.zeros((n, dims))
    for v in x:
        v[rng.choice(dims, terms, replace=False)] = rng.random(terms) + 0.1
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("most", [16, 50])  # an even and an odd number of blocks
def test_each_row_takes_room_once(spark, ws, monkeypatch, most):
    monkeypatch.setattr(sm, "BLOCK_ROWS", 8)
    monkeypatch.setattr(sm, "MOST_ROWS", most)
    received, compare = [], sm._compare

    def counting(*args):
        inner, counted = compare(*args), spark.sparkContext.accumulator(0)
        received.append(counted)

        def run(batches: sm.Iterator[sm.pa.RecordBatch]) -> sm.Iterator[sm.pa.RecordBatch]:
            held = list(batches)
            counted.add(sum(b.num_rows for b in held))
            yield from inner(iter(held))

        return run

    monkeypatch.setattr(sm, "_compare", counting)
    x, y = unit(1, 250, 30, 10), unit(2, 120, 30, 10)
    paths, save = [], sm._store_blocks
    monkeypatch.setattr(sm, "_store_blocks", lambda *args: paths.append(save(*args)) or paths[-1])
    sims, cross = np.round(x @ x.T, sm.SIM_DIGITS), np.round(x @ y.T, sm.SIM_DIGITS)
    found = [(p.l, p.r) for p in sm.cell_join(ws, rows(spark, x), None, 0.6, 30).collect()]
    assert sorted(found) == [(i, j) for i, j in np.argwhere(sims >= 0.6) if i < j]
    last = {p.l: p.r for p in sm.cell_join(ws, rows(spark, x), rows(spark, y), 0.6, 30, last_only=True).collect()}
    assert last == {i: int(np.flatnonzero(row >= 0.6)[-1]) for i, row in enumerate(cross) if (row >= 0.6).any()}
    assert [spark.read.parquet(p).count() for p in paths] == [250, 250, 120]
    blocks = [-(-n // most) for n in (250, 250, 120)]
    assert [c.value for c in received] == [blocks[0] * (blocks[0] + 1) // 2, blocks[1] * blocks[2]]
