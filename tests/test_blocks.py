"""Similarity joins in blocks and tiles: bounded copies, and terms without columns."""

import numpy as np

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


def test_a_row_is_copied_to_few_blocks_also_if_no_bound_parts_the_rows(spark, ws, monkeypatch):
    """Vectors without structure, very many blocks' worth of them: cells around pivots held a copy of each in nearly every cell."""
    monkeypatch.setattr(sm, "BLOCK_ROWS", 8)
    monkeypatch.setattr(sm, "TASKS_PER_CORE", 1)
    sent = []
    compare = sm._compare

    def counting(*args):
        inner, counted = compare(*args), spark.sparkContext.accumulator(0)
        sent.append(counted)

        def run(batches: sm.Iterator[sm.pa.RecordBatch]) -> sm.Iterator[sm.pa.RecordBatch]:
            held = list(batches)
            counted.add(sum(b.num_rows for b in held))
            yield from inner(iter(held))

        return run

    monkeypatch.setattr(sm, "_compare", counting)
    x = unit(1, 400, 30, 10)
    sims = np.round(x @ x.T, sm.SIM_DIGITS)
    found = sm.cell_join(ws, rows(spark, x), None, 0.6, 30).collect()
    assert {(p.l, p.r) for p in found} == {(i, j) for i, j in np.argwhere(sims >= 0.6) if i < j} and len(found) == len({(p.l, p.r) for p in found})
    assert sent[0].value <= 400 * (2 + 2 * spark.sparkContext.defaultParallelism**0.5)


def test_terms_beyond_the_columns_meet_as_postings(spark, ws, monkeypatch):
    monkeypatch.setattr(sm, "COLUMNS", 5)
    monkeypatch.setattr(sm, "PRODUCTS_AT_ONCE", 7)
    monkeypatch.setattr(sm, "BLOCK_ROWS", 16)
    x = unit(2, 60, 40, 8)
    sims = np.round(x @ x.T, sm.SIM_DIGITS)
    found = {(p.l, p.r): p.sim for p in sm.term_join(ws, rows(spark, x), None, 0.4).collect()}
    assert found.keys() == {(i, j) for i, j in np.argwhere(sims >= 0.4) if i < j}
    assert all(abs(sims[p] - sim) < 1e-9 for p, sim in found.items())
    last = {p.l: p.r for p in sm.term_join(ws, rows(spark, x), rows(spark, x), 0.4, last_only=True).collect()}
    assert last == {i: int(np.flatnonzero(sims[i] >= 0.4)[-1]) for i in range(60)}
    assert sm.term_join(ws, rows(spark, x[:1]), None, 0.4).count() == 0
