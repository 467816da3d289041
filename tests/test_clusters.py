"""Clustering against plain sequential statements of the same rules, on small random inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmill.operators import leaders as ld
from ticketmill.operators import linkage as lk
from ticketmill.operators import similarity as sm
from ticketmill.operators import vectors as vx


def random_vectors(seed, n, dims=3, zeros=0.1, copies=0.2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[rng.random(n) < zeros] = 0
    for i in np.flatnonzero(rng.random(n) < copies):
        x[i] = x[rng.integers(0, n)]
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def sparse_vectors(seed, n, dims=60, terms=6):
    rng = np.random.default_rng(seed)
    x = np.zeros((n, dims))
    for i in range(n):
        x[i, rng.choice(dims, terms, replace=False)] = rng.random(terms) + 0.1
    for i in range(n // 2, n):
        x[i] = x[rng.integers(0, n // 2)]
        x[i, rng.integers(0, dims)] = rng.random()
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def as_table(spark, ws, x):
    rows = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    return vx.given_vectors(ws, spark.createDataFrame(rows, "seq long, v array<double>"), "seq", "v", x.shape[1])


def leaders_in_order(x, t):
    """Ids by the definition: a row without an earlier similar leader leads; a row belongs to its last similar leader."""
    similar = np.round(x @ x.T, 12) >= t
    leads = np.zeros(len(x), bool)
    for row in range(len(x)):
        leads[row] = not (similar[row, :row] & leads[:row]).any()
    number = np.cumsum(leads) - 1
    last = [np.flatnonzero(leads & line) for line in similar]
    return [int(number[found[-1]]) if len(found) else None for found in last]


def closest_pair_first(x, cut):
    groups = [[i] for i in range(len(x))]
    dist = 1 - x @ x.T
    while len(groups) > 1:
        d = [
            (round(float(dist[np.ix_(a, b)].mean()), 12), i, j)
            for i, a in enumerate(groups)
            for j, b in enumerate(groups)
            if i < j
        ]
        best = min(d)
        if best[0] >= cut:
            break
        _, i, j = best
        groups[i] = groups[i] + groups[j]
        del groups[j]
    return {frozenset(g) for g in groups}


def ids_of(df):
    return [r["cluster_id"] for r in df.orderBy("seq").collect()]


def pairs_above(x, t):
    sims = np.round(x @ x.T, 12)
    return {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if sims[i, j] >= t}


def found_pairs(df):
    rows = [(r["l"], r["r"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed,t", [(1, 0.78), (2, 0.5), (3, 0.95)])
def test_sparse_join_finds_every_pair_once(spark, ws, seed, t):
    x = sparse_vectors(seed, 80)
    table = as_table(spark, ws, x).withColumnRenamed("seq", "pos")
    assert found_pairs(sm.term_join(ws, table, None, t)) == pairs_above(x, t)


def test_candidates_are_verified_in_small_groups(spark, ws, monkeypatch):
    """A row similar to all others, copies, groups of a few pairs and vectors of both sides under the same numbers."""
    monkeypatch.setattr(sm, "PAIRS_PER_GROUP", 4)
    x = sparse_vectors(6, 70, dims=15)
    x[:25] = x[0]
    table = as_table(spark, ws, x).withColumnRenamed("seq", "pos")
    assert found_pairs(sm.term_join(ws, table, None, 0.6)) == pairs_above(x, 0.6)
    other = as_table(spark, ws, x[::-1].copy()).withColumnRenamed("seq", "pos")
    sims = np.round(x @ x[::-1].T, 12)
    rows = sm.term_join(ws, table, other, 0.6).collect()
    assert {(r.l, r.r) for r in rows} == {(int(i), int(j)) for i, j in zip(*np.nonzero(sims >= 0.6))} and len(rows) == int((sims >= 0.6).sum())
    assert all(abs(r.sim - sims[r.l, r.r]) < 1e-9 for r in rows)
    assert sm.term_join(ws, table.limit(0), None, 0.6).count() == 0


def test_sparse_join_with_frequent_terms_split_over_tasks(spark, ws, monkeypatch):
    monkeypatch.setattr(sm, "POSTINGS_PER_TASK", 3)
    x = sparse_vectors(4, 60, dims=12)
    table = as_table(spark, ws, x).withColumnRenamed("seq", "pos")
    assert found_pairs(sm.term_join(ws, table, None, 0.6)) == pairs_above(x, 0.6)
    left, right = table.where("pos < 30"), table.where("pos >= 30")
    expected = {(i, j) for i, j in pairs_above(x, 0.6) if i < 30 <= j}
    assert found_pairs(sm.term_join(ws, left, right, 0.6)) == expected


def test_dense_join_over_cells_and_blocks(spark, ws, monkeypatch):
    monkeypatch.setattr(sm, "BLOCK_ROWS", 8)
    x = random_vectors(5, 90, copies=0)
    table = as_table(spark, ws, x).withColumnRenamed("seq", "pos")
    assert found_pairs(sm.cell_join(ws, table, None, 0.9, 3)) == pairs_above(x, 0.9)
    best = {r["l"]: r["r"] for r in sm.cell_join(ws, table, table, 0.6, 3, best_only=True).collect()}
    sims = np.round(x @ x.T, 12)
    np.fill_diagonal(sims, -2)
    assert best == {i: int(sims[i].argmax()) for i in range(len(x)) if sims[i].max() > 0.6}


@pytest.mark.parametrize("seed,n,t", [(1, 40, 0.8), (2, 40, 0.3), (3, 1, 0.5), (4, 25, 0.95)])
def test_leaders_match_the_row_by_row_rule(spark, ws, seed, n, t):
    x = random_vectors(seed, n)
    expected = leaders_in_order(x, t)
    table = as_table(spark, ws, x)
    assert ids_of(ld.leader_clusters(ws, table, t, width=3, guard=False)) == expected


@pytest.mark.parametrize("budget", [None, 30])
def test_leaders_in_many_batches_and_within_a_small_budget(spark, ws, budget):
    x = sparse_vectors(6, 70)
    x[40:62] = x[3]  # exact copies
    x[62:70, :] = x[2]
    x[62:70, 5] += np.linspace(0.001, 0.01, 8)  # near copies that arrive last
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = as_table(spark, ws, x)
    result = ld.leader_clusters(ws, table, 0.78, guard=False, first_batch=20, budget=budget)
    assert ids_of(result) == leaders_in_order(x, 0.78)


def test_identical_rows_are_singletons_under_the_guard(spark, ws):
    x = np.tile([[0.6, 0.8]], (4, 1))
    assert ids_of(ld.leader_clusters(ws, as_table(spark, ws, x), 0.8, width=2)) == [0, 1, 2, 3]
    assert ids_of(ld.leader_clusters(ws, as_table(spark, ws, x), 0.8, width=2, guard=False)) == [0, 0, 0, 0]


@pytest.mark.parametrize("seed,task_rows", [(1, 1500), (2, 1500), (3, 4), (4, 1)])
def test_average_linkage_matches_closest_pair_first(spark, ws, seed, task_rows):
    x = random_vectors(seed, 22)
    y = random_vectors(seed + 100, 9)
    table = as_table(spark, ws, np.vstack([x, y]))
    months = spark.range(31).select(F.col("id").alias("seq"), F.when(F.col("id") < 22, "a").otherwise("b").alias("grp"))
    rows = lk.average_linkage(ws, table, 3, months, task_rows=task_rows).collect()
    for grp, part, shift in (("a", x, 0), ("b", y, 22)):
        ids = {}
        for r in rows:
            if r["grp"] == grp:
                ids.setdefault(r["cluster_id"], set()).add(r["seq"] - shift)
        assert {frozenset(v) for v in ids.values()} == closest_pair_first(part, 0.4)
        order = sorted(ids, key=lambda c: min(ids[c]))
        assert order == list(range(len(ids)))


def test_wrong_dimension_is_an_error(spark, ws):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0])], "seq long, v array<double>")
    with pytest.raises(Exception, match="vector of 2 numbers"):
        vx.given_vectors(ws, df, "seq", "v", 2)


def test_missing_vectors_are_found(spark, ws):
    df = spark.createDataFrame([(0, [1.0]), (1, [1.0])], "seq long, v array<double>")
    vectors = vx.given_vectors(ws, df.where("seq = 0"), "seq", "v")
    assert [r["seq"] for r in vx.missing_vectors(df, vectors).collect()] == [1]


@pytest.mark.parametrize("width", [60, None])
def test_one_link_for_each_row_and_batch(spark, ws, width):
    x = sparse_vectors(9, 90)
    rows = as_table(spark, ws, x).withColumnRenamed("seq", "pos")
    near = ld.dense_near(ws, 0.4, width) if width else ld.sparse_near(ws, 0.4)
    leaders, links = ld.leader_links(ws, rows, near, first_batch=20)
    found = [(r["l"], r["r"]) for r in links.collect()]
    batches = 3  # 20, 40 and 30 rows
    assert len(found) <= len(x) * (batches + 1)
    similar = np.round(x @ x.T, 12) >= 0.4
    heads = sorted(r["pos"] for r in leaders.collect())
    last = {i: max(h for h in heads if similar[i, h]) for i in range(len(x))}
    assert {i: max(r for l, r in found if l == i) for i in range(len(x))} == last
    assert all(similar[l, r] and r in heads for l, r in found)
    assert similar[:, heads].sum() > len(x)  # rows with several leaders


def test_connecting_edges_connect_the_same(spark, ws):
    x = random_vectors(12, 60, dims=4)
    rows = as_table(spark, ws, x).withColumnRenamed("seq", "pos")
    edges = [(r["l"], r["r"]) for r in sm.cell_join(ws, rows, None, 0.8, 4, connect=True).collect()]
    assert len(edges) < len(x)
    low = list(range(len(x)))
    want = {tuple(p) for p in np.argwhere(np.round(x @ x.T, 12) > 0.8) if p[0] < p[1]}

    def parts(pairs):
        low = list(range(len(x)))
        for _ in range(len(x)):
            for a, b in pairs:
                low[a] = low[b] = min(low[a], low[b])
        return low

    assert parts(edges) == parts(want) != low
