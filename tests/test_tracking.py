"""Groups followed over periods, against plain statements of the same rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmill.operators import tracking as tr
from ticketmill.operators import vectors as vx
from ticketmill.operators.components import components
from ticketmill.plans import runs


def plain_tracks(rows, t):
    """rows: (period, group, vector); each group's first (period, group)."""
    groups = {}
    for period, group, x in rows:
        groups.setdefault((period, group), []).append(x)
    means = {k: np.sum(v, axis=0) for k, v in groups.items()}
    means = {k: m / np.linalg.norm(m) if np.linalg.norm(m) > 0 else m for k, m in means.items()}
    periods = sorted({p for p, _ in groups})
    first = {k: k for k in groups}
    for p, q in zip(periods, periods[1:]):
        a, b = sorted(k for k in groups if k[0] == p), sorted(k for k in groups if k[0] == q)
        sims = np.round(np.array([[means[i] @ means[j] for j in b] for i in a]), 12)
        for j, k in enumerate(b):
            i = int(sims[:, j].argmax())
            if sims[i, j] > t and int(sims[i].argmax()) == j:
                first[k] = first[a[i]]
    return first


def drifting(seed, periods=6, groups=5, size=4, dims=8):
    """Groups that drift, come and go; numbers are dealt anew in every period."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dims))
    rows = []
    for p in range(periods):
        centre += rng.normal(scale=0.3, size=centre.shape)
        name = rng.permutation(groups)
        for g in range(groups):
            if rng.random() < 0.85:
                rows += [(p * 2, int(name[g]), c / np.linalg.norm(c)) for c in centre[g] + rng.normal(scale=0.1, size=(size, dims))]
    rows += [(2, 99, np.zeros(dims))]
    return rows


def members_and_vectors(spark, ws, rows):
    members = spark.createDataFrame([(i, p, g) for i, (p, g, _) in enumerate(rows)], "seq long, period long, group long")
    given = spark.createDataFrame([(i, [float(v) for v in x]) for i, (_, _, x) in enumerate(rows)], "seq long, v array<double>")
    return members, vx.given_vectors(ws, given, "seq", "v", len(rows[0][2]))


@pytest.mark.parametrize(("seed", "t"), [(1, 0.6), (2, 0.9), (3, 0.2)])
def test_tracks_equal_plain_matching(spark, ws, seed, t):
    rows = drifting(seed)
    members, vectors = members_and_vectors(spark, ws, rows)
    got = tr.track_groups(ws, tr.centroids(ws, members, vectors), 8, t).collect()
    want = plain_tracks(rows, t)
    assert {(r.period, r.group): (r.first_period, r.first_group) for r in got} == want
    assert len(got) == len(want) and len(set(want.values())) < len(want)


def test_periods_one_by_one_equal_all_at_once(spark, ws):
    rows = drifting(4)
    members, vectors = members_and_vectors(spark, ws, rows)
    groups = tr.centroids(ws, members, vectors)
    whole = {(r.period, r.group): (r.first_period, r.first_group) for r in tr.track_groups(ws, groups, 8).collect()}
    known, got = None, {}
    for p in sorted({r[0] for r in rows}):
        own = groups.where(F.col("period") == p)
        step = ws.save(tr.track_groups(ws, own, 8, known=known), "step")
        got |= {(r.period, r.group): (r.first_period, r.first_group) for r in step.collect()}
        known = own.join(step.drop("n"), ["period", "group"])
    assert got == whole


def test_stored_months_go_on(spark, ws):
    rows = drifting(5)
    members, vectors = members_and_vectors(spark, ws, rows)
    month = F.add_months(F.lit("2024-01-01").cast("date"), (F.col("period") / 2).cast("int"))
    clustered = ws.save(members.select("seq", month.alias("month_start"), F.col("group").alias("cluster_id")), "clustered")
    columns = ["period", "group", "first_period", "first_group"]
    whole = runs.run_tracks(ws, clustered, vectors, ws.path("whole"), 8).select(columns).collect()
    out = ws.path("steps")
    for m in sorted(r.month_start for r in clustered.select("month_start").distinct().collect()):
        stored = runs.run_tracks(ws, clustered.where(F.col("month_start") == m), vectors, out, 8).select(columns).collect()
    again = runs.run_tracks(ws, clustered.where(F.col("month_start") == m), vectors, out, 8).select(columns).collect()
    assert sorted(stored) == sorted(whole) == sorted(again)


def test_nothing_to_track(spark, ws):
    rows = drifting(1)
    members, vectors = members_and_vectors(spark, ws, rows)
    none = tr.track_groups(ws, tr.centroids(ws, members.limit(0), vectors), 8)
    assert none.count() == 0
    one = tr.track_groups(ws, tr.centroids(ws, members.where("period = 0"), vectors), 8).collect()
    assert one and all((r.period, r.group) == (r.first_period, r.first_group) for r in one)


def test_components(spark, ws):
    rng = np.random.default_rng(3)
    for edges in ([(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], [tuple(map(int, rng.integers(0, 60, 2))) for _ in range(45)], []):
        low = {x: x for e in edges for x in e}
        for _ in range(70):
            for a, b in edges:
                low[a] = low[b] = min(low[a], low[b])
        want = {k: v for k, v in low.items() if any(k in e and e[0] != e[1] for e in edges)}
        got = components(ws, spark.createDataFrame(edges, "l long, r long"))
        assert {r.pos: r.component for r in got.collect()} == want
