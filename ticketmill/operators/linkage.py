"""Average-linkage clustering on cosine distance: components of near vectors, then rounds of mutual nearest neighbours.

The mean distance between two clusters is 1 - mean_a · mean_b, so a cluster is its mean vector and its size;
no matrix of pair distances is kept. A merge needs a pair of vectors nearer than the cut, so clusters never leave the connected
components of such pairs, and components are worked on apart: small ones inside a task each, large ones in rounds over all tasks.

Average linkage is reducible: no cluster comes nearer to a union than it was to the nearer part. So merging mutual nearest
neighbours gives the same clusters as merging the closest pair first, and a cluster's nearest partner, which is kept from
round to round, is looked for again only if the cluster or that partner was merged. Ties go to the smallest id.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators import vectors as vx
from ticketmill.operators.components import components
from ticketmill.operators.ranking import join_by_key, with_position
from ticketmill.operators.similarity import SIM_DIGITS, _flat, _matrix, _one, cell_join
from ticketmill.session import Workspace

CUT = 0.4
# components of at most this many clusters are finished inside one task
TASK_ROWS = 1_500
MAX_ROUNDS = 5_000

log = logging.getLogger(__name__)


def _finish_group(width: int, floor: float):
    """Merge the clusters of one bounded group to the end."""

    def finish(table: pa.Table) -> pa.Table:
        ids = table["pos"].to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        n = table["n"].to_numpy()[order].astype(float)
        sums = _matrix(_one(table["idx"]), _one(table["val"]), width)[order] * n[:, None]
        root = np.arange(len(ids))
        live = np.arange(len(ids))
        while len(live) > 1:
            means = sums[live] / n[live, None]
            sims = np.round(means @ means.T, SIM_DIGITS)
            np.fill_diagonal(sims, -2.0)
            best = sims.argmax(axis=1)
            me = np.arange(len(live))
            mutual = (best[best] == me) & (sims[me, best] > floor) & (me < best)
            if not mutual.any():
                break
            keep, gone = live[me[mutual]], live[best[mutual]]
            sums[keep] += sums[gone]
            n[keep] += n[gone]
            root[gone] = keep
            live = np.setdiff1d(live, gone)
        while (root[root] != root).any():
            root = root[root]
        return pa.table({"pos": ids, "root": ids[root]})

    return finish


def _merge_means(batches):
    """Weighted mean of two sparse vectors per row."""
    for batch in batches:
        rows = np.arange(batch.num_rows)
        n_a = batch.column("n").to_numpy(zero_copy_only=False).astype(float)
        n_b = batch.column("n_b").fill_null(0).to_numpy(zero_copy_only=False).astype(float)
        va, ra = _flat(batch.column("val"))
        ia, _ = _flat(batch.column("idx"))
        vb, rb = _flat(batch.column("val_b"))
        ib, _ = _flat(batch.column("idx_b"))
        row = np.r_[ra, rb]
        idx = np.r_[ia, ib].astype(np.int64)
        val = np.r_[va * n_a[ra], vb * n_b[rb]] / (n_a + n_b)[row]
        span = int(idx.max(initial=0)) + 1
        key, where = np.unique(row * span + idx, return_inverse=True)
        total = np.bincount(where, weights=val, minlength=len(key))
        offsets = np.searchsorted(key // span, np.r_[rows, batch.num_rows]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("grp"),
                batch.column("pos"),
                pa.array((n_a + n_b).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array((key % span).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(total)),
            ],
            names=["grp", "pos", "n", "idx", "val"],
        )


STATE = "grp string, pos long, n long, idx array<int>, val array<double>"


def _pos(df: DataFrame, *columns: str) -> DataFrame:
    """The values of the columns as ``pos``."""
    out = df.select(F.col(columns[0]).alias("pos"))
    for c in columns[1:]:
        out = out.union(df.select(c))
    return out


def _nearest(ws: Workspace, state: DataFrame, kept: DataFrame | None, stale: DataFrame | None, width: int, floor: float) -> DataFrame:
    """Each cluster's nearest partner above the floor, (l, r, sim): kept ones, and those of stale clusters found anew."""
    asked = state if stale is None else state.join(stale, "pos", "left_semi")
    fresh = cell_join(ws, asked, state, floor, width, best_only=True, group="grp")
    return ws.save(fresh if kept is None else kept.unionByName(fresh), "nearest")


def _merge(ws: Workspace, state: DataFrame, nearest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge mutual nearest neighbours: the pairs (keep, gone), and the clusters that may merge again."""
    back = nearest.select(F.col("l").alias("r"), F.col("r").alias("l"))
    mutual = nearest.join(back, ["l", "r"]).where(F.col("l") < F.col("r"))
    merges = ws.save(mutual.select(F.col("l").alias("keep"), F.col("r").alias("gone")), "merges")
    gone = state.select(
        F.col("pos").alias("gone"), F.col("n").alias("n_b"), F.col("idx").alias("idx_b"), F.col("val").alias("val_b")
    )
    partner = merges.join(gone, "gone").withColumnRenamed("keep", "pos").drop("gone")
    # a cluster without a partner above the floor never gets one: its mean distance to a union is a mean of misses
    active = state.join(_pos(nearest, "l"), "pos", "left_semi").join(_pos(merges, "gone"), "pos", "left_anti")
    joined = active.join(partner, "pos", "left").select("grp", "pos", "n", "idx", "val", "n_b", "idx_b", "val_b")
    return merges, ws.save(joined.mapInArrow(_merge_means, STATE), "state")


def _still_right(ws: Workspace, nearest: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nearest partners no merge has touched, and the clusters (``pos``) whose partner has to be found again."""
    changed = ws.save(_pos(merges, "keep", "gone"), "changed")
    at = lambda c: changed.withColumnRenamed("pos", c)
    untouched = nearest.join(at("l"), "l", "left_anti")
    kept = ws.save(untouched.join(at("r"), "r", "left_anti").select("l", "r", "sim"), "kept")
    lost = untouched.join(at("r"), "r", "left_semi")
    return kept, ws.save(_pos(lost, "l").union(_pos(merges, "keep")).distinct(), "stale")


def _resolve(ws: Workspace, roots: DataFrame, merges: list[DataFrame]) -> DataFrame:
    """Follow the merges of the rounds from the last to the first: (pos, root)."""
    for step in reversed(merges):
        moved = step.join(roots.withColumnRenamed("pos", "keep"), "keep", "left").select(
            F.col("gone").alias("pos"), F.coalesce("root", "keep").alias("root")
        )
        roots = ws.save(roots.unionByName(moved), "roots")
    return roots


def average_linkage(
    ws: Workspace,
    vectors: DataFrame,
    width: int,
    group: DataFrame,
    cut: float = CUT,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Cluster ids per (grp, seq), numbered from 0 inside each group by the smallest seq.

    ``group`` has ``seq`` and ``grp`` (a month, say). Merges while the mean distance is below ``cut``.
    """
    floor = 1.0 - cut
    keyed = ws.save(
        vx.with_vector_key(vectors.join(group.select("seq", F.col("grp").cast("string").alias("grp")), "seq"))
        .withColumn("gkey", F.concat_ws(":", "grp", "vkey")),
        "keyed",
    )
    folded = (
        keyed.where(F.size("idx") > 0)
        .groupBy("gkey")
        .agg(
            F.first("grp").alias("grp"),
            F.min("seq").alias("pos"),
            F.count("*").alias("n"),
            F.first("idx").alias("idx"),
            F.first("val").alias("val"),
        )
    )
    folded = ws.save(folded, "distinct")
    state = folded.select("grp", "pos", "n", "idx", "val")
    part = components(ws, cell_join(ws, state, None, floor, width, group="grp", connect=True))
    # from here on a component is the group; vectors without an edge are clusters already
    state = ws.save(
        state.drop("grp").join(part, "pos").select(F.col("component").cast("string").alias("grp"), "pos", "n", "idx", "val"), "state"
    )
    merges: list[DataFrame] = []
    roots = ws.save(folded.select("pos", F.col("pos").alias("root")).limit(0), "roots")
    kept = stale = None
    for number in range(MAX_ROUNDS):
        sizes = ws.save(state.groupBy("grp").agg(F.count("*").alias("rows")), "sizes")
        small = sizes.where(F.col("rows") <= task_rows).select("grp")
        done = (
            state.join(small, "grp", "left_semi")
            .groupBy("grp")
            .applyInArrow(_finish_group(width, floor), "pos long, root long")
        )
        roots = roots.unionByName(ws.save(done, "roots"))
        if sizes.where(F.col("rows") > task_rows).isEmpty():
            break
        state = ws.save(state.join(small, "grp", "left_anti").select("grp", "pos", "n", "idx", "val"), "state")
        if kept is not None:
            kept = kept.join(state.select(F.col("pos").alias("l")), "l", "left_semi").select("l", "r", "sim")
        nearest = _nearest(ws, state, kept, stale, width, floor)
        step, state = _merge(ws, state, nearest)
        if step.isEmpty() and stale is not None:
            kept = stale = None  # kept partners of equal distance can point in a circle; found anew, the smallest ids are mutual
            continue
        kept, stale = _still_right(ws, nearest, step)
        if log.isEnabledFor(logging.INFO):
            log.info("round %d: %d merges, %d partners to find again, %d kept", number, step.count(), stale.count(), kept.count())
        merges.append(step)
    else:
        raise RuntimeError(f"clusters are not settled after {MAX_ROUNDS} rounds")
    roots = _resolve(ws, roots, merges)
    by_vector = folded.select("gkey", "n", "pos").join(roots, "pos", "left").select(
        "gkey", "n", F.coalesce("root", "pos").alias("root")
    )
    by_vector = ws.save(by_vector, "by-vector")
    placed = join_by_key(keyed.where(F.size("idx") > 0).select("grp", "seq", "gkey"), by_vector, "gkey")
    # a zero vector is at distance 1 from all others: a cluster of its own
    alone = keyed.where(F.size("idx") == 0).select("grp", "seq", F.col("seq").alias("root"))
    members = ws.save(placed.select("grp", "seq", "root").unionByName(alone), "members")
    return number_clusters(ws, members)


def number_clusters(ws: Workspace, members: DataFrame) -> DataFrame:
    """Number the clusters of each group from 0 in the order of their smallest seq (the root)."""
    sized = ws.save(members.groupBy("grp", "root").agg(F.count("*").alias("n")), "roots")
    placed = ws.save(with_position(ws, sized, ["grp", "root"], "_pos"), "numbered")
    first = placed.groupBy("grp").agg(F.min("_pos").alias("_first"), F.count("*").alias("groups"))
    numbered = join_by_key(placed, first, "grp", "groups").select(
        "root", "n", (F.col("_pos") - F.col("_first")).alias("cluster_id")
    )
    numbered = ws.save(numbered, "cluster-ids")
    return join_by_key(members, numbered, "root").select("grp", "seq", "cluster_id")


