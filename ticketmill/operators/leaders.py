"""Ordered threshold clustering.

Rows are taken in order; a row no earlier leader is similar to becomes a leader, and its group is every row
similar to it, also rows that already have a group. Later groups win. So the leaders are the first maximal
independent set (in row order) of the graph {similarity >= t}, and a row belongs to its last similar leader.

Only row-to-leader pairs matter, and of these only a row's last one. Leaders are found in batches of growing size: rows similar to
any earlier leader are set aside first, with the last of these, and only the rest of the batch is compared with itself. A large group of near
copies thus meets its leader once, instead of meeting itself. When all leaders are known, the other rows look for a later one among those of
their own and later batches, all at once; leaders are not similar to each other, so a leader's last one is itself.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators import similarity as sm
from ticketmill.operators import vectors as vx
from ticketmill.operators.ranking import join_by_key, with_position
from ticketmill.session import Workspace

FIRST_BATCH = 4_096
# pairs a batch may have with itself, or PAIRS_PER_ROW for each row of the table if that is more; beyond, the
# batch is shortened, which changes the work but not the result
PAIR_BUDGET = 200_000_000
PAIRS_PER_ROW = 20
SAMPLE_ROWS = 20_000
MAX_ROUNDS = 10_000

log = logging.getLogger(__name__)

Near = Callable[..., DataFrame]


def sparse_near(ws: Workspace, t: float) -> Near:
    """All pairs of rows without a right side; else each left row's last similar right row, not before the column ``since`` if it is named."""

    return lambda left, right, since=None: sm.term_join(ws, left, right, t, last_only=right is not None, since=since)


def dense_near(ws: Workspace, t: float, width: int) -> Near:
    """All pairs of rows without a right side; else each left row's last similar right row, not before the column ``since`` if it is named."""
    return lambda left, right, since=None: sm.cell_join(ws, left, right, t, width, last_only=right is not None, since=since)


def covered_rows(ws: Workspace, pairs: DataFrame) -> DataFrame:
    """Rows that are not leaders, given all pairs l < r inside a set of undecided rows.

    A row without an earlier neighbour leads; its neighbours are covered; both leave the graph; repeat.
    Each round is a few joins on the remaining pairs, and the rounds follow the longest chain of
    decisions, not the number of rows.
    """
    found = None
    for number in range(MAX_ROUNDS):
        if pairs.isEmpty():
            break
        if log.isEnabledFor(logging.INFO):
            log.info("round %d: %d open pairs", number, pairs.count())
        later = pairs.select(F.col("r").alias("l")).distinct()
        heads = pairs.select("l").distinct().join(later, "l", "left_anti")
        covered = ws.save(pairs.join(heads, "l").select("r").distinct(), "covered")
        found = covered if found is None else found.union(covered)
        # a head's pairs all end in covered rows, so dropping covered rows on both sides drops the heads too
        open_pairs = pairs.join(covered, "r", "left_anti").join(
            covered.withColumnRenamed("r", "l"), "l", "left_anti"
        )
        pairs = ws.save(open_pairs.select("l", "r"), "open-pairs")
    else:
        raise RuntimeError(f"leaders are not settled after {MAX_ROUNDS} rounds")
    return found if found is not None else pairs.select("r")


def _end_within_budget(rest: DataFrame, near: Near, count: int, end: int, budget: int) -> int:
    """Where to end a batch so that its undecided rows have about ``budget`` pairs at most.

    Certain if the rows are few; otherwise estimated from the pairs inside a sample. The sample only
    chooses the batch; every row is compared in its own batch.
    """
    if count * count / 2 <= budget:
        return end
    safe = max(2, int(math.sqrt(2 * budget)))
    wanted = min(count, SAMPLE_ROWS)
    sample = rest.orderBy(F.xxhash64("pos"), "pos").limit(wanted)
    allowed = budget * (wanted / count) ** 2
    by_end = near(sample, None).groupBy("r").count().orderBy("r").collect()  # at most SAMPLE_ROWS rows
    seen, cut = 0, end
    for row in by_end:
        seen += row["count"]
        if seen > allowed:
            cut = row["r"]
            break
    if cut == end:
        return end
    safe_end = rest.orderBy("pos").limit(safe).agg(F.max("pos")).first()[0] + 1
    return min(end, max(cut, safe_end))


def find_leaders(
    ws: Workspace,
    rows: DataFrame,
    near: Near,
    first_batch: int = FIRST_BATCH,
    budget: int | None = None,
) -> tuple[DataFrame | None, DataFrame | None, list[int]]:
    """Leaders (pos, idx, val) among ``rows``, links (``l``, ``r``) of rows to their last similar leader of earlier batches, and where batches start."""
    total = (rows.agg(F.max("pos")).first()[0] or 0) + 1 if not rows.isEmpty() else 0
    budget = budget or max(PAIR_BUDGET, PAIRS_PER_ROW * total)
    leaders: DataFrame | None = None
    known: DataFrame | None = None
    starts: list[int] = []
    start, size = 0, first_batch
    while start < total:
        starts.append(start)
        end = min(total, start + size)
        rest = rows.where((F.col("pos") >= start) & (F.col("pos") < end))
        if leaders is not None:
            found = ws.save(near(rest, leaders).select("l", "r"), "known")
            known = found if known is None else known.unionByName(found)
            rest = ws.save(rest.join(found.select(F.col("l").alias("pos")), "pos", "left_anti"), "undecided")
        count = rest.count()
        cut = _end_within_budget(rest, near, count, end, budget)
        if cut < end:
            end = cut
            rest = rest.where(F.col("pos") < end)
        pairs = ws.save(near(rest, None).select("l", "r"), "pairs")
        covered = covered_rows(ws, pairs)
        new = ws.save(rest.join(covered.select(F.col("r").alias("pos")), "pos", "left_anti"), "leaders")
        leaders = new if leaders is None else leaders.unionByName(new)
        if log.isEnabledFor(logging.INFO):
            log.info("rows %d to %d: %d undecided, %d leaders", start, end, rest.count(), leaders.count())
        start, size = end, size * 2
    return leaders, known, starts


def leader_links(
    ws: Workspace,
    rows: DataFrame,
    near: Near,
    first_batch: int = FIRST_BATCH,
    budget: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Leaders (``pos``) among ``rows`` (pos, idx, val; all non-zero), and a link (``l``, ``r``) of each row to its last similar leader."""
    leaders, known, starts = find_leaders(ws, rows, near, first_batch, budget)
    if leaders is None:
        return rows.limit(0).select("pos"), rows.select(F.col("pos").alias("l"), F.col("pos").alias("r")).limit(0)
    own = leaders.select(F.col("pos").alias("l"), F.col("pos").alias("r"))
    since = F.array_max(F.filter(F.lit(starts).cast("array<bigint>"), lambda start: start <= F.col("pos")))
    others = rows.join(leaders.select("pos"), "pos", "left_anti").withColumn("since", since)
    links = near(others, leaders, since="since").select("l", "r")
    if known is not None:
        links = links.unionByName(known).groupBy("l").agg(F.max("r").alias("r"))
    return leaders.select("pos"), own.unionByName(links)


def all_alike(vectors: DataFrame) -> bool:
    """True if no vector differs from the first one by more than 1e-8 + 1e-5 times its entry."""
    as_map = F.map_from_arrays("idx", "val")
    first = vectors.orderBy("seq").limit(1).select(as_map.alias("m0")).scalar()
    diff = F.map_zip_with(
        as_map,
        F.col("m0"),
        lambda k, a, b: F.abs(F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0)))
        > 1e-8 + 1e-5 * F.abs(F.coalesce(b, F.lit(0.0))),
    )
    return vectors.withColumn("m0", first).where(F.exists(F.map_values(diff), lambda x: x)).isEmpty()


def leader_clusters(
    ws: Workspace,
    vectors: DataFrame,
    t: float,
    width: int | None = vx.MAX_FEATURES,
    guard: bool = True,
    first_batch: int = FIRST_BATCH,
    budget: int | None = None,
) -> DataFrame:
    """Cluster ids per ``seq``; null for zero vectors, which still use up an id each.

    Vectors of up to ``width`` entries are compared by the dense join; ``width=None`` chooses the inverted
    index, which pays if the vocabulary is so large that vectors share few terms.
    ``guard``: if all vectors are alike, every row is its own cluster.
    """
    keyed = vx.with_vector_key(vectors)
    folded = vx.distinct_vectors(ws, keyed)
    # a ticket's key is kept, its vector is that of the distinct ones; a missing vector has no place among them
    keyed = ws.save(keyed.where(F.size("idx") >= 0).select("seq", "vkey", "idx", "val").withColumns({c: F.when(F.size("idx") == 0, F.col(c)) for c in ("idx", "val")}), "keyed")
    zero = keyed.where("idx IS NOT NULL")
    if guard:
        kinds = folded.select("seq", "idx", "val").unionByName(
            zero.orderBy("seq").limit(1).select("seq", "idx", "val")
        )
        if all_alike(kinds):
            return with_position(ws, keyed.select("seq"), ["seq"], "cluster_id")
    placed = with_position(ws, folded, ["seq"])
    near = dense_near(ws, t, width) if width else sparse_near(ws, t)
    leaders, links = leader_links(ws, placed.select("pos", "idx", "val"), near, first_batch, budget)
    leading = placed.join(leaders, "pos").select("seq", "pos")
    ids = leading.unionByName(zero.select("seq", F.lit(None).cast("bigint").alias("pos")))
    numbered = with_position(ws, ids, ["seq"], "cluster_id").where(F.col("pos").isNotNull())
    last = ws.save(links.select(F.col("l").alias("pos"), F.col("r").alias("leader")), "last-leaders")
    # a leader of many vectors is a hot key, hence the size per leader
    sizes = last.groupBy("leader").agg(F.count("*").alias("rows"))
    named = ws.save(numbered.select(F.col("pos").alias("leader"), "cluster_id").join(sizes, "leader"), "leaders")
    by_vector = join_by_key(placed.select("pos", "vkey", "n").join(last, "pos"), named, "leader", "rows")
    by_vector = ws.save(by_vector.select("vkey", "n", "cluster_id"), "by-vector")
    assigned = join_by_key(keyed.where("idx IS NULL").select("seq", "vkey"), by_vector, "vkey")
    nothing = zero.select("seq", F.lit(None).cast("bigint").alias("cluster_id"))
    return assigned.select("seq", "cluster_id").unionByName(nothing)


def singletons(ws: Workspace, rows: DataFrame) -> DataFrame:
    """Every row its own cluster, in row order."""
    return with_position(ws, rows.select("seq"), ["seq"], "cluster_id")
