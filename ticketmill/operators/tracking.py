"""Groups of one period followed into the next: a key that outlives the period's own numbering.

A group's centroid is the mean of its vectors, at unit length. Centroids of neighbouring periods are matched by the similarity
join in both directions, and two groups are one if each is the other's best partner above the threshold. So a
group has at most one successor and one predecessor, and the links form chains; pointers to the predecessor are doubled until they
reach the first group of the chain, which names the track.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators.ranking import with_position
from ticketmill.operators.similarity import cell_join
from ticketmill.session import Workspace

MATCH = 0.6
MAX_DOUBLINGS = 40


def centroids(ws: Workspace, members: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row per group: (period, group, n, idx, val), of unit length, empty if no member has a usable vector.

    ``members`` has seq, period and group, ``vectors`` seq, idx and val. Entries are summed before the shuffle, so a
    group's size only shows in the map side; a row per group holds at most as many entries as vectors have.
    """
    members = members.select("seq", "period", "group").where("period IS NOT NULL AND `group` IS NOT NULL")
    entries = members.join(vectors, "seq").select("period", "group", F.explode(F.arrays_zip("idx", "val")).alias("e"))
    sums = entries.groupBy("period", "group", F.col("e.idx").alias("term")).agg(F.sum("e.val").alias("w")).where("w <> 0")
    packed = sums.groupBy("period", "group").agg(
        F.array_sort(F.collect_list(F.struct("term", "w"))).alias("e"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length")
    )
    unit = packed.select(
        "period", "group", F.transform("e", lambda x: x["term"]).alias("idx"), F.transform("e", lambda x: x["w"] / F.col("length")).alias("val")
    )
    sized = members.groupBy("period", "group").agg(F.count("*").alias("n")).join(unit, ["period", "group"], "left")
    empty = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    return ws.save(sized.select("period", "group", "n", empty("idx", "int"), empty("val", "double")), "centroids")


def _best(ws: Workspace, left: DataFrame, right: DataFrame, t: float, width: int) -> DataFrame:
    """Best partner in the period before for ``left``, or in the one after: rows that may meet have the same ``step``."""
    return cell_join(ws, left, right, t, width, best_only=True, group="step").select("l", "r")


def successors(ws: Workspace, placed: DataFrame, t: float, width: int) -> DataFrame:
    """Links (pos, before) between rows (pos, number, idx, val) of neighbouring periods, one to one."""
    after = placed.withColumn("step", F.col("number")).select("step", "pos", "idx", "val")
    before = placed.withColumn("step", F.col("number") + 1).select("step", "pos", "idx", "val")
    back = _best(ws, after, before, t, width).toDF("pos", "before")
    ahead = _best(ws, before, after, t, width).toDF("before", "pos")
    return ws.save(back.join(ahead, ["pos", "before"]), "successors")


def chain_heads(ws: Workspace, links: DataFrame) -> DataFrame:
    """The first row of each linked row's chain: (pos, head). The longest chain doubles what is reached in each round."""
    reached = links.select("pos", F.col("before").alias("head"))
    for _ in range(MAX_DOUBLINGS):
        ahead = reached.select(F.col("pos").alias("head"), F.col("head").alias("next"))
        moved = ws.save(reached.join(ahead, "head", "left").select("pos", F.coalesce("next", "head").alias("head"), F.col("next").isNotNull().alias("moved")), "heads")
        reached = moved.select("pos", "head")
        if moved.where("moved").isEmpty():
            return reached
    raise RuntimeError(f"chains are longer than 2^{MAX_DOUBLINGS}")


def track_groups(ws: Workspace, groups: DataFrame, width: int, t: float = MATCH, known: DataFrame | None = None) -> DataFrame:
    """A key over periods for the groups that ``centroids`` gives: (period, group, n, first_period, first_group).

    The key is the first group of the chain. Neighbours are periods that follow each other in the table; one without
    rows does not part them. ``known`` holds groups of the last period before these with the keys they have; what follows
    them takes over their keys, so periods may be tracked one by one. Groups without a usable vector are tracks of their own.
    Ties between partners go to the one that comes first by period and group.
    """
    columns = ["period", "group", "n", "idx", "val"]
    key = [F.lit(None).cast(dict(groups.dtypes)[c]).alias(f"first_{c}") for c in ("period", "group")]
    every = groups.select(*columns, *key)
    if known is not None:
        every = every.unionByName(known.select(*columns, "first_period", "first_group"))
    every = ws.save(with_position(ws, every, ["period", "group"]), "groups")
    periods = with_position(ws, every.select("period").distinct(), ["period"], "number")
    placed = ws.save(every.join(periods, "period").select("pos", F.col("number").cast("long").alias("number"), "idx", "val"), "placed")
    heads = chain_heads(ws, successors(ws, placed, t, width))
    tracks = every.join(heads, "pos", "left").withColumn("head", F.coalesce("head", "pos"))
    first = every.select(
        F.col("pos").alias("head"), F.coalesce("first_period", "period").alias("p"), F.coalesce("first_group", "group").alias("g")
    )
    named = tracks.where("first_period IS NULL").drop("first_period", "first_group").join(first, "head")
    return named.select("period", "group", "n", F.col("p").alias("first_period"), F.col("g").alias("first_group"))
