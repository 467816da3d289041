"""Connected components of an edge table by contraction, over all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.session import Workspace

MAX_ROUNDS = 60


def _follow(step: DataFrame) -> DataFrame:
    """Pointers (id, to) of the ends of pointers."""
    ahead = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
    return step.join(ahead, "to").select("id", F.col("next").alias("to"))


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """Edges (l, r) of long ids to (pos, component): the smallest id that is reached. Ids without an edge do not appear.

    Every id points at its smallest neighbour; after following the pointers twice, the edges between their ends are what
    is left. A star is done in one round, and the longest chain shrinks by a constant factor in each.
    """
    left = ws.save(edges.where("l <> r").select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r")).distinct(), "edges")
    found = None
    for _ in range(MAX_ROUNDS):
        if left.isEmpty():
            break
        both = left.union(left.select("r", "l")).toDF("id", "to")
        step = ws.save(both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to")), "pointers")
        step = ws.save(_follow(_follow(step)), "ends")
        end_of = lambda c: step.select(F.col("id").alias(c), F.col("to").alias(f"{c}_end"))  # noqa: E731, B023
        moved = left.join(end_of("l"), "l").join(end_of("r"), "r").where("l_end <> r_end")
        left = ws.save(moved.select(F.least("l_end", "r_end").alias("l"), F.greatest("l_end", "r_end").alias("r")).distinct(), "edges")
        if found is None:
            found = step
        else:
            ahead = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
            found = ws.save(found.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to")), "found")
    else:
        raise RuntimeError(f"components are not settled after {MAX_ROUNDS} rounds")
    if found is None:
        return left.select(F.col("l").alias("pos"), F.col("r").alias("component"))
    return found.select(F.col("id").alias("pos"), F.col("to").alias("component"))
