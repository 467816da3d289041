"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.session import Workspace

MAX_ROUNDS = 60


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long ids to (id, component): the smallest id that can be reached. Only ids with an edge to another appear.

    Each round points every vertex at its smallest neighbour, follows the pointers twice, and goes on with the edges
    between what is left, so stars collapse at once and chains by a factor in each round. Tables of a round are
    written, which cuts the lineage. Null ends and loops are ignored.
    """
    left = ws.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found = None
    for _ in range(MAX_ROUNDS):
        if left.isEmpty():
            break
        both = left.union(left.select("b", "a")).toDF("id", "to")
        step = both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to"))
        step = ws.save(step, "pointers")
        for _ in range(2):
            ahead = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
            step = step.join(ahead, "to").select("id", F.col("next").alias("to"))
        step = ws.save(step, "roots")
        by = lambda name: step.select(F.col("id").alias(name), F.col("to").alias(f"{name}_to"))
        left = ws.save(
            left.join(by("a"), "a").join(by("b"), "b").where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(),
            "edges",
        )
        if found is None:
            found = step
        else:
            ahead = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
            found = ws.save(found.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to")), "found")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    if found is None:
        return ws.spark.createDataFrame([], "id long, component long")
    return found.select("id", F.col("to").alias("component"))
