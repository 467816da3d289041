"""Exact top-k by inner product as a Voronoi kNN join.

Vectors become whole numbers. Data and queries go to the cell of their nearest pivot p. A data cell j is summarised by its size, its
radius r, its longest vector m and a few of its vectors (seeds). For a query q and a vector x of the cell

    q.x  <=  q.p_j + |q| r_j      and      q.x  <=  |q| m_j,

while the k-th best of the seeds is a score that q is certain to reach. So q is sent only to the cells whose bound comes up
to that score. Queries are what is copied, since they are few; the data are shuffled once, into (cell, block) of bounded
size, and again only for every further ``QUERY_BLOCK`` queries that come to a cell. A task solves one block for one block of
queries and returns k rows per query at most; the blocks' results are merged in two steps.

Of equal vectors only the k + 1 with the smallest ids can be in a result (one may be the query itself); further copies
stay behind before anything is sent.

Vectors that are null or hold null or non-finite numbers take no part. Shorter vectors count as filled up with zeros, empty ones as zeros
throughout. Ties go to the smaller id. Null ids take no part; rows that repeat an id are one row, with the smallest of its vectors.
No data or no queries give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.session import Workspace

PIVOTS = 64
SEEDS = 64
BLOCK = 16_384
QUERY_BLOCK = 16_384
SALTS = 64
# scores that a task holds at once
SCORES = 1 << 21


def whole(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): components times scale, rounded down; rows that take no part are gone."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.col(vector_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return vectors.where(fine & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), ints.alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _homes(pivots: np.ndarray):
    """(id, v) to (id, v, cell, distance to its pivot, length)."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v")).astype(np.float64)
            gap = np.maximum((x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None, :], 0) if len(x) else np.zeros((0, len(pivots)))
            cell = gap.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("v"),
                    pa.array(cell.astype(np.int32)),
                    pa.array(np.sqrt(gap[np.arange(len(x)), cell])),
                    pa.array(np.sqrt((x * x).sum(1))),
                ],
                names=["id", "v", "cell", "gap", "norm"],
            )

    return run


def _visits(centres: np.ndarray, cells: list[tuple], seeds: np.ndarray, seed_ids: np.ndarray, k: int):
    """Queries (id, v, norm) to one row per cell they have to be sent to; ``cells`` are (cell, radius, longest)."""
    number, radius, longest = (np.array(c) for c in zip(*cells))
    pivots = centres[number]

    def run(batches):
        for batch in batches:
            q, ids = _matrix(batch.column("v")).astype(np.float64), batch.column("id").to_numpy()
            if not len(ids):
                continue
            size = np.sqrt((q * q).sum(1))
            reached = q @ seeds.T
            reached[ids[:, None] == seed_ids[None, :]] = -np.inf
            certain = np.partition(reached, len(seed_ids) - k, axis=1)[:, len(seed_ids) - k] if len(seed_ids) >= k else np.full(len(ids), -np.inf)
            bound = np.minimum(q @ pivots.T + size[:, None] * radius, size[:, None] * longest)
            slack = 1 + 1e-6 * size[:, None] * longest  # rounding of the bounds; scores are whole numbers
            row, col = np.nonzero(bound + slack >= certain[:, None])
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("v").take(take), pa.array(number[col].astype(np.int32))], names=["id", "v", "cell"]
            )

    return run


def _solve(k: int):
    """A block of queries against a block of data: at most k rows per query."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int64)
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": empty, "vec_id": empty, "score": empty})
        order = np.argsort(right["id"].to_numpy(), kind="stable")
        ids, queries = right["id"].to_numpy()[order], left["id"].to_numpy()
        q, x = (_matrix(t["v"].combine_chunks()) for t in (left, right))
        x = x[order]
        most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
        fits = most < 2**52  # products in doubles are exact then
        if fits:
            q, x = q.astype(np.float64), x.astype(np.float64)
        out_q, out_v, out_s = [], [], []
        step = max(1, SCORES // len(ids))
        for start in range(0, len(queries), step):
            scores = q[start : start + step] @ x.T
            if fits:
                scores = np.rint(scores).astype(np.int64)
            own = queries[start : start + step, None] == ids[None, :]
            scores[own] = np.iinfo(np.int64).min
            for i, row in enumerate(scores):
                if len(row) > k:
                    least = np.partition(row, len(row) - k)[len(row) - k]
                    above = np.flatnonzero(row > least)
                    pick = np.r_[above, np.flatnonzero(row == least)[: k - len(above)]]
                else:
                    pick = np.arange(len(row))
                pick = pick[~own[i][pick]]
                out_q.append(np.full(len(pick), queries[start + i]))
                out_v.append(ids[pick])
                out_s.append(row[pick])
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    return run


def _best(df: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    ws: Workspace,
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each query the k best other vectors, all if there are fewer."""
    spark = ws.spark
    data = whole(vectors, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    asked = whole(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    width = max(df.agg(F.max(F.size("v"))).head()[0] or 0 for df in (data, asked)) or 1
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))).alias("v")
    data, asked = data.select("id", filled), asked.select("id", filled)
    # copies beyond the k + 1 smallest ids, first within salts, so that no group of copies meets in one task
    alike = data.withColumn("h", F.xxhash64("v")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for keys in (("h", "v", "salt"), ("h", "v")):
        order = Window.partitionBy(*keys).orderBy("id")
        alike = alike.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= k + 1).drop("copy")
    data = ws.save(alike.select("id", "v"), "vectors")
    chosen = data.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toArrow()["v"].combine_chunks()  # at most ``pivots`` rows
    if not len(chosen):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centres = _matrix(chosen).astype(np.float64)
    schema = "id long, v array<long>, cell int, gap double, norm double"
    homes = ws.save(data.mapInArrow(_homes(centres), schema), "homes")

    # summaries: a row per cell, and at most pivots * SEEDS vectors
    cells = homes.groupBy("cell").agg(F.max("gap").alias("radius"), F.max("norm").alias("longest"), F.count("*").alias("n"))
    cells = ws.save(cells.withColumn("blocks", F.ceil(F.col("n") / BLOCK)), "cells")
    by_hash = Window.partitionBy("cell").orderBy(F.xxhash64("id"), "id")
    salted = Window.partitionBy("cell", "salt").orderBy(F.xxhash64("id"), "id")
    few = homes.select("cell", "id", F.pmod(F.hash("id"), F.lit(SALTS)).alias("salt")).withColumn("n", F.row_number().over(salted)).where(F.col("n") <= SEEDS)
    few = few.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= SEEDS).select("id")
    seeds = homes.join(F.broadcast(few), "id").select("id", "v").toArrow()
    plan = [(r["cell"], r["radius"], r["longest"]) for r in cells.collect()]
    sent = asked.mapInArrow(
        _visits(centres, plan, _matrix(seeds["v"].combine_chunks()).astype(np.float64), seeds["id"].to_numpy(), k), "id long, v array<long>, cell int"
    )
    sent = ws.save(sent, "sent")
    sizes = sent.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("qblocks"))
    sizes = F.broadcast(ws.save(cells.select("cell", "blocks").join(sizes, "cell"), "sizes"))  # a row per cell

    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    left = sent.join(sizes, "cell").withColumn("qblock", part("qblocks")).withColumn("block", every("blocks"))
    right = homes.join(sizes, "cell").withColumn("block", part("blocks")).withColumn("qblock", every("qblocks"))
    task = ["cell", "block", "qblock"]
    parallel = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    side = lambda df: df.select(*task, "id", "v").repartition(parallel, *task).groupBy(*task)  # noqa: E731  the work is in the products, not in the bytes
    found = side(left).cogroup(side(right)).applyInArrow(_solve(k), "query_id long, vec_id long, score long")
    found = _best(found.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))), k, "query_id", "salt").drop("rank", "salt")
    return _best(found, k, "query_id").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k_sql(k: int = 10, scale: int = 1024, every: int = 100) -> str:
    """The query in DuckDB's SQL."""
    return f"""WITH fine AS (SELECT vec_id, [floor({scale} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      pairs AS (SELECT q.vec_id AS query_id, x.vec_id, list_sum([q.v[i] * x.v[i] for i in range(1, len(q.v) + 1)])::BIGINT AS score
        FROM fine q JOIN fine x ON q.vec_id % {every} = 0 AND q.vec_id <> x.vec_id),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
      SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""
