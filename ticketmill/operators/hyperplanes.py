"""Approximate candidates for cosine joins: signs of random hyperplanes in bands, an exact comparison inside buckets, measured recall.

Each vector has ``bands`` keys of ``bits`` signs. Vectors that share a key of some band are compared exactly, block by block as in
``cell_join``, so a bucket of any size is split over tasks and only true matches are emitted. Two vectors at angle a share
a given key with probability (1 - a / pi) ^ bits; the number of bands follows from the recall wanted at the threshold.
Pairs are missed, never wrong, and ``recall`` says how many: it is a choice for tables on which the exact join is too dear, and no operator
takes it by itself.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators.similarity import _flat, cell_join
from ticketmill.session import Workspace

TARGET = 0.98
MOST_BANDS = 24
MOST_BITS = 31
SEED = 20_240_101


def bands_for(t: float, bits: int, target: float = TARGET) -> int:
    """How many bands of ``bits`` signs find a pair of similarity ``t`` with probability ``target``."""
    same = (1 - math.acos(min(t, 1.0)) / math.pi) ** bits
    return 1 if same >= target else math.ceil(math.log(1 - target) / math.log(1 - same))


def bits_for(t: float, target: float = TARGET, most_bands: int = MOST_BANDS) -> int:
    """The most selective key whose bands are few enough: each band is a copy of every vector."""
    return max((bits for bits in range(1, MOST_BITS + 1) if bands_for(t, bits, target) <= most_bands), default=1)


def signatures(vectors: DataFrame, width: int, bands: int, bits: int, seed: int = SEED) -> DataFrame:
    """Rows (pos, idx, val, keys): one whole number per band. Planes come from ``seed``, width * bands * bits numbers."""
    if not 0 < bits <= MOST_BITS:
        raise ValueError(f"1 to {MOST_BITS} bits a band")
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        planes = np.random.default_rng(seed).standard_normal((width, bands * bits))
        for batch in batches:
            val, row = _flat(batch.column("val"))
            idx, _ = _flat(batch.column("idx"))
            x = np.zeros((batch.num_rows, width))
            x[row, idx] = val
            keys = ((x @ planes) > 0).reshape(-1, bands, bits) @ weights
            offsets = pa.array(np.arange(batch.num_rows + 1) * bands, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("pos"), batch.column("idx"), batch.column("val"), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                names=["pos", "idx", "val", "keys"],
            )

    usable = vectors.where(F.size("idx") > 0).select("pos", "idx", "val").distinct()  # a row that comes twice has its pairs once
    return usable.mapInArrow(run, "pos long, idx array<int>, val array<double>, keys array<long>")


def approximate_pairs(
    ws: Workspace, vectors: DataFrame, t: float, width: int, bits: int | None = None, target: float = TARGET, seed: int = SEED
) -> DataFrame:
    """Pairs (l, r, sim) with l < r and similarity at least ``t`` that share a key of some band; ``sim`` is exact.

    Inputs are unit vectors (pos, idx, val) with unique positions; zero vectors match nothing. Fold equal vectors first, as for the
    exact joins. No rows give no pairs. A pair that shares keys of several bands is found in the first of them.
    """
    bits = bits or bits_for(t, target)
    keyed = signatures(vectors, width, bands_for(t, bits, target), bits, seed)
    buckets = keyed.select("pos", "idx", "val", "keys", F.posexplode("keys").alias("band", "key")).withColumn("bucket", F.concat_ws(":", "band", "key"))
    buckets = buckets.withColumn("earlier", F.slice("keys", F.lit(1), F.col("band"))).drop("keys")
    return cell_join(ws, ws.save(buckets, "buckets"), None, t, width, group="bucket", earlier="earlier")


def recall(ws: Workspace, vectors: DataFrame, found: DataFrame, t: float, width: int, every: int = 10) -> DataFrame:
    """One row (pairs, found_pairs, recall): rows whose position is divisible by ``every`` are compared exactly with all rows.

    Recall is 1 if they have no partner.
    """
    left = vectors.where(F.pmod("pos", F.lit(every)) == 0)
    exact = cell_join(ws, left, vectors, t, width).where("l <> r").select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r")).distinct()
    counts = lambda c: F.pmod(c, F.lit(every)) == 0
    hits = found.where(counts("l") | counts("r")).select("l", "r", F.lit(1).alias("hit"))  # no others are in the exact pairs
    counted = exact.join(hits, ["l", "r"], "left").agg(F.count("*").alias("pairs"), F.count("hit").alias("found_pairs"))
    return counted.withColumn("recall", F.coalesce(F.try_divide("found_pairs", "pairs"), F.lit(1.0)))
