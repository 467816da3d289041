"""A bitmap of fixed size over long ids, so that a join needs to shuffle little more of a wide table than it keeps.

The bitmap only spares work: an id that is wanted is always let through, others may be, and the join that follows decides. When
very many ids are wanted it fills up and the join shuffles everything, as it would have done without.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23  # 1 MB


def bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """Ids modulo the size, packed; at most BITS / 32 rows come to the driver whatever the input."""
    place = F.pmod(F.col(column), F.lit(BITS))
    rows = (
        ids.select(F.shiftright(place, 5).cast("int").alias("word"), place.cast("int").bitwiseAND(31).alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    )
    out = np.zeros(BITS >> 5, np.uint32)
    if rows:
        out[[r[0] for r in rows]] = np.array([r[1] for r in rows], np.uint32)
    return out.view(np.uint8)


def marked(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = ids % BITS
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def only_marked(column: str, bits):
    """A batch function that keeps the rows whose id (a long that is not null) is marked in the broadcast bitmap."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(marked(batch.column(column).to_numpy(zero_copy_only=False), bits.value)))

    return run


def few(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose long id is among ``ids`` (in a column of the same name), and perhaps some more."""
    bits = df.sparkSession.sparkContext.broadcast(bitmap(ids, column))
    return df.mapInArrow(only_marked(column, bits), df.schema)
