"""Row positions, ranks inside groups and key joins that stay parallel when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.session import Workspace

# a key is hot if it holds more than one row in HOT_PARTS, so there are fewer than HOT_PARTS hot keys
HOT_PARTS = 1000


def with_position(ws: Workspace, df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in the given order, without sorting in one task.

    Rows are range-partitioned and sorted inside the partitions; the size of each partition then
    gives its offset. Only the list of partitions (bounded by the partition count) is broadcast.
    """
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    saved = ws.save(ordered, f"ordered-{name}").withColumn("_part", F.shiftright("_row", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        saved.groupBy("_part")
        .agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
        .select("_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        saved.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") - F.col("_first"))
        .drop("_part", "_row", "_first", "_offset")
    )


def join_by_key(rows: DataFrame, groups: DataFrame, key: str, size: str = "n") -> DataFrame:
    """Left join of many rows to one row per key; ``groups[size]`` is the number of rows of the key.

    The rows of hot keys meet a broadcast of the hot groups (fewer than HOT_PARTS by definition), so
    they never move; the others are shuffled, and no key there holds more than 1/HOT_PARTS of the rows.
    """
    total = groups.agg(F.sum(size).alias("t")).scalar()
    hot = groups.where(F.col(size) * HOT_PARTS > total)
    hot_keys = F.broadcast(hot.select(key))
    cold_rows = rows.join(hot_keys, key, "left_anti").join(groups, key, "left")
    hot_rows = rows.join(F.broadcast(hot), key, "inner")
    return cold_rows.unionByName(hot_rows)


def rank_in_group(ws: Workspace, df: DataFrame, group: str, order: list[str], rank: str = "rank") -> DataFrame:
    """Add the 0-based rank inside the group, and the group's size as ``n``.

    A window partitioned by the group would put a hot group into one task. Here the rows are sorted
    by (group, order) over all tasks and the group's first position is subtracted.
    """
    placed = ws.save(with_position(ws, df, [group, *order], "_pos"), "placed")
    starts = placed.groupBy(group).agg(F.min("_pos").alias("_start"), F.count("*").alias("n"))
    starts = ws.save(starts, "starts")
    return (
        join_by_key(placed, starts, group)
        .withColumn(rank, F.col("_pos") - F.col("_start"))
        .drop("_pos", "_start")
    )


def first_rows(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark prunes to k rows per group before the shuffle."""
    return (
        df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        .where(F.col("_rn") <= k)
        .drop("_rn")
    )
