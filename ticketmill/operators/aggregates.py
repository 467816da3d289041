"""Cluster aggregates. Each one pre-aggregates before its shuffle or works on a bounded part of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions import dates as dt
from ticketmill.functions.prompts import CLUSTER_TEXT_LENGTH
from ticketmill.operators.ranking import rank_in_group
from ticketmill.session import Workspace

UNKNOWN = "Unknown"
# ids or texts per part of a cluster's list
LIST_PART = 10_000
TEXT_PART = 200


def most_frequent(df: DataFrame, group: list[str], fields: list[str], default: str = UNKNOWN) -> DataFrame:
    """Most frequent value of each field per group; nulls do not count, ties go to the smallest value.

    Values are counted first, so the state per group is one row per distinct value and spread over tasks.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    counted = (
        df.select(*group, F.explode(pairs).alias("p"))
        .groupBy(*group, F.col("p.field").alias("field"), F.col("p.value").alias("value"))
        .agg(F.count("p.value").alias("n"))
    )

    def pick(field: str) -> Column:
        # the smallest (-n, value) belongs to the highest count, then to the smallest value
        rank = F.when((F.col("field") == field) & (F.col("n") > 0), F.struct(-F.col("n"), F.col("value")))
        return F.coalesce(F.min_by("value", rank), F.lit(default)).alias(field)

    return counted.groupBy(*group).agg(*[pick(f) for f in fields])


def first_seen_mode(df: DataFrame, group: list[str], field: str, order: str, default: str = "N/A") -> DataFrame:
    """Most frequent value per group; ties go to the value that appears first in ``order``."""
    counted = df.groupBy(*group, field).agg(F.count(field).alias("_n"), F.min(order).alias("_first"))
    rank = F.when(F.col("_n") > 0, F.struct(F.col("_n"), -F.col("_first")))
    return counted.groupBy(*group).agg(F.coalesce(F.max_by(field, rank), F.lit(default)).alias(field))


def earliest_day(ts: str | Column) -> Column:
    """Earliest valid date as text, empty if there is none."""
    return F.coalesce(dt.day_text(F.min(dt.utc_time(ts))), F.lit(""))


def seen_between(created: str, updated: str) -> tuple[Column, Column]:
    """First and last time over two columns, nulls ignored."""
    c, u = dt.utc_time(created), dt.utc_time(updated)
    return F.least(F.min(c), F.min(u)), F.greatest(F.max(c), F.max(u))


def spread_days(first: Column, last: Column) -> Column:
    """Whole days between two times, 0 if one is missing."""
    micros = F.unix_micros(last) - F.unix_micros(first)
    return F.greatest(F.lit(0), F.coalesce(F.floor(micros / 86_400_000_000), F.lit(0)))


def frequency_label(days: Column, count: Column) -> Column:
    return F.concat(days.cast("string"), F.lit("d + "), count.cast("string"))


def severity(count: Column) -> Column:
    return F.when(count >= 5, "High").when(count >= 3, "Medium").otherwise("Low")


def distinct_sorted(df: DataFrame, group: list[str], field: str, sep: str = ", ") -> DataFrame:
    """Distinct values in order, joined, without blanks and "nan"; values are made distinct before they meet."""
    value = F.col(field).cast("string")
    kept = F.when((value != "") & (value != "nan"), value)
    distinct = df.select(*group, kept.alias(field)).distinct()
    return distinct.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_list(field)), sep).alias(field))


def distinct_parts(
    ws: Workspace, df: DataFrame, group: str, field: str, sep: str = ", ", size: int = LIST_PART
) -> DataFrame:
    """Distinct values in order, joined, without blanks and "nan", in parts of ``size`` values: (group, part, field).

    For value sets of any size: values are made distinct and ranked by sorted ranges, and no row or task holds more
    than a part. The parts, joined by ``sep``, are what ``distinct_sorted`` gives. Groups without a value have no row.
    """
    value = F.col(field).cast("string")
    distinct = df.select(group, value.alias(field)).where((F.col(field) != "") & (F.col(field) != "nan")).distinct()
    ranked = ws.save(rank_in_group(ws, ws.save(distinct, "distinct"), group, [field]), "ranked")
    return list_parts(ranked, group, field, sep=sep, size=size)


def _in_order(value: str, rank: str, sep: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(value).alias("v"))))
    return F.array_join(F.transform(ordered, lambda e: e["v"]), sep)


def list_parts(
    ranked: DataFrame, group: str, value: str, rank: str = "rank", sep: str = ", ", size: int = LIST_PART
) -> DataFrame:
    """A group's values in order, joined, in parts of ``size`` values: (group, part, value).

    The list is whole: the parts, joined by ``sep``, are the full text. Groups up to ``size`` have one part.
    """
    part = F.floor(F.col(rank) / size).alias("part")
    return ranked.groupBy(group, part).agg(_in_order(value, rank, sep).alias(value))


def first_joined(
    ranked: DataFrame, group: str, value: str, k: int, alias: str, rank: str = "rank", sep: str = ", "
) -> DataFrame:
    """The first k values of each group, joined."""
    return ranked.where(F.col(rank) < k).groupBy(group).agg(_in_order(value, rank, sep).alias(alias))


def head_text(
    ranked: DataFrame,
    group: str,
    text: str,
    alias: str,
    rank: str = "rank",
    sep: str = "\n",
    length: int = CLUSTER_TEXT_LENGTH,
) -> DataFrame:
    """The first ``length`` characters of a group's texts joined in order.

    Every row but the first adds at least its separator, so rows after the first ``length + 1`` cannot matter;
    of these, the rows that start within the cut are kept before any text is collected.
    """
    head = ranked.where(F.col(rank) <= length).select(
        group, rank, F.substring(F.coalesce(text, F.lit("")), 1, length).alias(text)
    )
    before = Window.partitionBy(group).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(text) + len(sep)).over(before), F.lit(0))
    kept = head.withColumn("_start", start).where(F.col("_start") <= length)
    joined = kept.groupBy(group).agg(_in_order(text, rank, sep).alias(alias))
    return joined.withColumn(alias, F.substring(alias, 1, length))


def count_share(df: DataFrame, key: str, n: str = "n", share: str = "share", digits: int = 6) -> DataFrame:
    """Each key's share of the total of ``n``."""
    total = df.agg(F.sum(n).alias("t")).scalar()
    return df.withColumn(share, F.round(F.coalesce(F.try_divide(F.col(n), total), F.lit(0.0)), digits))
