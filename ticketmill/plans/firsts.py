"""First months of values, stored between runs, so that a monthly run reads only its own months to tell new values from known ones.

The stored table has one row per value: the value's columns and ``first_month`` (date), in one partition per first month. A run over the
months from ``since`` on reads the partitions before ``since``, takes from its own months what these do not have, and
writes the partitions from ``since`` on anew. A run may be repeated, and one that starts earlier than the last stored
month must bring all months since then.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.functions import dates as dt
from ticketmill.session import Workspace, stored
from ticketmill.sources import sinks


def _schema(rows: DataFrame, value: str) -> T.StructType:
    return T.StructType(
        [T.StructField(value, rows.schema[value].dataType), T.StructField("first_month", T.DateType()), T.StructField(sinks.MONTH_COLUMN, T.StringType())]
    )


def stored_firsts(ws: Workspace, rows: DataFrame, path: str, value: str) -> DataFrame | None:
    """The table stored at ``path``: (value, first_month, cluster_month); None if nothing is stored yet."""
    return sinks.read_months(ws.spark, path, _schema(rows, value)) if stored(ws.spark, path) else None


def update_first_months(ws: Workspace, rows: DataFrame, path: str, value: str, month: str = "month_start") -> DataFrame:
    """Bring the table at ``path`` up to date with ``rows`` and return it: (value, first_month, cluster_month).

    ``rows`` hold all rows of the months they start with or later. Null values and months take no part; repeated rows count
    once; no rows change nothing. Stored months that come after the first of ``rows`` and are missing there are an
    error, since what they were first to have cannot be told any more.
    """
    own = rows.where(F.col(value).isNotNull() & F.col(month).isNotNull()).select(value, F.col(month).cast("date").alias("first_month"))
    months = {r[0] for r in own.select(F.trunc("first_month", "month")).distinct().collect()}  # one row per month
    earlier = stored_firsts(ws, rows, path, value)
    if not months:
        return earlier if earlier is not None else ws.spark.createDataFrame([], _schema(rows, value))
    since = min(months)
    held: set[date] = set()
    fresh = own.groupBy(value).agg(F.min(F.trunc("first_month", "month")).alias("first_month"))
    if earlier is not None:
        held = {r[0] for r in earlier.where(F.col("first_month") >= F.lit(since)).select("first_month").distinct().collect()}  # one row per month
        if held - months:
            raise ValueError(f"rows of stored months are missing: {sorted(map(str, held - months))}")
        fresh = fresh.join(earlier.where(F.col("first_month") < F.lit(since)).select(value), value, "left_anti")
    tagged = fresh.select(value, "first_month", dt.month_tag("first_month").alias(sinks.MONTH_COLUMN))
    emptied = [d.strftime("%b-%Y") for d in held]
    sinks.replace_months(ws.save(tagged, "firsts").repartition(sinks.MONTH_COLUMN, F.pmod(F.xxhash64(value), F.lit(16))), path, emptied)
    return sinks.read_months(ws.spark, path, _schema(rows, value))


def fresh_values(firsts: DataFrame, months: DataFrame) -> DataFrame:
    """Values per month that no earlier month has, from stored first months: (month_start, new_values); months without any have 0."""
    counted = firsts.groupBy(F.col("first_month").alias("month_start")).agg(F.count("*").alias("new_values"))
    return months.select("month_start").distinct().join(counted, "month_start", "left").select(
        "month_start", F.coalesce("new_values", F.lit(0)).alias("new_values")
    )


def flag_seen(rows: DataFrame, firsts: DataFrame, value: str, month: str = "month_start") -> DataFrame:
    """Each row with a flag: is its value stored with an earlier month? A missing value is not."""
    known = firsts.select(F.col(value).alias("_value"), F.col("first_month").alias("_first"))
    before = F.coalesce(F.col("_first") < F.trunc(month, "month"), F.lit(False))
    return rows.join(known, rows[value] == F.col("_value"), "left").withColumn("seen_before", before).drop("_value", "_first")
