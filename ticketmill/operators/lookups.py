"""Name lookups in small reference lists (projects, boards, fields), and first-match lookups in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions.text import stripped


def clean_name(name: str | Column) -> Column:
    """Trimmed lower-case name."""
    column = F.col(name) if isinstance(name, str) else name
    return F.lower(stripped(F.coalesce(column, F.lit(""))))


def _first_preferred(df: DataFrame, preferred: Column, value: str, position: str, alias: str) -> DataFrame:
    rank = F.struct(F.when(preferred, 0).otherwise(1), F.col(position))
    return df.agg(F.min_by(value, rank).alias(alias))


def by_name_or_first(df: DataFrame, name: str, wanted: str, value: str, position: str, alias: str) -> DataFrame:
    """Value of the first row with the name, ignoring case and outer blanks; else of the first row."""
    return _first_preferred(df, clean_name(name) == clean_name(F.lit(wanted)), value, position, alias)


def by_exact_name_or_first(df: DataFrame, name: str, wanted: str, value: str, position: str, alias: str) -> DataFrame:
    return _first_preferred(df, F.col(name) == wanted, value, position, alias)


def by_part_of_name_or_first(
    df: DataFrame, name: str, part: str, value: str, position: str, alias: str
) -> DataFrame:
    """Value of the first row whose lower-case name contains ``part``; else of the first row."""
    return _first_preferred(df, F.lower(F.coalesce(name, F.lit(""))).contains(part), value, position, alias)


def first_row(df: DataFrame, value: str, position: str, alias: str) -> DataFrame:
    """Value of the first row, null if there is none."""
    return df.agg(F.min_by(value, position).alias(alias))


def ids_by_name(wanted: DataFrame, fields: DataFrame, display: str, name: str, value: str, position: str) -> DataFrame:
    """Left join on the cleaned name; of equal names the first row counts; no match gives an empty id."""
    first = fields.groupBy(clean_name(name).alias("_name")).agg(F.min_by(value, position).alias(value))
    return (
        wanted.withColumn("_name", clean_name(display))
        .join(first, "_name", "left")
        .withColumn(value, F.coalesce(F.col(value).cast("string"), F.lit("")))
        .drop("_name")
    )


def first_match(df: DataFrame, key: str, value: str, order: str | Column) -> DataFrame:
    """Value of the first row of each key."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(value))
