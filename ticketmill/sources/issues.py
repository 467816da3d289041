"""Ticket tables: landed exports (CSV, JSON pages), column repair, lookback windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.functions import dates as dt
from ticketmill.functions import options as op
from ticketmill.functions import text as tx
from ticketmill.operators.ranking import with_position
from ticketmill.session import Workspace

ISSUE_COLUMNS = ["id", "summary", "description", "feature", "error_type", "created", "updated"]
ISSUE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ISSUE_COLUMNS])
FEATURE_FIELD = "customfield_10015"
ERROR_FIELD = "customfield_10016"
PAGE_SCHEMA = T.StructType([T.StructField("issues", T.ArrayType(T.StringType()))])
EXCLUDED_TABLES = ("Summary", "Config", "Sheet1")


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """CSV by the names in its header, every column a string; quoted texts may hold line breaks and doubled quotes.

    The ``required`` columns must be in the header. Missing ones of the usual columns are added as nulls, others stay.
    """
    held = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', nullValue="", emptyValue="")
    require_columns(held, *required)
    return held.withColumns({c: F.lit(None).cast("string") for c in ISSUE_COLUMNS if c not in held.columns})


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per issue from landed result pages ({"issues": [...]}, one per line); a malformed page is an error."""
    pages = spark.read.schema(PAGE_SCHEMA).json(path, mode="FAILFAST")
    return pages.select(F.explode("issues").alias("raw")).withColumn("issue", F.try_parse_json("raw"))


def _field(name: str) -> Column:
    return F.try_variant_get("issue", f"$.fields.{name}", "variant")


def _field_text(name: str) -> Column:
    return F.try_variant_get("issue", f"$.fields.{name}", "string")


def _field_json(name: str) -> Column:
    """JSON text of a field; null only if the field is absent (an explicit null is the text ``null``)."""
    value = _field(name)
    text = F.when(F.schema_of_variant(value) == "STRING", F.to_json(value)).otherwise(
        F.get_json_object("raw", f"$.fields.{name}")
    )
    return F.when(value.isNotNull(), F.coalesce(text, F.lit("null")))


def or_blank(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def flatten_issues(pages: DataFrame, completion_field: str | None = None) -> DataFrame:
    """Flat rows from issue objects.

    Feature and error type default to "Unknown" only if the field is absent; an explicit null stays null here
    and becomes "Unknown" in ``option_text``. They and the description are kept as JSON text, since they have several shapes.
    """

    def choice(name: str) -> Column:
        raw = _field_json(name)
        return F.when(raw.isNull(), F.lit('"Unknown"')).when(raw != "null", raw)

    completion = _field_text(completion_field) if completion_field else F.lit(None).cast("string")
    updated = or_blank(_field_text("updated"))
    return pages.select(
        or_blank(F.try_variant_get("issue", "$.key", "string")).alias("id"),
        tx.rich_text(_field_json("summary")).alias("summary"),
        tx.rich_text(_field_json("description")).alias("description"),
        choice(FEATURE_FIELD).alias("feature"),
        choice(ERROR_FIELD).alias("error_type"),
        op.named_object_text(_field_json("status")).alias("status"),
        op.named_object_text(_field_json("priority")).alias("priority"),
        or_blank(_field_text("created")).alias("created"),
        updated.alias("updated"),
        completion_or_updated(completion, updated).alias("completion_date"),
    )


def with_option_text(df: DataFrame) -> DataFrame:
    return df.withColumn("feature", op.option_text("feature")).withColumn("error_type", op.option_text("error_type"))


def completion_or_updated(completion: str | Column, updated: str | Column) -> Column:
    """The completion date, or the time of the last update where it is blank."""
    c = F.col(completion) if isinstance(completion, str) else completion
    u = F.col(updated) if isinstance(updated, str) else updated
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), u.cast("string"))


def first_non_empty(sources: list[DataFrame]) -> DataFrame:
    """Rows of the first source that has any."""
    columns = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.limit(0) for s in sources])
    first = next((s for s in sources if not s.isEmpty()), sources[0])
    return columns.unionByName(first, allowMissingColumns=True)


def append_sources(first: DataFrame, second: DataFrame, unique: bool = True) -> DataFrame:
    """Rows of both sources; with ``unique``, those of the second whose id the first has are left out. Blank ids are no ids."""
    if unique:
        second = second.join(first.where("id <> ''").select("id").distinct(), "id", "left_anti").select(second.columns)
    return first.unionByName(second, allowMissingColumns=True)


def with_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Add the columns that are missing."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def keep_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the wanted columns that exist, in the wanted order."""
    return df.select([c for c in wanted if c in df.columns])


def created_within(df: DataFrame, as_of: Column, days: int, column: str = "created") -> DataFrame:
    return df.where(dt.within_days(column, as_of, days))


def newest(df: DataFrame, limit: int, column: str = "created") -> DataFrame:
    """The newest rows, ties by id; a limit is part of the feature."""
    return df.orderBy(F.desc(column), F.asc("id")).limit(limit)


def with_row_order(ws: Workspace, df: DataFrame) -> DataFrame:
    """Number the rows from the newest to the oldest as ``seq``; those without a valid time come last."""
    age = F.coalesce(-F.unix_micros(dt.utc_time("created")), F.lit((1 << 63) - 1))
    return with_position(ws, df.withColumn("_age", age), ["_age", "id"], "seq").drop("_age")


def month_tables(df: DataFrame, table: str = "month") -> DataFrame:
    """Rows of all report tables except the named ones that are no months."""
    return df.where(~F.col(table).isin(*EXCLUDED_TABLES))


