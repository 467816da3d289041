"""Ticket and snapshot tables as views over the supplied tables, for Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.functions import text as tx

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"


SPREAD = ("documents", "pages")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table; one that fills fewer tasks than there are cores (a single small file) is spread."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in SPREAD and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def issues(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets from ``documents``: the first line is the summary; ids, dates and status follow from doc_id and labels."""
    quality = table(spark, folder, "labels").select("doc_id", "quality")
    docs = table(spark, folder, "documents").join(quality, "doc_id", "left")
    summary = F.substring_index("text", "\n", 1)
    created = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("doc_id").cast("int"))
    updated = created + F.make_dt_interval((F.col("doc_id") % 30).cast("int"))
    completed = created + F.make_dt_interval(F.lit(10))
    return docs.select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("OPS-"), F.col("doc_id").cast("string")).alias("id"),
        summary.alias("summary"),
        F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("description"),
        F.col("source").alias("feature"),
        F.col("lang").alias("error_type"),
        F.when(F.col("quality") == 1, "Done").when(F.col("quality") == 0, "Open").otherwise("Unknown").alias("status"),
        _stamp(created).alias("created"),
        _stamp(updated).alias("updated"),
        F.when(F.col("doc_id") % 3 == 0, _stamp(completed)).otherwise("").alias("completion_date"),
    )


ISSUES = r"""issues AS (
  SELECT d.doc_id AS seq, 'OPS-' || d.doc_id AS id,
    CASE WHEN strpos(d.text, chr(10)) > 0 THEN left(d.text, strpos(d.text, chr(10)) - 1) ELSE d.text END AS summary,
    CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, strpos(d.text, chr(10)) + 1) ELSE '' END AS description,
    d.source AS feature, d.lang AS error_type,
    CASE l.quality WHEN 1 THEN 'Done' WHEN 0 THEN 'Open' ELSE 'Unknown' END AS status,
    TIMESTAMP '2024-01-01' + to_hours(d.doc_id) AS created,
    TIMESTAMP '2024-01-01' + to_hours(d.doc_id) + to_days(CAST(d.doc_id % 30 AS INTEGER)) AS updated,
    CASE WHEN d.doc_id % 3 = 0 THEN TIMESTAMP '2024-01-01' + to_hours(d.doc_id) + to_days(10) END AS completion_date
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly cluster rows from all of ``orders`` and ``customer``; a cluster is a customer's orders of one priority."""
    orders = table(spark, folder, "orders")
    joined = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.trunc("o_orderdate", "month").alias("month_start"),
        (F.col("o_custkey") * 5 + F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("cluster_id"),
        "c_mktsegment",
        "o_orderpriority",
        "o_orderdate",
    )
    from ticketmill.operators.aggregates import most_frequent

    key = ["month_start", "cluster_id"]
    base = joined.groupBy(*key).agg(F.count("*").alias("total_tickets"), F.min("o_orderdate").alias("completion_date"))
    modes = most_frequent(joined, key, ["c_mktsegment", "o_orderpriority"])
    named = base.join(modes, key).withColumn(
        "feature", F.concat("c_mktsegment", F.lit("-"), (F.col("cluster_id") % 12).cast("string"))
    )
    return named.select(
        *key,
        ((F.year("month_start") * 12 + F.month("month_start")) * 10_000_000_000 + F.col("cluster_id")).alias("pos"),
        "feature",
        F.col("o_orderpriority").alias("error_type"),
        F.concat("feature", F.lit("/"), "o_orderpriority", F.lit("/"), (F.col("cluster_id") % 97).cast("string")).alias("root_cause"),
        "total_tickets",
        "completion_date",
    )


SNAPSHOT = r"""joined AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, o_custkey * 5 + CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS cluster_id,
    c_mktsegment, o_orderpriority, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey),
seg AS (
  SELECT month_start, cluster_id, c_mktsegment,
    row_number() OVER (PARTITION BY month_start, cluster_id ORDER BY count(*) DESC, c_mktsegment) AS rn
  FROM joined GROUP BY month_start, cluster_id, c_mktsegment),
pri AS (
  SELECT month_start, cluster_id, o_orderpriority,
    row_number() OVER (PARTITION BY month_start, cluster_id ORDER BY count(*) DESC, o_orderpriority) AS rn
  FROM joined GROUP BY month_start, cluster_id, o_orderpriority),
base AS (
  SELECT month_start, cluster_id, count(*) AS total_tickets, min(o_orderdate) AS completion_date
  FROM joined GROUP BY month_start, cluster_id),
snapshot AS (
  SELECT b.month_start, b.cluster_id, (year(b.month_start) * 12 + month(b.month_start)) * 10000000000 + b.cluster_id AS pos,
    c_mktsegment || '-' || (b.cluster_id % 12) AS feature, o_orderpriority AS error_type,
    c_mktsegment || '-' || (b.cluster_id % 12) || '/' || o_orderpriority || '/' || (b.cluster_id % 97) AS root_cause,
    b.total_tickets, b.completion_date
  FROM base b
  JOIN seg s ON s.month_start = b.month_start AND s.cluster_id = b.cluster_id AND s.rn = 1
  JOIN pri p ON p.month_start = b.month_start AND p.cluster_id = b.cluster_id AND p.rn = 1)"""

# the patterns of functions.text in the oracle's regular expressions, which have no look-behind
SPACE_SQL = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NOT_SPACE_SQL = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
MAIL_SQL = r"[\p{L}\p{N}_.\-]+@[\p{L}\p{N}_.\-]+"
TOKEN_SQL = r"[\p{L}\p{N}_]{2,}"


def norm_sql(text: str) -> str:
    inner = f"regexp_replace(lower({text}), '{MAIL_SQL}', ' ', 'g')"
    inner = f"regexp_replace({inner}, 'https?://{NOT_SPACE_SQL}+', ' ', 'g')"
    return f"trim(regexp_replace({inner}, '{SPACE_SQL}+', ' ', 'g'))"


def crux_sql(text: str) -> str:
    inner = f"lower({text})"
    for pattern in (r"\b0x[0-9a-f]+\b", r"\b[a-z]{2,}-\d+\b", rf"https?://{NOT_SPACE_SQL}+|www\.{NOT_SPACE_SQL}+", MAIL_SQL):
        inner = f"regexp_replace({inner}, '{pattern}', ' ', 'g')"
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in tx.CRUX_STOP_WORDS)
    words = f"list_filter(regexp_extract_all({inner}, '[a-z0-9\\-]+'), lambda w: NOT list_contains([{stop}], w))"
    return f"coalesce(nullif(array_to_string(({words})[1:10], ' '), ''), '{tx.NO_CRUX}')"


def mode_sql(source: str, key: str, field: str, name: str) -> str:
    """CTE ``name`` with the most frequent value per key, ties to the smallest value."""
    return f"""{name} AS (SELECT {key}, {field} FROM (
  SELECT {key}, {field}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {field}) AS rn
  FROM {source} WHERE {field} IS NOT NULL GROUP BY {key}, {field}) WHERE rn = 1)"""


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def month_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
