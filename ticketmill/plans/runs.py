"""The three jobs end to end: tables in, tables out. Each step's result is a table the next one reads."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.functions import dates as dt
from ticketmill.functions import text as tx
from ticketmill.operators import tracking as tr
from ticketmill.operators.enrich import BatchFunction, label_tickets, model_vectors
from ticketmill.plans import clusters as cl
from ticketmill.plans import firsts as fi
from ticketmill.plans import marts as ma
from ticketmill.plans import monthly as mo
from ticketmill.session import Workspace, stored
from ticketmill.sources import issues as src
from ticketmill.sources import sinks

CLUSTER_COLUMNS = [
    "cluster_id", "id", "summary", "description", "feature", "error_type", "created", "updated", "completion_date", "combined",
]


def run_files(ws: Workspace, issues_csv: str, out: str, model: BatchFunction | None = None) -> dict[str, str]:
    """Issues CSV to clusters CSV to both pattern tables; returns their folders."""
    paths = {name: f"{out}/{name}" for name in ("clusters", "patterns", "short_patterns")}
    tickets = src.read_csv(ws.spark, issues_csv, required=("summary", "description"))
    ordered = ws.save(src.with_row_order(ws, tickets), "tickets")
    clustered = ws.save(cl.file_clusters(ws, ordered), "clustered")
    sinks.write_csv(src.keep_columns(clustered, CLUSTER_COLUMNS), paths["clusters"])
    sinks.write_csv(cl.pattern_report(ws, clustered, model), paths["patterns"])
    sinks.write_csv(cl.short_patterns(ws, clustered, model), paths["short_patterns"])
    return paths


class Models(NamedTuple):
    """A user's batch functions: replies to prompts (frames with ``prompt``) and vectors of texts (frames with ``text``)."""

    labels: BatchFunction | None = None
    texts: BatchFunction | None = None
    vectors: BatchFunction | None = None
    vector_size: int = 0
    memo: str | None = None  # a folder for vectors that were asked for already


DEFAULTS = {"feature": "Unknown", "error_type": "Unknown", "status": "Unknown", "created": "", "updated": "", "completion_date": ""}


def _prepared(ws: Workspace, tickets: DataFrame) -> DataFrame:
    """Tickets with all columns of a report, numbered from the newest; dates of completion fall back to the last update."""
    tickets = src.with_defaults(tickets, DEFAULTS)
    completed = src.completion_or_updated("completion_date", "updated")
    return ws.save(src.with_row_order(ws, tickets.withColumn("completion_date", completed)), "tickets")


def _labelled(ws: Workspace, tickets: DataFrame, models: Models) -> DataFrame:
    return tickets if models.labels is None else ws.save(label_tickets(tickets, models.labels), "labelled")


def _vectors(ws: Workspace, tickets: DataFrame, models: Models) -> tuple[DataFrame, int]:
    text = tx.normalize_text(tx.combined_text())
    return model_vectors(ws, tickets, text, models.vectors, models.vector_size, memo=models.memo)


def run_daily(
    ws: Workspace, tickets: DataFrame, as_of: Column, out: str, days: int = 1, models: Models = Models(), export: str | None = None
) -> DataFrame:
    """Recent tickets, labelled and clustered, to the report table at ``out``, replaced as a whole; ``export`` gets every ticket with its cluster as CSV."""
    tickets = src.with_defaults(tickets, DEFAULTS)
    recent = src.created_within(tickets.withColumn("_created", dt.utc_time("created")), as_of, days, "_created").drop("_created")
    ordered = _labelled(ws, _prepared(ws, recent), models)
    vectors, width = _vectors(ws, ordered, models)
    clustered = ws.save(cl.daily_clusters(ws, ordered, vectors=vectors, width=width), "clustered")
    if export is not None:
        sinks.write_csv(src.keep_columns(clustered, CLUSTER_COLUMNS).orderBy("cluster_id", "id"), export)
    report = cl.daily_report(ws, clustered, models.texts)
    sinks.replace_table(report, out, order=["cluster_id", "part"])
    return ws.spark.read.schema(report.schema).parquet(out)


def run_board(ws: Workspace, tickets: DataFrame, out: str, models: Models = Models(), cap: int | None = None) -> DataFrame:
    """A board's tickets, at most the ``cap`` newest, to its report at ``out``: no guard, and the model sees whole clusters."""
    ordered = _prepared(ws, tickets)
    if cap is not None:
        ordered = ordered.where(F.col("seq") < cap)
    ordered = _labelled(ws, ordered, models)
    vectors, width = _vectors(ws, ordered, models)
    clustered = ws.save(cl.board_clusters(ws, ordered, vectors=vectors, width=width), "clustered")
    report = cl.board_report(ws, clustered, models.texts)
    sinks.replace_table(report, out, order=["cluster_id", "part"])
    return ws.spark.read.schema(report.schema).parquet(out)


def run_monthly(
    ws: Workspace, tickets: DataFrame, as_of: Column, out: str, months: int = 3,
    labels: BatchFunction | None = None, model: BatchFunction | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Reports of the last months into month partitions below ``out``, then the summary over all stored months."""
    completed = src.completion_or_updated("completion_date", "updated")
    dated = mo.with_month(tickets.withColumn("completion_date", completed))
    wanted = ws.save(mo.report_months(dated, as_of, months), "tickets")
    report = mo.monthly_report(ws, mo.monthly_clusters(ws, wanted), labels, model)
    names = [r["cluster_month"] for r in mo.month_counts(wanted, as_of, months).collect()]  # one row per month
    columns = [c for c in report.columns if c != sinks.MONTH_COLUMN] + [sinks.MONTH_COLUMN]
    report = ws.save(report.select(columns), "report").repartition(sinks.MONTH_COLUMN).sortWithinPartitions(sinks.MONTH_COLUMN, "cluster_id")
    sinks.replace_months(report, out, names)
    months_held = sinks.read_months(ws.spark, out, report.schema)
    snapshot = months_held.withColumnRenamed("recurring_summary", "root_cause").withColumn("completion_date", F.col("create_date").cast("date"))
    return months_held, ma.report_summary(snapshot, as_of.cast("date"))


def run_tracks(ws: Workspace, clustered: DataFrame, vectors: DataFrame, out: str, width: int, match: float = tr.MATCH) -> DataFrame:
    """Track the clusters of some months on from the months stored below ``out``, and store them there; returns all stored tracks.

    Rows (period, group, n, idx, val, first_period, first_group, cluster_month). Months that are tracked again replace what was stored
    of them; those after them are to be tracked again too. The vectors must mean the same in every run, as a model's do; TF-IDF
    weights depend on the texts of the run, so with them all months belong into one run.
    """
    centroids = mo.month_centroids(ws, clustered, vectors)
    months = centroids.select("period", dt.month_tag("period").alias(sinks.MONTH_COLUMN)).distinct()
    names = [r[sinks.MONTH_COLUMN] for r in months.collect()]  # one row per month
    schema = T.StructType(
        [*centroids.schema.fields, T.StructField("first_period", T.DateType()), T.StructField("first_group", centroids.schema["group"].dataType),
         T.StructField(sinks.MONTH_COLUMN, T.StringType())]
    )
    known = None
    if stored(ws.spark, out):
        earlier = sinks.read_months(ws.spark, out, schema)
        before = earlier.join(F.broadcast(months.agg(F.min("period").alias("start"))), F.col("period") < F.col("start")).drop("start")
        last = before.agg(F.max("period").alias("last"))
        known = ws.save(before.join(F.broadcast(last), F.col("period") == F.col("last")).drop("last"), "known")
    tracks = tr.track_groups(ws, centroids, width, match, known).drop("n")
    rows = centroids.join(tracks, ["period", "group"]).withColumn(sinks.MONTH_COLUMN, dt.month_tag("period"))
    sinks.replace_months(ws.save(rows.select(schema.names), "tracks"), out, names)
    return sinks.read_months(ws.spark, out, schema)


def run_dashboards(ws: Workspace, snapshot: DataFrame, out: str, since: Column | None = None) -> dict[str, DataFrame]:
    """The dashboard tables over stored months, each replaced below ``out`` and sorted by its key; returns them as read back.

    ``snapshot`` holds all stored months. New causes come from first months that are stored below ``out`` too: with ``since``, only rows of
    that month and later are compared with them, as a monthly run needs; without, all months are. Months are
    listed even if nothing in them is new.
    """
    placed = ws.save(snapshot.withColumn("pos", F.struct("month_start", "cluster_id")), "snapshot")
    recent = placed if since is None else placed.where(F.col("month_start") >= since)
    firsts = fi.update_first_months(ws, recent, f"{out}/first_causes", "root_cause")
    fresh = fi.fresh_values(firsts, placed).withColumnRenamed("new_values", "new_root_causes")
    tables = {
        "month_health": (ma.month_health(placed).drop("new_root_causes").join(fresh, "month_start"), ["month_start"]),
        "month_trend": (ma.month_trend(placed), ["month_start"]),
        "error_types_by_month": (ma.error_types_by_month(placed), ["error_type", "month_start"]),
        "feature_insights": (ma.feature_insights(placed, "pos"), ["feature"]),
        "error_mix": (ma.error_mix_map(placed), ["feature"]),
        "error_insights": (ma.error_insights(placed, "pos"), ["error_type"]),
        "recurrence_tracker": (ma.recurrence_tracker(placed), ["cluster_id"]),
    }
    for name, (rows, order) in tables.items():
        sinks.replace_table(rows, f"{out}/{name}", order)
    return {name: ws.spark.read.parquet(f"{out}/{name}") for name in tables}
