"""Monthly reports: average-linkage clusters per completion month, all months in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import dates as dt
from ticketmill.functions import prompts as pr
from ticketmill.functions import text as tx
from ticketmill.operators import aggregates as ag
from ticketmill.operators import linkage as lk
from ticketmill.operators import tracking as tr
from ticketmill.operators import vectors as vx
from ticketmill.operators.enrich import BatchFunction, label_tickets, reply_column
from ticketmill.operators.ranking import first_rows, rank_in_group
from ticketmill.plans.clusters import told_of_all
from ticketmill.session import Workspace

EXAMPLES = 5


def with_month(tickets: DataFrame, ts: str = "completion_date") -> DataFrame:
    """Add ``month_start`` and ``cluster_month``; tickets without a valid date drop out."""
    dated = tickets.withColumn("completed", dt.utc_time(ts)).where(F.col("completed").isNotNull())
    return dated.withColumn("month_start", dt.month_start("completed")).withColumn("cluster_month", dt.month_tag("completed"))


def report_months(tickets: DataFrame, as_of: Column, months: int = 3) -> DataFrame:
    """Tickets of the month of ``as_of`` and of those before it."""
    start = dt.month_start(as_of)
    return tickets.where(
        (F.col("month_start") >= F.add_months(start, 1 - months)) & (F.col("month_start") <= start)
    )


def month_counts(tickets: DataFrame, as_of: Column, months: int = 3) -> DataFrame:
    """Tickets per wanted month; months without tickets appear with 0."""
    wanted = tickets.sparkSession.range(1).select(F.explode(dt.last_months(as_of, months)).alias("month_start"))
    counted = tickets.groupBy("month_start").agg(F.count("*").alias("tickets"))
    return wanted.join(counted, "month_start", "left").select(
        "month_start", dt.month_tag("month_start").alias("cluster_month"), F.coalesce("tickets", F.lit(0)).alias("tickets")
    )


def monthly_vectors(ws: Workspace, tickets: DataFrame, width: int = vx.MAX_FEATURES) -> DataFrame:
    """TF-IDF vectors of the tickets' texts with labels, over all months given."""
    return vx.tfidf_vectors(ws, tickets, tx.normalize_text(tx.combined_text_with_labels()), max_features=width)


def monthly_clusters(
    ws: Workspace, tickets: DataFrame, vectors: DataFrame | None = None, width: int = vx.MAX_FEATURES, cut: float = lk.CUT
) -> DataFrame:
    """Add ``combined`` and the month's ``cluster_id`` to dated tickets with a ``seq``."""
    combined = tickets.withColumn("combined", tx.combined_text_with_labels())
    if vectors is None:
        vectors = monthly_vectors(ws, tickets, width)
    months = combined.select("seq", F.col("cluster_month").alias("grp"))
    ids = lk.average_linkage(ws, vectors, width, months, cut)
    return combined.join(ids.select("seq", "cluster_id"), "seq")


def month_centroids(ws: Workspace, clustered: DataFrame, vectors: DataFrame) -> DataFrame:
    """Each monthly cluster's centroid, to be stored if later months are to be tracked from here on."""
    return tr.centroids(ws, clustered.select("seq", F.col("month_start").alias("period"), F.col("cluster_id").alias("group")), vectors)


def tracked_clusters(
    ws: Workspace, centroids: DataFrame, width: int = vx.MAX_FEATURES, match: float = tr.MATCH, known: DataFrame | None = None
) -> DataFrame:
    """A key for each monthly cluster that it shares with the clusters it goes on from: (month_start, cluster_id, track_id).

    The key names the month and the number of the first cluster, such as ``Jan-2024/3``.
    """
    tracks = tr.track_groups(ws, centroids, width, match, known)
    key = F.concat_ws("/", dt.month_tag("first_period"), F.col("first_group").cast("string"))
    return tracks.select(F.col("period").alias("month_start"), F.col("group").alias("cluster_id"), key.alias("track_id"))


def monthly_report(
    ws: Workspace, clustered: DataFrame, labels: BatchFunction | None = None, model: BatchFunction | None = None,
    override: str = "always",
) -> DataFrame:
    """One row per month and cluster, with the first five ticket ids."""
    key = ["cluster_month", "month_start", "cluster_id"]
    tickets = clustered
    if labels is not None:
        tickets = ws.save(label_tickets(clustered, labels, override=override), "labelled")
    base = tickets.groupBy(*key).agg(
        F.count("*").alias("total_tickets"), dt.day_text(F.min("completed")).alias("create_date")
    )
    modes = ag.most_frequent(tickets, key, ["feature", "error_type", "status"])
    first = first_rows(tickets.select(*key, "seq", "id", "summary"), key, [F.asc("seq")], EXAMPLES)
    ordered = F.array_sort(F.collect_list(F.struct("seq", F.col("id").cast("string").alias("id"), F.coalesce("summary", F.lit("")).alias("s"))))
    examples = first.groupBy(*key).agg(ordered.alias("o")).select(
        *key,
        F.array_join(F.transform("o", lambda e: e["id"]), ", ").alias("example_ids"),
        pr.note_fallback(F.array_join(F.transform(F.slice("o", 1, 3), lambda e: e["s"]), " ")).alias("note"),
    )
    joined = base.join(modes, key).join(examples, key)
    if model is None:
        replied = joined.withColumn("told", F.lit(None).cast("string"))
    else:
        # all texts of a cluster, in parts: clusters of a month are one group for the ranks
        named = tickets.select(*key, F.concat_ws("/", "cluster_month", "cluster_id").alias("k"), "seq", "combined")
        ranked = ws.save(rank_in_group(ws, named.select("k", "seq", "combined"), "k", ["seq"]), "ranked")
        told = told_of_all(ws, ranked, "k", pr.summary_prompt, model, "told")
        replied = joined.withColumn("k", F.concat_ws("/", "cluster_month", "cluster_id")).join(told, "k", "left").drop("k")
    summary = F.coalesce(F.nullif(tx.stripped("told"), F.lit("")), F.col("note"))
    cruxed = reply_column(replied.withColumn("recurring_summary", summary), pr.crux_prompt(F.col("recurring_summary")), model, "reply")
    return cruxed.select(
        *key, "recurring_summary", F.coalesce(tx.stripped("reply"), F.lit(tx.NO_CRUX_TITLE)).alias("crux"), "feature", "error_type",
        "total_tickets", "example_ids", "status", F.lit(pr.SEE_SUMMARY).alias("resolution_suggestion"), "create_date",
    )
