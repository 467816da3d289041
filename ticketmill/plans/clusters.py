"""From tickets to clustered tickets, and from these to one report row per cluster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import prompts as pr
from ticketmill.functions import text as tx
from ticketmill.operators import aggregates as ag
from ticketmill.operators import keyphrases as kp
from ticketmill.operators import leaders as ld
from ticketmill.operators import vectors as vx
from ticketmill.operators.enrich import BatchFunction, reply_column
from ticketmill.operators.ranking import first_rows, rank_in_group
from ticketmill.session import Workspace
from ticketmill.sources.issues import require_columns

TEXT_THRESHOLD = 0.78
FILE_THRESHOLD = 0.85


def cluster_tickets(
    ws: Workspace,
    tickets: DataFrame,
    text: Column,
    t: float,
    vectors: DataFrame | None = None,
    width: int | None = vx.MAX_FEATURES,
    guard: bool = True,
) -> DataFrame:
    """Add ``combined`` and ``cluster_id`` (null for tickets without a usable word) to tickets with a ``seq``."""
    require_columns(tickets, "seq", "summary", "description")
    if vectors is None:
        vectors = vx.tfidf_vectors(ws, tickets, text)
    ids = ld.leader_clusters(ws, vectors, t, width, guard)
    return tickets.withColumn("combined", tx.combined_text()).join(ids, "seq", "left")


def file_clusters(ws: Workspace, tickets: DataFrame, t: float = FILE_THRESHOLD, vectors: DataFrame | None = None,
                  width: int | None = vx.MAX_FEATURES) -> DataFrame:
    """Clusters of the file based run: raw combined text, no guard against equal vectors."""
    return cluster_tickets(ws, tickets, tx.combined_text(), t, vectors, width, guard=False)


def board_clusters(ws: Workspace, tickets: DataFrame, t: float = TEXT_THRESHOLD, vectors: DataFrame | None = None,
                   width: int | None = vx.MAX_FEATURES) -> DataFrame:
    """Clusters of the board run: normalised text (white space parts words however long it is), no guard against equal vectors."""
    return cluster_tickets(ws, tickets, tx.without_addresses(tx.combined_text()), t, vectors, width, guard=False)


def daily_clusters(ws: Workspace, tickets: DataFrame, t: float = TEXT_THRESHOLD, vectors: DataFrame | None = None,
                   width: int | None = vx.MAX_FEATURES, strip_ticket_keys: bool = False) -> DataFrame:
    """Clusters of the daily run: normalised text (white space parts words however long it is), with the guard."""
    return cluster_tickets(ws, tickets, tx.without_addresses(tx.combined_text(), strip_ticket_keys), t, vectors, width)


def _join_all(parts: list[DataFrame], key: str | list[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "left"), parts)


def ticket_ranks(ws: Workspace, clustered: DataFrame) -> DataFrame:
    """Rank of each ticket in its cluster: (cluster_id, seq, id, rank, n); unclustered tickets drop out."""
    slim = clustered.where(F.col("cluster_id").isNotNull()).select("cluster_id", "seq", F.col("id").cast("string").alias("id"))
    return ws.save(rank_in_group(ws, slim, "cluster_id", ["seq"]), "ranks")


def id_lists(ranks: DataFrame, alias: str, size: int = ag.LIST_PART) -> DataFrame:
    """Each cluster's id list in parts of ``size`` tickets: (cluster_id, part, ids). All parts together are the whole list."""
    return ag.list_parts(ranks, "cluster_id", "id", size=size).select("cluster_id", "part", F.col("id").alias(alias))


def _ranked_texts(ranks: DataFrame, clustered: DataFrame, rows: int) -> DataFrame:
    wanted = ranks.where(F.col("rank") < rows).select("cluster_id", "seq", "rank")
    return wanted.join(clustered.select("seq", "combined"), "seq")


def cluster_context(ranks: DataFrame, clustered: DataFrame) -> DataFrame:
    """The head of each cluster's joined texts, as handed to a model."""
    texts = _ranked_texts(ranks, clustered, pr.CLUSTER_TEXT_LENGTH + 1)
    return ag.head_text(texts, "cluster_id", "combined", "context")


def told_of_all(ws: Workspace, texts: DataFrame, key: str, prompt, model: BatchFunction, alias: str, sep: str = "\n", part: int = ag.TEXT_PART) -> DataFrame:
    """What the model says of each group's whole text (key, rank, combined): one reply a group, null if it has none.

    Texts are told in parts of ``part`` in their order; the replies are texts again, told in parts in the next round, until one is left.
    A group of at most ``part`` texts is asked once; the rule is the same for any number, and rounds grow with its logarithm.
    """
    done = None
    while True:
        parts = ag.list_parts(texts, key, "combined", sep=sep, size=part)
        asked = reply_column(parts, prompt(F.col("combined")), model, "told")
        said = ws.save(asked.select(key, "part", F.nullif(tx.stripped("told"), F.lit("")).alias("combined")), "told")
        several = ws.save(said.groupBy(key).agg(F.max("part").alias("last")).where("last > 0").select(key), "several")
        single = said.join(several, key, "left_anti").select(key, F.col("combined").alias(alias))
        done = single if done is None else done.unionByName(single)
        if several.isEmpty():
            return done
        texts = said.join(several, key, "left_semi").select(key, F.col("part").alias("rank"), "combined")
        if part < 2:
            raise ValueError("a part holds at least two texts")


def notes(clustered: DataFrame) -> DataFrame:
    """Stand-in summary from the first three ticket summaries of each cluster."""
    first = first_rows(
        clustered.where(F.col("cluster_id").isNotNull()).select("cluster_id", "seq", "summary"),
        ["cluster_id"], [F.asc("seq")], 3,
    )
    ordered = F.array_sort(F.collect_list(F.struct("seq", F.coalesce("summary", F.lit("")).alias("s"))))
    sample = F.array_join(F.transform(ordered, lambda e: e["s"]), " ")
    return first.groupBy("cluster_id").agg(pr.note_fallback(sample).alias("note"))


def _summaries(ws: Workspace, clustered: DataFrame, ranks: DataFrame, model: BatchFunction | None, whole: bool = False) -> DataFrame:
    """cluster_id, recurring_summary and the model's crux reply. The model sees the head of the texts, or all with ``whole``."""
    base = notes(clustered)
    if model is None:
        return base.select("cluster_id", F.col("note").alias("recurring_summary"), F.lit(None).cast("string").alias("reply"))
    if whole:
        texts = ranks.select("cluster_id", "seq", "rank").join(clustered.select("seq", "combined"), "seq")
        told = base.join(told_of_all(ws, texts, "cluster_id", pr.summary_prompt, model, "told"), "cluster_id", "left")
    else:
        asked = base.join(cluster_context(ranks, clustered), "cluster_id")
        told = reply_column(asked, pr.summary_prompt(F.col("context")), model, "told")
    told = ws.save(
        told.select("cluster_id", F.coalesce(F.nullif(tx.stripped("told"), F.lit("")), F.col("note")).alias("recurring_summary")),
        "summaries",
    )
    return reply_column(told, pr.crux_prompt(F.col("recurring_summary")), model, "reply")


def daily_report(ws: Workspace, clustered: DataFrame, model: BatchFunction | None = None, list_part: int = ag.LIST_PART) -> DataFrame:
    """One row per cluster: summary, crux, labels, size, ids, status, earliest completion date.

    A cluster of more than ``list_part`` tickets has a row for each ``part`` of its id list, so the ids are complete.
    """
    tickets = clustered.where(F.col("cluster_id").isNotNull())
    ranks = ticket_ranks(ws, clustered)
    base = tickets.groupBy("cluster_id").agg(
        F.count("*").alias("total_tickets"), ag.earliest_day("completion_date").alias("create_date")
    )
    labels = ag.most_frequent(tickets, ["cluster_id"], ["feature", "error_type", "status"])
    phrase = kp.phrase_crux(tickets, "cluster_id", "combined", "phrase")
    summaries = _summaries(ws, clustered, ranks, model)
    joined = _join_all([base, labels, id_lists(ranks, "example_ids", list_part), summaries, phrase], "cluster_id")
    said = F.nullif(tx.crux_of("reply"), F.lit(tx.NO_CRUX))
    return joined.select(
        "cluster_id", "recurring_summary", F.coalesce(said, "phrase", F.lit(tx.NO_CRUX_TITLE)).alias("crux"),
        "feature", "error_type", "total_tickets", "example_ids", "status", "create_date", "part",
    )


def board_report(ws: Workspace, clustered: DataFrame, model: BatchFunction | None = None, list_part: int = ag.LIST_PART) -> DataFrame:
    """The daily report without a date; the model sees all texts of a cluster, and a crux is what it says, unchanged."""
    tickets = clustered.where(F.col("cluster_id").isNotNull())
    ranks = ticket_ranks(ws, clustered)
    base = tickets.groupBy("cluster_id").agg(F.count("*").alias("total_tickets"))
    labels = ag.most_frequent(tickets, ["cluster_id"], ["feature", "error_type", "status"])
    summaries = _summaries(ws, clustered, ranks, model, whole=True)
    joined = _join_all([base, labels, id_lists(ranks, "example_ids", list_part), summaries], "cluster_id")
    return joined.select(
        "cluster_id", "recurring_summary", F.coalesce(tx.stripped("reply"), F.lit(tx.NO_CRUX_TITLE)).alias("crux"),
        "feature", "error_type", "total_tickets", "example_ids", "status", "part",
    )


def pattern_report(ws: Workspace, clustered: DataFrame, model: BatchFunction | None = None, list_part: int = ag.LIST_PART) -> DataFrame:
    """The 13-column pattern table: texts, counts, ticket list, labels, first and last seen, severity; and ``part`` as in the daily report."""
    tickets = clustered.where(F.col("cluster_id").isNotNull())
    ranks = ticket_ranks(ws, clustered)
    first, last = ag.seen_between("created", "updated")
    base = tickets.groupBy("cluster_id").agg(F.count("*").alias("ticket_count"), first.alias("first"), last.alias("last"))
    features = ag.distinct_sorted(tickets, ["cluster_id"], "feature").withColumnRenamed("feature", "features_impacted")
    errors = ag.distinct_sorted(tickets, ["cluster_id"], "error_type").withColumnRenamed("error_type", "error_types")
    opening = _ranked_texts(ranks, clustered, 1).select("cluster_id", F.col("combined").alias("opening"))
    parts = [base, features, errors, opening]
    if model is not None:
        parts.append(cluster_context(ranks, clustered))
    joined = _join_all(parts, "cluster_id")
    prompt = pr.pattern_prompt(F.col("context")) if model is not None else F.lit("")
    replied = reply_column(joined, prompt, model, "reply").join(id_lists(ranks, "tickets", list_part), "cluster_id", "left")

    def told(name: str, fallback: Column) -> Column:
        return F.coalesce(tx.pattern_field("reply", name), fallback).alias(name)

    count = F.col("ticket_count")
    return replied.select(
        "cluster_id",
        told("pattern_summary", pr.pattern_fallback(F.col("opening"))),
        told("detailed_summary", F.lit(pr.DETAILED_FALLBACK)),
        told("root_cause", F.lit(pr.CAUSE_FALLBACK)),
        told("recommendation", F.lit(pr.ADVICE_FALLBACK)),
        "ticket_count",
        "tickets",
        F.coalesce("features_impacted", F.lit("")).alias("features_impacted"),
        F.coalesce("error_types", F.lit("")).alias("error_types"),
        F.coalesce(F.date_format("first", "yyyy-MM-dd"), F.lit("")).alias("first_seen"),
        F.coalesce(F.date_format("last", "yyyy-MM-dd"), F.lit("")).alias("last_seen"),
        ag.frequency_label(ag.spread_days(F.col("first"), F.col("last")), count).alias("frequency"),
        ag.severity(count).alias("severity"),
        "part",
    )


def short_patterns(ws: Workspace, clustered: DataFrame, model: BatchFunction | None = None) -> DataFrame:
    """cluster_id, summary, count; unclustered tickets are a group too, groups without any text are skipped.

    The model sees all texts of a group, joined by empty lines.
    """
    counted = clustered.groupBy("cluster_id").agg(F.count("*").alias("count"), F.count("combined").alias("texts"))
    counted = counted.where(F.col("texts") > 0).drop("texts")
    opening = first_rows(
        clustered.where(F.col("combined").isNotNull()).select("cluster_id", "seq", "combined"),
        ["cluster_id"], [F.asc("seq")], 1,
    ).select(F.col("cluster_id").alias("c"), F.substring("combined", 1, pr.CLUSTER_TEXT_LENGTH).alias("opening"))
    joined = counted.join(opening, F.col("cluster_id").eqNullSafe(F.col("c")), "left").drop("c")
    if model is not None:
        texts = clustered.where(F.col("combined").isNotNull())
        texts = texts.select(F.coalesce("cluster_id", F.lit(-1)).cast("long").alias("k"), "seq", "combined")
        ranked = ws.save(rank_in_group(ws, texts, "k", ["seq"]), "ranked")
        told = told_of_all(ws, ranked, "k", pr.summary_prompt, model, "reply", sep="\n\n")
        joined = joined.join(told, F.coalesce("cluster_id", F.lit(-1)) == F.col("k"), "left").drop("k")
    else:
        joined = joined.withColumn("reply", F.lit(None).cast("string"))
    said = F.nullif(tx.stripped("reply"), F.lit(""))
    return joined.select(
        "cluster_id", F.coalesce(said, pr.pattern_fallback(F.col("opening"))).alias("summary"), "count"
    )


def ticket_list_parts(ws: Workspace, clustered: DataFrame) -> DataFrame:
    """Each cluster's whole id list, in parts of LIST_PART ids."""
    return ag.list_parts(ticket_ranks(ws, clustered), "cluster_id", "id").withColumnRenamed("id", "ids")


def text_parts(ws: Workspace, clustered: DataFrame, sep: str = "\n") -> DataFrame:
    """Each cluster's whole joined text, in parts of TEXT_PART tickets."""
    ranks = ticket_ranks(ws, clustered).select("cluster_id", "seq", "rank")
    texts = ranks.join(clustered.select("seq", "combined"), "seq")
    return ag.list_parts(texts, "cluster_id", "combined", sep=sep, size=ag.TEXT_PART)
