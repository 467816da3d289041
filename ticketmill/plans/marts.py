"""Dashboard tables over monthly cluster snapshots.

A snapshot has one row per month and cluster: month_start (date), cluster_id, feature, error_type, root_cause,
total_tickets, completion_date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions import dates as dt
from ticketmill.functions import text as tx
from ticketmill.operators import aggregates as ag
from ticketmill.operators import lookups as lu
from ticketmill.operators.ranking import first_rows

TOP = 3


def report_summary(snapshot: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per month: rows, tickets, top feature and root cause (ties: first seen), mean age in days."""
    key = ["month_start"]
    base = snapshot.groupBy(*key).agg(
        F.count("*").alias("total_clusters"),
        F.coalesce(F.sum("total_tickets"), F.lit(0)).alias("total_tickets"),
        *(
            [F.round(F.avg(F.datediff(as_of, "completion_date")), 1).alias("avg_ticket_age")]
            if as_of is not None
            else [F.lit(None).cast("double").alias("avg_ticket_age")]
        ),
    )
    feature = ag.first_seen_mode(snapshot, key, "feature", "cluster_id").withColumnRenamed("feature", "top_feature")
    cause = ag.first_seen_mode(snapshot, key, "root_cause", "cluster_id").withColumnRenamed("root_cause", "top_root_cause")
    return (
        base.join(feature, key, "left").join(cause, key, "left")
        .select("month_start", dt.month_tag("month_start").alias("month"), "total_clusters", "total_tickets", "top_feature", "top_root_cause", "avg_ticket_age")
    )


def top_values(df: DataFrame, group: list[str], field: str, order: str, alias: str, k: int = TOP) -> DataFrame:
    """The k most frequent values per group, joined; ties go to the value seen first."""
    counted = df.groupBy(*group, field).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    top = first_rows(counted, group, [F.desc("n"), F.asc("first")], k)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "first", F.col(field).alias("v"))))
    return top.groupBy(*group).agg(F.array_join(F.transform(ordered, lambda e: e["v"]), ", ").alias(alias))


def common_error_type(snapshot: DataFrame) -> DataFrame:
    """Most common error type per month, after comma lists are split."""
    split = snapshot.select("month_start", F.explode_outer(F.split("error_type", ",")).alias("e"))
    trimmed = split.select("month_start", F.nullif(tx.stripped("e"), F.lit("")).alias("common_error_type"))
    return ag.most_frequent(trimmed, ["month_start"], ["common_error_type"])


def new_root_causes(snapshot: DataFrame) -> DataFrame:
    """Causes per month that no earlier month has; months without any appear with 0."""
    first = snapshot.groupBy("root_cause").agg(F.min("month_start").alias("month_start"))
    fresh = first.groupBy("month_start").agg(F.count("root_cause").alias("new_root_causes"))
    months = snapshot.select("month_start").distinct()
    return months.join(fresh, "month_start", "left").select(
        "month_start", F.coalesce("new_root_causes", F.lit(0)).alias("new_root_causes")
    )


def causes_not_in_previous_month(snapshot: DataFrame) -> DataFrame:
    """Causes per month that the month before does not have (an anti join); months without any appear with 0."""
    causes = snapshot.select("month_start", "root_cause").distinct()
    before = causes.select(F.add_months("month_start", 1).alias("month_start"), "root_cause")
    fresh = causes.join(before, ["month_start", "root_cause"], "left_anti").groupBy("month_start").agg(F.count("root_cause").alias("n"))
    months = snapshot.select("month_start").distinct()
    return months.join(fresh, "month_start", "left").select("month_start", F.coalesce("n", F.lit(0)).alias("new_root_causes"))


def seen_before(snapshot: DataFrame) -> DataFrame:
    """Each snapshot row with a flag: was its cause in an earlier month? A missing cause was not."""
    first = snapshot.groupBy("root_cause").agg(F.min("month_start").alias("first_month"))
    before = F.coalesce(F.col("first_month") < F.col("month_start"), F.lit(False))
    return snapshot.join(first, "root_cause", "left").withColumn("seen_before", before).drop("first_month")


def month_health(snapshot: DataFrame) -> DataFrame:
    """The summary dashboard: size, recurring share, top features, common error type, new causes, trend."""
    base = snapshot.groupBy("month_start").agg(
        F.countDistinct("cluster_id").alias("total_clusters"),
        F.sum("total_tickets").alias("total_tickets"),
        F.count_if(F.col("total_tickets") > 1).alias("recurring_clusters"),
    )
    top = top_values(snapshot, ["month_start"], "feature", "cluster_id", "top_features")
    joined = base.join(top, "month_start", "left").join(common_error_type(snapshot), "month_start", "left").join(new_root_causes(snapshot), "month_start", "left")
    share = F.round(F.coalesce(F.try_divide(F.col("recurring_clusters"), F.col("total_clusters")), F.lit(0.0)), 6)
    by_month = Window.orderBy("month_start")  # one row per month
    return joined.withColumn("recurring_share", share).withColumn(
        "ticket_change", F.col("total_tickets") - F.lag("total_tickets").over(by_month)
    )


def stability(share: Column) -> Column:
    return F.when(share > 0.4, "Poor").when(share > 0.2, "Moderate").otherwise("Stable")


def feature_insights(snapshot: DataFrame, order: Column | str) -> DataFrame:
    """Per feature: clusters, tickets, recurring clusters, recurrence, rating, first root cause."""
    base = snapshot.groupBy("feature").agg(
        F.count("*").alias("clusters"),
        F.sum("total_tickets").alias("tickets"),
        F.count_if(F.col("total_tickets") > 1).alias("recurring_clusters"),
        F.min_by("root_cause", order).alias("common_root_cause"),
    )
    share = F.coalesce(F.try_divide(F.col("recurring_clusters"), F.col("clusters")), F.lit(0.0))
    return base.withColumn("recurrence", F.round(share, 6)).withColumn("stability_rating", stability(share))


def error_mix(snapshot: DataFrame) -> DataFrame:
    """Share of each error type inside each feature, one row per pair."""
    pairs = snapshot.groupBy("feature", "error_type").agg(F.count("*").alias("clusters"))
    totals = pairs.groupBy("feature").agg(F.sum("clusters").alias("total"))
    return pairs.join(totals, "feature").select(
        "feature", "error_type", "clusters", F.round(F.col("clusters") / F.col("total"), 6).alias("share")
    )


def error_mix_wide(snapshot: DataFrame, error_types: list[str]) -> DataFrame:
    """Feature by error type, counts in one column per given type."""
    wide = snapshot.groupBy("feature").pivot("error_type", error_types).count()
    return wide.fillna(0)


def error_mix_map(snapshot: DataFrame) -> DataFrame:
    """Feature by error type without a list of types: (feature, clusters, error_types, counts), both arrays in order of the types.

    Whatever types there are appear; a missing type is the empty text. Counts are summed before they meet, so a row is as
    long as the feature has types.
    """
    pairs = snapshot.groupBy("feature", F.coalesce("error_type", F.lit("")).alias("error_type")).agg(F.count("*").alias("n"))
    mix = pairs.groupBy("feature").agg(F.sum("n").alias("clusters"), F.array_sort(F.collect_list(F.struct("error_type", "n"))).alias("mix"))
    return mix.select(
        "feature", "clusters", F.transform("mix", lambda e: e["error_type"]).alias("error_types"), F.transform("mix", lambda e: e["n"]).alias("counts")
    )


def error_insights(snapshot: DataFrame, order: Column | str, position: str = "pos") -> DataFrame:
    """Per error type: clusters, share of all, top features, first root cause."""
    base = snapshot.groupBy("error_type").agg(
        F.count("*").alias("clusters"), F.min_by("root_cause", order).alias("example_root_cause")
    )
    top = top_values(snapshot, ["error_type"], "feature", position, "top_features")
    top = top.withColumnRenamed("error_type", "_type")
    shared = ag.count_share(base, "error_type", "clusters")
    return shared.join(top, F.col("error_type").eqNullSafe(F.col("_type")), "left").drop("_type")


def recurrence_tracker(snapshot: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Per cluster over all months: first and last month, months seen, tickets, status."""
    tracked = snapshot.groupBy(key).agg(
        F.min_by("feature", "month_start").alias("feature"),
        F.min_by("root_cause", "month_start").alias("recurring_summary"),
        F.sum("total_tickets").alias("ticket_count"),
        F.min("month_start").alias("first_seen"),
        F.max("month_start").alias("last_seen"),
        F.countDistinct("month_start").alias("frequency"),
    )
    status = F.when(F.col("frequency") > 2, "Chronic").when(F.col("frequency") == 2, "Reappeared").otherwise("Fixed")
    return tracked.withColumn("status", status)


def month_trend(snapshot: DataFrame) -> DataFrame:
    """Tickets and clusters per month, with the change to the month before."""
    base = snapshot.groupBy("month_start").agg(F.sum("total_tickets").alias("tickets"), F.count("*").alias("clusters"))
    by_month = Window.orderBy("month_start")  # one row per month
    return base.withColumn("change", F.col("tickets") - F.lag("tickets").over(by_month))


def error_types_by_month(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("error_type", "month_start").agg(F.count("*").alias("clusters"), F.sum("total_tickets").alias("tickets"))


def features_by_frequency(snapshot: DataFrame) -> DataFrame:
    """How many clusters of each feature were seen in how many months."""
    return recurrence_tracker(snapshot).groupBy("feature", "frequency").agg(F.count("*").alias("clusters"))


def root_cause_of(snapshot: DataFrame, key: str, order: Column | str) -> DataFrame:
    """The first root cause listed for each feature or error type."""
    return lu.first_match(snapshot, key, "root_cause", order)
