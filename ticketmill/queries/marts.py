"""Queries on the dashboard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketmill.functions import dates as dt
from ticketmill.operators import aggregates as ag
from ticketmill.plans import firsts as fi
from ticketmill.plans import marts as ma
from ticketmill.plans import runs
from ticketmill.queries.tables import query
from ticketmill.queries.views import SNAPSHOT, day, month_text, snapshot
from ticketmill.session import Workspace

ERROR_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _months_as_text(df):
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "date"]
    return df.withColumns({n: month_text(n) for n in names})


def _first_seen(field: str, name: str) -> str:
    return f"""{name} AS (SELECT month_start, {field} FROM (SELECT month_start, {field},
    row_number() OVER (PARTITION BY month_start ORDER BY count(*) DESC, min(cluster_id)) AS rn FROM snapshot GROUP BY month_start, {field}) WHERE rn = 1)"""


@query("report_summary", f"""WITH {SNAPSHOT}, {_first_seen('feature', 'tf')}, {_first_seen('root_cause', 'tc')}
SELECT {day('s.month_start')} AS month_start, strftime(s.month_start, '%b-%Y') AS month, count(*) AS total_clusters,
  CAST(sum(total_tickets) AS BIGINT) AS total_tickets, any_value(tf.feature) AS top_feature, any_value(tc.root_cause) AS top_root_cause,
  round(avg(date_diff('day', CAST(completion_date AS DATE), DATE '1998-07-01')), 1) AS avg_ticket_age
FROM snapshot s JOIN tf ON tf.month_start = s.month_start JOIN tc ON tc.month_start = s.month_start GROUP BY s.month_start""")
def report_summary(spark, folder):
    return _months_as_text(ma.report_summary(snapshot(spark, folder), F.lit("1998-07-01").cast("date")))


NEW_CAUSES = """firsts AS (SELECT root_cause, min(month_start) AS month_start FROM snapshot GROUP BY root_cause),
fresh AS (SELECT month_start, count(*) AS new_root_causes FROM firsts GROUP BY month_start)"""
TOP_FEATURES = """topf AS (SELECT month_start, string_agg(feature, ', ' ORDER BY rn) AS top_features FROM (
  SELECT month_start, feature, row_number() OVER (PARTITION BY month_start ORDER BY count(*) DESC, min(cluster_id)) AS rn
  FROM snapshot GROUP BY month_start, feature) WHERE rn <= 3 GROUP BY month_start)"""
COMMON_ERROR = """commone AS (SELECT month_start, error_type AS common_error_type FROM (
  SELECT month_start, error_type, row_number() OVER (PARTITION BY month_start ORDER BY count(*) DESC, error_type) AS rn
  FROM snapshot GROUP BY month_start, error_type) WHERE rn = 1)"""


@query("month_health", f"""WITH {SNAPSHOT}, {NEW_CAUSES}, {TOP_FEATURES}, {COMMON_ERROR},
b AS (SELECT month_start, count(DISTINCT cluster_id) AS total_clusters, CAST(sum(total_tickets) AS BIGINT) AS total_tickets,
  count(*) FILTER (total_tickets > 1) AS recurring_clusters FROM snapshot GROUP BY month_start)
SELECT {day('b.month_start')} AS month_start, total_clusters, total_tickets, recurring_clusters, top_features, common_error_type,
  coalesce(new_root_causes, 0) AS new_root_causes, round(recurring_clusters / total_clusters, 6) AS recurring_share,
  coalesce(CAST(total_tickets - lag(total_tickets) OVER (ORDER BY b.month_start) AS VARCHAR), '') AS ticket_change
FROM b JOIN topf USING (month_start) JOIN commone USING (month_start) LEFT JOIN fresh USING (month_start)""")
def month_health(spark, folder):
    health = ma.month_health(snapshot(spark, folder))
    return _months_as_text(health).withColumn("ticket_change", F.coalesce(F.col("ticket_change").cast("string"), F.lit("")))


@query("new_root_causes", f"""WITH {SNAPSHOT}, {NEW_CAUSES}, m AS (SELECT DISTINCT month_start FROM snapshot)
SELECT {day('m.month_start')} AS month_start, coalesce(new_root_causes, 0) AS new_root_causes FROM m LEFT JOIN fresh USING (month_start)""")
def new_root_causes(spark, folder):
    return _months_as_text(ma.new_root_causes(snapshot(spark, folder)))


@query("causes_not_in_previous_month", f"""WITH {SNAPSHOT}, c AS (SELECT DISTINCT month_start, root_cause FROM snapshot)
SELECT {day('c.month_start')} AS month_start, count(*) FILTER (NOT EXISTS (SELECT 1 FROM c p WHERE p.root_cause = c.root_cause
  AND p.month_start = c.month_start - INTERVAL 1 MONTH)) AS new_root_causes FROM c GROUP BY c.month_start""")
def causes_not_in_previous_month(spark, folder):
    return _months_as_text(ma.causes_not_in_previous_month(snapshot(spark, folder)))


@query("seen_before", f"""WITH {SNAPSHOT}, f AS (SELECT root_cause, min(month_start) AS first_month FROM snapshot GROUP BY root_cause)
SELECT pos, first_month < month_start AS seen_before FROM snapshot JOIN f USING (root_cause)""")
def seen_before(spark, folder):
    return ma.seen_before(snapshot(spark, folder)).select("pos", "seen_before")


@query("root_cause_by_feature", f"WITH {SNAPSHOT} SELECT feature, arg_min(root_cause, pos) AS root_cause FROM snapshot GROUP BY feature")
def root_cause_by_feature(spark, folder):
    return ma.root_cause_of(snapshot(spark, folder), "feature", "pos")


@query("root_cause_by_error_type", f"WITH {SNAPSHOT} SELECT error_type, arg_min(root_cause, pos) AS root_cause FROM snapshot GROUP BY error_type")
def root_cause_by_error_type(spark, folder):
    return ma.root_cause_of(snapshot(spark, folder), "error_type", "pos")


@query("feature_insights", f"""WITH {SNAPSHOT}, g AS (SELECT feature, count(*) AS clusters, CAST(sum(total_tickets) AS BIGINT) AS tickets,
  count(*) FILTER (total_tickets > 1) AS recurring_clusters, arg_min(root_cause, pos) AS common_root_cause FROM snapshot GROUP BY feature)
SELECT *, round(recurring_clusters / clusters, 6) AS recurrence,
  CASE WHEN recurring_clusters / clusters > 0.4 THEN 'Poor' WHEN recurring_clusters / clusters > 0.2 THEN 'Moderate' ELSE 'Stable' END AS stability_rating FROM g""")
def feature_insights(spark, folder):
    return ma.feature_insights(snapshot(spark, folder), "pos")


@query("error_mix", f"""WITH {SNAPSHOT} SELECT feature, error_type, count(*) AS clusters,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY feature) AS DOUBLE), 6) AS share FROM snapshot GROUP BY feature, error_type""")
def error_mix(spark, folder):
    return ma.error_mix(snapshot(spark, folder))


@query("error_mix_wide", f"""WITH {SNAPSHOT} SELECT feature, """ + ", ".join(
    f"count(*) FILTER (error_type = '{e}') AS \"{e}\"" for e in ERROR_TYPES) + " FROM snapshot GROUP BY feature")
def error_mix_wide(spark, folder):
    return ma.error_mix_wide(snapshot(spark, folder), ERROR_TYPES)


@query("error_insights", f"""WITH {SNAPSHOT}, topf AS (SELECT error_type, string_agg(feature, ', ' ORDER BY rn) AS top_features FROM (
  SELECT error_type, feature, row_number() OVER (PARTITION BY error_type ORDER BY count(*) DESC, min(pos)) AS rn
  FROM snapshot GROUP BY error_type, feature) WHERE rn <= 3 GROUP BY error_type),
g AS (SELECT error_type, count(*) AS clusters, arg_min(root_cause, pos) AS example_root_cause FROM snapshot GROUP BY error_type)
SELECT error_type, clusters, example_root_cause, round(clusters / (SELECT CAST(count(*) AS DOUBLE) FROM snapshot), 6) AS share, top_features
FROM g JOIN topf USING (error_type)""")
def error_insights(spark, folder):
    return ma.error_insights(snapshot(spark, folder), "pos")


TRACKER = """tracker AS (SELECT cluster_id, arg_min(feature, month_start) AS feature, arg_min(root_cause, month_start) AS recurring_summary,
  CAST(sum(total_tickets) AS BIGINT) AS ticket_count, min(month_start) AS first_seen, max(month_start) AS last_seen,
  count(DISTINCT month_start) AS frequency FROM snapshot GROUP BY cluster_id)"""


@query("recurrence_tracker", f"""WITH {SNAPSHOT}, {TRACKER} SELECT cluster_id, feature, recurring_summary, ticket_count,
  {day('first_seen')} AS first_seen, {day('last_seen')} AS last_seen, frequency,
  CASE WHEN frequency > 2 THEN 'Chronic' WHEN frequency = 2 THEN 'Reappeared' ELSE 'Fixed' END AS status FROM tracker""")
def recurrence_tracker(spark, folder):
    return _months_as_text(ma.recurrence_tracker(snapshot(spark, folder)))


@query("features_by_frequency", f"WITH {SNAPSHOT}, {TRACKER} SELECT feature, frequency, count(*) AS clusters FROM tracker GROUP BY feature, frequency")
def features_by_frequency(spark, folder):
    return ma.features_by_frequency(snapshot(spark, folder))


@query("month_trend", f"""WITH {SNAPSHOT}, t AS (SELECT month_start, CAST(sum(total_tickets) AS BIGINT) AS tickets, count(*) AS clusters FROM snapshot GROUP BY month_start)
SELECT {day('month_start')} AS month_start, tickets, clusters,
  coalesce(CAST(tickets - lag(tickets) OVER (ORDER BY month_start) AS VARCHAR), '') AS change FROM t""")
def month_trend(spark, folder):
    trend = ma.month_trend(snapshot(spark, folder))
    return _months_as_text(trend).withColumn("change", F.coalesce(F.col("change").cast("string"), F.lit("")))


@query("error_types_by_month", f"""WITH {SNAPSHOT} SELECT error_type, {day('month_start')} AS month_start, count(*) AS clusters,
  CAST(sum(total_tickets) AS BIGINT) AS tickets FROM snapshot GROUP BY error_type, month_start""")
def error_types_by_month(spark, folder):
    return _months_as_text(ma.error_types_by_month(snapshot(spark, folder)))


@query("monthly_snapshot", f"""WITH {SNAPSHOT} SELECT cluster_id, feature, error_type, root_cause, total_tickets,
  {day('completion_date')} AS completion_day, strftime(month_start, '%b-%Y') AS cluster_month FROM snapshot""")
def monthly_snapshot(spark, folder):
    return snapshot(spark, folder).select(
        "cluster_id", "feature", "error_type", "root_cause", "total_tickets",
        dt.day_text("completion_date").alias("completion_day"), dt.month_tag("month_start").alias("cluster_month"),
    )


@query("top_features_by_month", f"WITH {SNAPSHOT}, {TOP_FEATURES} SELECT {day('month_start')} AS month_start, top_features FROM topf")
def top_features_by_month(spark, folder):
    return _months_as_text(ma.top_values(snapshot(spark, folder), ["month_start"], "feature", "cluster_id", "top_features"))


@query("common_error_type_by_month", f"WITH {SNAPSHOT}, {COMMON_ERROR} SELECT {day('month_start')} AS month_start, common_error_type FROM commone")
def common_error_type_by_month(spark, folder):
    return _months_as_text(ma.common_error_type(snapshot(spark, folder)))


def _last_years(ws, rows):
    """The months in three runs one after the other: up to 1995, 1996, from 1997 on."""
    year = F.year("month_start")
    return [ws.save(rows.where(part), "months") for part in (year <= 1995, year == 1996, year >= 1997)]


@query("first_months_by_run", f"""WITH {SNAPSHOT}, f AS (SELECT root_cause, min(month_start) AS first_month FROM snapshot GROUP BY root_cause)
SELECT {day('s.month_start')} AS month_start, count(DISTINCT s.root_cause) FILTER (first_month = s.month_start) AS new_values,
  count(*) FILTER (first_month < s.month_start) AS seen_rows FROM snapshot s JOIN f USING (root_cause) GROUP BY s.month_start""")
def first_months_by_run(spark, folder):
    """New causes and rows of known causes, told by three runs that each read their own months and the stored first months."""
    ws = Workspace(spark)
    path = ws.path("first_causes")
    told = []
    for rows in _last_years(ws, snapshot(spark, folder)):
        firsts = fi.update_first_months(ws, rows, path, "root_cause")
        flags = fi.flag_seen(rows, firsts, "root_cause").groupBy("month_start").agg(F.count_if("seen_before").alias("seen_rows"))
        told.append(ws.save(fi.fresh_values(firsts, rows).join(flags, "month_start"), "told"))
    return _months_as_text(told[0].unionByName(told[1]).unionByName(told[2]))


@query("error_mix_map", f"""WITH {SNAPSHOT}, n AS (SELECT feature, error_type, count(*) AS n FROM snapshot GROUP BY feature, error_type)
SELECT feature, CAST(sum(n) AS BIGINT) AS clusters, string_agg(error_type, '|' ORDER BY error_type) AS error_types,
  string_agg(n::VARCHAR, '|' ORDER BY error_type) AS counts FROM n GROUP BY feature""")
def error_mix_map(spark, folder):
    mix = ma.error_mix_map(snapshot(spark, folder))
    return mix.withColumns({"error_types": F.array_join("error_types", "|"), "counts": F.array_join(F.col("counts").cast("array<string>"), "|")})


CAUSES_PART = 25


@query("cause_parts", f"""WITH {SNAPSHOT}, d AS (SELECT DISTINCT feature, root_cause FROM snapshot),
r AS (SELECT *, (row_number() OVER (PARTITION BY feature ORDER BY root_cause) - 1) // {CAUSES_PART} AS part FROM d)
SELECT feature, part, string_agg(root_cause, ', ' ORDER BY root_cause) AS root_cause FROM r GROUP BY feature, part""")
def cause_parts(spark, folder):
    """All distinct causes of each feature, in parts of bounded size."""
    return ag.distinct_parts(Workspace(spark), snapshot(spark, folder), "feature", "root_cause", size=CAUSES_PART)


@query("stored_dashboards", f"""WITH {SNAPSHOT}, {NEW_CAUSES}, {TRACKER}
SELECT 'month_health' AS dashboard, count(DISTINCT month_start) AS rows, CAST(sum(total_tickets) AS BIGINT) AS tickets, (SELECT CAST(sum(new_root_causes) AS BIGINT) FROM fresh) AS extra FROM snapshot
UNION ALL SELECT 'month_trend', count(DISTINCT month_start), CAST(sum(total_tickets) AS BIGINT), count(*) FROM snapshot
UNION ALL SELECT 'error_types_by_month', count(DISTINCT (error_type, month_start)), CAST(sum(total_tickets) AS BIGINT), count(*) FROM snapshot
UNION ALL SELECT 'feature_insights', count(DISTINCT feature), CAST(sum(total_tickets) AS BIGINT), count(*) FROM snapshot
UNION ALL SELECT 'recurrence_tracker', count(*), CAST(sum(ticket_count) AS BIGINT), CAST(sum(frequency) AS BIGINT) FROM tracker""")
def stored_dashboards(spark, folder):
    """The dashboards of two runs over stored months, the second with the months from 1997 on only compared with stored first months."""
    ws = Workspace(spark)
    rows = ws.save(snapshot(spark, folder), "months")
    out = ws.path("dashboards")
    start = F.lit("1997-01-01").cast("date")
    runs.run_dashboards(ws, rows.where(F.col("month_start") < start), out)
    tables = runs.run_dashboards(ws, rows, out, start)
    sums = {
        "month_health": ("total_tickets", "new_root_causes"),
        "month_trend": ("tickets", "clusters"),
        "error_types_by_month": ("tickets", "clusters"),
        "feature_insights": ("tickets", "clusters"),
        "recurrence_tracker": ("ticket_count", "frequency"),
    }
    told = [
        tables[name].agg(F.lit(name).alias("dashboard"), F.count("*").alias("rows"), F.sum(tickets).alias("tickets"), F.sum(extra).alias("extra"))
        for name, (tickets, extra) in sums.items()
    ]
    whole = told[0]
    for part in told[1:]:
        whole = whole.unionByName(part)
    return whole
