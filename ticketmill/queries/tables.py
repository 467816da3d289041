"""Queries on sources, sinks, projections, filters, lookups, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketmill.functions import dates as dt
from ticketmill.functions import text as tx
from ticketmill.operators import lookups as lu
from ticketmill.operators.ranking import first_rows, with_position
from ticketmill.plans import monthly as mo
from ticketmill.queries.views import ISSUES, SNAPSHOT, day, issues, month_text, snapshot, table
from ticketmill.session import Workspace
from ticketmill.sources import issues as src
from ticketmill.sources import sinks

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
AS_OF = "2024-02-01"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


@query("csv_scan", f"""WITH {ISSUES} SELECT id, summary, description, feature, error_type,
  strftime(created, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS created,
  strftime(updated, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS updated FROM issues""")
def csv_scan(spark, folder):
    path = Workspace(spark).path("issues-csv")
    sinks.write_csv(issues(spark, folder).select(*src.ISSUE_COLUMNS), path)
    back = src.require_columns(src.read_csv(spark, path), "summary", "description")
    return back.fillna("")


def landed_pages(spark, folder, path):
    """Result pages of 50 issues, written as one JSON object per line; field shapes vary by ticket."""
    raw = issues(spark, folder)
    shape = F.col("seq") % 5
    feature = (
        F.when(shape == 0, F.concat(F.lit('{"value":"'), "feature", F.lit('"}')))
        .when(shape == 1, F.concat(F.lit('[{"value":"'), "feature", F.lit('"},{"name":"'), "error_type", F.lit('"}]')))
        .when(shape == 2, F.concat(F.lit('"'), "feature", F.lit('"')))
        .when(shape == 3, F.lit("null"))
    )
    quoted = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    body = F.concat(
        F.lit('{"key":"'), "id", F.lit('","fields":{"summary":'), quoted("summary"),
        F.lit(',"description":{"type":"doc","content":[{"type":"paragraph","content":[{"type":"text","text":'),
        quoted("description"), F.lit("}]}]}"),
        F.when(feature.isNull(), F.lit("")).otherwise(F.concat(F.lit(f',"{src.FEATURE_FIELD}":'), feature)),
        F.lit(f',"{src.ERROR_FIELD}":{{"name":"'), "error_type", F.lit('"},"status":{"name":"'), "status",
        F.lit('"},"priority":null,"created":"'), "created", F.lit('","updated":"'), "updated",
        F.lit('","customfield_1":"'), "completion_date", F.lit('"}}'),
    )
    pages = raw.select(F.floor(F.col("seq") / 50).alias("page"), "seq", body.alias("body")).groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("seq", "body"))).alias("items")
    )
    line = F.concat(F.lit('{"issues":['), F.array_join(F.transform("items", lambda i: i["body"]), ","), F.lit("]}"))
    pages.select(line.alias("value")).write.text(path)


@query("issue_pages", f"""WITH {ISSUES} SELECT id, summary,
  CASE WHEN description = '' THEN '{{''type'': ''doc'', ''content'': [{{''type'': ''paragraph'', ''content'': [{{''type'': ''text'', ''text'': ''''}}]}}]}}'
    ELSE description END AS description,
  CASE seq % 5 WHEN 1 THEN feature || ', ' || error_type WHEN 0 THEN feature WHEN 2 THEN feature ELSE 'Unknown' END AS feature,
  error_type, status, 'Unknown' AS priority,
  strftime(created, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS created,
  strftime(updated, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS updated,
  strftime(coalesce(completion_date, updated), '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS completion_date FROM issues""")
def issue_pages(spark, folder):
    path = Workspace(spark).path("pages")
    landed_pages(spark, folder, path)
    return src.with_option_text(src.flatten_issues(src.read_pages(spark, path), "customfield_1"))


@query("first_source_with_rows", f"WITH {ISSUES} SELECT seq, id, 'board' AS origin FROM issues WHERE status = 'Open'")
def first_source_with_rows(spark, folder):
    tickets = issues(spark, folder).select("seq", "id", "status")
    search = tickets.where(F.col("status") == "Closed").select("seq", "id", F.lit("search").alias("origin"))
    board = tickets.where(F.col("status") == "Open").select("seq", "id", F.lit("board").alias("origin"))
    every = tickets.select("seq", "id", F.lit("all").alias("origin"))
    return src.first_non_empty([search, board, every])


@query("month_tables", f"""WITH {SNAPSHOT}, tagged AS (
  SELECT CASE month(month_start) WHEN 3 THEN 'Summary' WHEN 5 THEN 'Config' ELSE strftime(month_start, '%b-%Y') END AS month,
    cluster_id, total_tickets FROM snapshot)
SELECT month, cluster_id, total_tickets FROM tagged WHERE month NOT IN ('Summary', 'Config', 'Sheet1')""")
def month_tables(spark, folder):
    month = F.month("month_start")
    tag = F.when(month == 3, "Summary").when(month == 5, "Config").otherwise(dt.month_tag("month_start"))
    tagged = snapshot(spark, folder).select(tag.alias("month"), "cluster_id", "total_tickets")
    path = Workspace(spark).path("tables")
    tagged.write.partitionBy("month").parquet(path)
    stored = spark.read.schema(tagged.schema).parquet(path)
    return src.month_tables(stored).select("month", "cluster_id", "total_tickets")


@query("replaced_table", f"""WITH {SNAPSHOT} SELECT cluster_id, CAST(sum(total_tickets) AS BIGINT) AS tickets
  FROM snapshot WHERE month(month_start) >= 4 GROUP BY cluster_id""")
def replaced_table(spark, folder):
    path = Workspace(spark).path("report")
    tickets = snapshot(spark, folder).select("month_start", "cluster_id", "total_tickets")
    report = lambda df: df.groupBy("cluster_id").agg(F.sum("total_tickets").alias("tickets"))
    sinks.replace_table(report(tickets), path)
    second = report(tickets.where(F.month("month_start") >= 4))
    sinks.replace_table(second, path)
    return spark.read.schema(second.schema).parquet(path)


@query("replaced_months", f"""WITH {SNAPSHOT} SELECT strftime(month_start, '%b-%Y') AS cluster_month, cluster_id,
  CASE WHEN month_start = DATE '1998-02-01' THEN total_tickets * 10 ELSE total_tickets END AS total_tickets
  FROM snapshot WHERE month_start <> DATE '1998-04-01'""")
def replaced_months(spark, folder):
    path = Workspace(spark).path("months")
    rows = snapshot(spark, folder).select("cluster_id", "total_tickets", dt.month_tag("month_start").alias(sinks.MONTH_COLUMN))
    sinks.replace_months(rows, path)
    february = rows.where(F.col(sinks.MONTH_COLUMN) == "Feb-1998").withColumn("total_tickets", F.col("total_tickets") * 10)
    sinks.replace_months(february, path, months=["Feb-1998", "Apr-1998"])
    return sinks.read_months(spark, path, rows.schema)


@query("created_lookback", f"WITH {ISSUES} SELECT id, {day('created')} AS created_day FROM issues WHERE created >= TIMESTAMP '{AS_OF}' - to_days(15)")
def created_lookback(spark, folder):
    found = src.created_within(issues(spark, folder).withColumn("created", dt.utc_time("created")), _as_of(), 15)
    return found.select("id", dt.day_text("created").alias("created_day"))


@query("updated_lookback", f"WITH {ISSUES} SELECT id FROM issues WHERE updated >= TIMESTAMP '{AS_OF}' - to_days(3)")
def updated_lookback(spark, folder):
    tickets = issues(spark, folder).withColumn("updated", dt.utc_time("updated"))
    return src.created_within(tickets, _as_of(), 3, "updated").select("id")


@query("event_lookback", """SELECT event_type, count(*) AS n FROM events
  WHERE ts >= TIMESTAMP '2024-01-20' - to_days(7) AND ts < TIMESTAMP '2024-01-20' GROUP BY event_type""")
def event_lookback(spark, folder):
    as_of = F.lit("2024-01-20").cast("timestamp")
    recent = table(spark, folder, "events").where(dt.within_days("ts", as_of, 7) & (F.col("ts") < as_of))
    return recent.groupBy("event_type").agg(F.count("*").alias("n"))


@query("done_tickets", f"WITH {ISSUES} SELECT id FROM issues WHERE status = 'Done'")
def done_tickets(spark, folder):
    return issues(spark, folder).where(F.col("status") == "Done").select("id")


@query("tickets_of_projects", f"WITH {ISSUES} SELECT id, feature FROM issues WHERE feature IN ('src1', 'src7')")
def tickets_of_projects(spark, folder):
    return issues(spark, folder).where(F.col("feature").isin("src1", "src7")).select("id", "feature")


@query("orders_of_month", """SELECT o_orderkey FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def orders_of_month(spark, folder):
    month = F.lit("1997-12-15").cast("timestamp")
    return table(spark, folder, "orders").where(dt.in_month("o_orderdate", month)).select("o_orderkey")


@query("month_bounds", f"""SELECT o_orderkey, {day("date_trunc('month', o_orderdate)")} AS month_start,
  {day("date_trunc('month', o_orderdate) + INTERVAL 1 MONTH")} AS month_end, strftime(o_orderdate, '%b-%Y') AS month FROM orders""")
def month_bounds(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", month_text(dt.month_start("o_orderdate")).alias("month_start"),
        month_text(dt.month_end("o_orderdate")).alias("month_end"), dt.month_tag("o_orderdate").alias("month"),
    )


@query("last_three_months", """WITH m AS (SELECT unnest([DATE '2001-07-01', DATE '2001-08-01', DATE '2001-09-01']) AS month_start)
SELECT strftime(m.month_start, '%b-%Y') AS cluster_month, count(o_orderkey) AS tickets
FROM m LEFT JOIN orders ON date_trunc('month', o_orderdate) = m.month_start GROUP BY m.month_start""")
def last_three_months(spark, folder):
    as_of = F.lit("2001-09-10").cast("timestamp")
    dated = mo.with_month(table(spark, folder, "orders").select("o_orderdate"), "o_orderdate")
    return mo.month_counts(mo.report_months(dated, as_of), as_of).select("cluster_month", "tickets")


@query("null_key_dropped", """SELECT quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id)
  WHERE quality IS NOT NULL GROUP BY quality""")
def null_key_dropped(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return joined.where(F.col("quality").isNotNull()).groupBy("quality").agg(F.count("*").alias("n"))


@query("null_key_kept", """SELECT coalesce(CAST(quality AS VARCHAR), 'none') AS quality, count(*) AS n
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality""")
def null_key_kept(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    grouped = joined.groupBy("quality").agg(F.count("*").alias("n"))
    return grouped.select(F.coalesce(F.col("quality").cast("string"), F.lit("none")).alias("quality"), "n")


@query("groups_with_text", """SELECT source, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id)
  GROUP BY source HAVING count(CASE WHEN toxic = 1 THEN text END) > 0""")
def groups_with_text(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    counted = joined.groupBy("source").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("toxic") == 1, F.col("text"))).alias("texts")
    )
    return counted.where(F.col("texts") > 0).drop("texts")


@query("combined_text", f"""WITH {ISSUES} SELECT id, summary || chr(10) || coalesce(nullif(description, ''), '') AS combined FROM issues""")
def combined_text(spark, folder):
    tickets = issues(spark, folder).withColumn("description", F.nullif("description", F.lit("")))
    return tickets.select("id", tx.combined_text().alias("combined"))


@query("combined_text_with_labels", f"""WITH {ISSUES}
  SELECT id, summary || ' ' || description || ' ' || feature || ' ' || coalesce(nullif(error_type, 'en'), '') AS combined FROM issues""")
def combined_text_with_labels(spark, folder):
    tickets = issues(spark, folder).withColumn("error_type", F.nullif("error_type", F.lit("en")))
    return tickets.select("id", tx.combined_text_with_labels().alias("combined"))


@query("completion_or_updated", f"WITH {ISSUES} SELECT id, {day('coalesce(completion_date, updated)')} AS completed FROM issues")
def completion_or_updated(spark, folder):
    chosen = src.completion_or_updated("completion_date", "updated")
    return issues(spark, folder).select("id", dt.day_text(dt.utc_time(chosen)).alias("completed"))


@query("missing_column_default", f"WITH {ISSUES} SELECT id, 'Unknown' AS priority, status FROM issues")
def missing_column_default(spark, folder):
    return src.with_defaults(issues(spark, folder), {"priority": "Unknown", "status": "Unknown"}).select("id", "priority", "status")


@query("kept_columns", f"WITH {ISSUES} SELECT id, summary, feature, status FROM issues")
def kept_columns(spark, folder):
    return src.keep_columns(issues(spark, folder), ["cluster_id", "id", "summary", "priority", "feature", "status"])


@query("lookup_name_or_first", """SELECT
  coalesce((SELECT min_by(n_nationkey, n_nationkey) FROM nation WHERE lower(trim(n_name)) = 'nation_7'), (SELECT min(n_nationkey) FROM nation)) AS found,
  (SELECT min(n_nationkey) FROM nation) AS not_found""")
def lookup_name_or_first(spark, folder):
    nation = table(spark, folder, "nation")
    hit = lu.by_name_or_first(nation, "n_name", " nation_7 ", "n_nationkey", "n_nationkey", "found")
    miss = lu.by_name_or_first(nation, "n_name", "nowhere", "n_nationkey", "n_nationkey", "not_found")
    return hit.select("found", miss.scalar().alias("not_found"))


@query("lookup_exact_or_first", """SELECT coalesce((SELECT min(r_regionkey) FROM region WHERE r_name = 'region_2'), (SELECT min(r_regionkey) FROM region)) AS found""")
def lookup_exact_or_first(spark, folder):
    return lu.by_exact_name_or_first(table(spark, folder, "region"), "r_name", "region_2", "r_regionkey", "r_regionkey", "found")


@query("lookup_part_or_first", "SELECT coalesce((SELECT min(n_nationkey) FROM nation WHERE lower(n_name) LIKE '%tion_1%'), (SELECT min(n_nationkey) FROM nation)) AS found")
def lookup_part_or_first(spark, folder):
    return lu.by_part_of_name_or_first(table(spark, folder, "nation"), "n_name", "tion_1", "n_nationkey", "n_nationkey", "found")


@query("lookup_first_row", "SELECT arg_min(r_name, r_regionkey) AS first_name FROM region")
def lookup_first_row(spark, folder):
    return lu.first_row(table(spark, folder, "region"), "r_name", "r_regionkey", "first_name")


@query("field_ids_by_name", """WITH wanted AS (SELECT c_custkey, ' Nation_' || (c_custkey % 30) || ' ' AS display FROM customer)
SELECT c_custkey, coalesce(CAST(n_nationkey AS VARCHAR), '') AS n_nationkey
FROM wanted LEFT JOIN nation ON lower(trim(display)) = lower(trim(n_name))""")
def field_ids_by_name(spark, folder):
    display = F.concat(F.lit(" Nation_"), (F.col("c_custkey") % 30).cast("string"), F.lit(" "))
    wanted = table(spark, folder, "customer").select("c_custkey", display.alias("display"))
    nation = table(spark, folder, "nation").select("n_name", "n_nationkey")
    found = lu.ids_by_name(wanted, nation, "display", "n_name", "n_nationkey", "n_nationkey")
    return found.select("c_custkey", "n_nationkey")


@query("newest_tickets", f"WITH {ISSUES} SELECT id, {day('created')} AS created_day FROM issues ORDER BY created DESC, id LIMIT 200")
def newest_tickets(spark, folder):
    tickets = issues(spark, folder).select("id", dt.utc_time("created").alias("created"))
    return src.newest(tickets, 200).select("id", dt.day_text("created").alias("created_day"))


@query("latest_updates", f"WITH {ISSUES} SELECT id FROM issues WHERE status = 'Done' ORDER BY updated DESC, id LIMIT 100")
def latest_updates(spark, folder):
    done = issues(spark, folder).where(F.col("status") == "Done").select("id", dt.utc_time("updated").alias("updated"))
    return src.newest(done, 100, "updated").select("id")


@query("months_in_order", """WITH m AS (SELECT date_trunc('month', o_orderdate) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY d) AS BIGINT) AS place, strftime(d, '%b-%Y') AS month, n FROM m""")
def months_in_order(spark, folder):
    counted = table(spark, folder, "orders").groupBy(dt.month_start("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    placed = with_position(Workspace(spark), counted, ["d"], "p")
    return placed.select((F.col("p") + 1).alias("place"), dt.month_tag("d").alias("month"), "n").orderBy("place")


@query("batch_numbers", f"""WITH {ISSUES}, r AS (SELECT id, row_number() OVER (ORDER BY created DESC, id) - 1 AS seq FROM issues)
SELECT id, CAST(seq AS BIGINT) AS seq, CAST(seq // 64 AS BIGINT) AS batch FROM r""")
def batch_numbers(spark, folder):
    tickets = issues(spark, folder).select("id", "created")
    ordered = src.with_row_order(Workspace(spark), tickets)
    return ordered.select("id", "seq", F.floor(F.col("seq") / 64).alias("batch"))


@query("first_rows_per_group", f"""WITH {ISSUES} SELECT feature, id FROM (
  SELECT feature, id, row_number() OVER (PARTITION BY feature ORDER BY seq) AS rn FROM issues) WHERE rn <= 5""")
def first_rows_per_group(spark, folder):
    tickets = issues(spark, folder).select("feature", "id", "seq")
    return first_rows(tickets, ["feature"], [F.asc("seq")], 5).select("feature", "id")


@query("appended_sources", f"""WITH {ISSUES}, a AS (SELECT id, status, 'search' AS origin FROM issues WHERE status <> 'Open'),
b AS (SELECT id, status, 'board' AS origin FROM issues WHERE feature IN ('src1', 'src2'))
SELECT id, status, origin FROM a UNION ALL SELECT id, status, origin FROM b WHERE id NOT IN (SELECT id FROM a)""")
def appended_sources(spark, folder):
    tickets = issues(spark, folder).select("id", "status", "feature")
    search = tickets.where(F.col("status") != "Open").select("id", "status", F.lit("search").alias("origin"))
    board = tickets.where(F.col("feature").isin("src1", "src2")).select("id", "status", F.lit("board").alias("origin"))
    return src.append_sources(search, board).select("id", "status", "origin")


@query("appended_sources_with_repeats", f"""WITH {ISSUES} SELECT id, 'search' AS origin FROM issues WHERE status <> 'Open'
UNION ALL SELECT id, 'board' AS origin FROM issues WHERE feature IN ('src1', 'src2')""")
def appended_sources_with_repeats(spark, folder):
    tickets = issues(spark, folder).select("id", "status", "feature")
    search = tickets.where(F.col("status") != "Open").select("id", F.lit("search").alias("origin"))
    board = tickets.where(F.col("feature").isin("src1", "src2")).select("id", F.lit("board").alias("origin"))
    return src.append_sources(search, board, unique=False)


@query("stacked_dates", f"""WITH {ISSUES}, s AS (SELECT feature, created AS ts FROM issues UNION ALL SELECT feature, updated FROM issues)
SELECT feature, {day('min(ts)')} AS first_day, {day('max(ts)')} AS last_day, count(*) AS n FROM s GROUP BY feature""")
def stacked_dates(spark, folder):
    tickets = issues(spark, folder).select("feature", dt.utc_time("created").alias("c"), dt.utc_time("updated").alias("u"))
    stacked = tickets.unpivot(["feature"], ["c", "u"], "kind", "ts")
    return stacked.groupBy("feature").agg(
        dt.day_text(F.min("ts")).alias("first_day"), dt.day_text(F.max("ts")).alias("last_day"), F.count("*").alias("n")
    )


@query("causes_of_last_month_only", f"""WITH {SNAPSHOT} SELECT root_cause FROM snapshot WHERE month(month_start) = 6
EXCEPT SELECT root_cause FROM snapshot WHERE month(month_start) < 6""")
def causes_of_last_month_only(spark, folder):
    causes = snapshot(spark, folder).select("month_start", "root_cause")
    last = causes.where(F.month("month_start") == 6).select("root_cause").distinct()
    return last.join(causes.where(F.month("month_start") < 6), "root_cause", "left_anti")
