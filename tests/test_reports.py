"""Aggregates, sources, sinks, reports and dashboard rules on small hand-made tables."""

import datetime as d

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticketmill.functions import text as tx
from ticketmill.operators import aggregates as ag
from ticketmill.operators import enrich as en
from ticketmill.operators import keyphrases as kp
from ticketmill.operators import lookups as lu
from ticketmill.operators import ranking as rk
from ticketmill.operators import vectors as vx
from ticketmill.plans import clusters as cl
from ticketmill.plans import marts as ma
from ticketmill.plans import monthly as mo
from ticketmill.sources import issues as src
from ticketmill.sources import sinks


def dicts(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]


TICKETS = [
    # seq, id, cluster_id, summary, description, feature, error_type, status, created, updated, completion_date
    (0, "A-0", 0, "pay page", "slow pay page", "Pay", "Timeout", "Open", "2025-01-01T00:00:00Z", "2025-01-01T23:00:00Z", "2025-03-02T00:00:00Z"),
    (1, "A-1", 0, "pay page", "pay page down", "Web", "Auth", "Done", "bad", "2025-01-02T01:00:00Z", "x"),
    (2, "A-2", 1, "please", "you", None, "nan", None, "", "", ""),
    (3, "A-3", None, "", "", "Pay", "Auth", "Done", "2025-01-01T00:00:00Z", "2025-01-01T00:00:00Z", ""),
]
COLUMNS = "seq long, id string, cluster_id long, summary string, description string, feature string, error_type string, status string, created string, updated string, completion_date string"


@pytest.fixture()
def tickets(spark):
    return spark.createDataFrame(TICKETS, COLUMNS).withColumn("combined", tx.combined_text())


def test_most_frequent_values(spark):
    rows = [("g", "b"), ("g", "a"), ("g", None), ("g", None), ("g", None), ("h", None), ("i", "z"), ("i", "z"), ("i", "a")]
    df = spark.createDataFrame(rows, "k string, v string")
    assert dicts(ag.most_frequent(df, ["k"], ["v"]), "k") == [{"k": "g", "v": "a"}, {"k": "h", "v": "Unknown"}, {"k": "i", "v": "z"}]
    ordered = spark.createDataFrame([("g", "b", 1), ("g", "a", 2), ("h", None, 3)], "k string, v string, o int")
    assert dicts(ag.first_seen_mode(ordered, ["k"], "v", "o"), "k") == [{"k": "g", "v": "b"}, {"k": "h", "v": "N/A"}]


def test_daily_report(ws, tickets):
    rows = dicts(cl.daily_report(ws, tickets), "cluster_id")
    assert [r["cluster_id"] for r in rows] == [0, 1]
    first, second = rows
    assert first["total_tickets"] == 2 and first["example_ids"] == "A-0, A-1"
    assert (first["feature"], first["error_type"], first["status"]) == ("Pay", "Auth", "Done")
    assert first["create_date"] == "2025-03-02" and second["create_date"] == ""
    assert first["recurring_summary"] == "Grouped similar incidents. Representative notes: pay page pay page..."
    assert first["crux"] == "page page pay page slow pay pay page slow"
    assert (second["feature"], second["status"]) == ("Unknown", "Unknown")
    # "please" is a phrase but says nothing; the sanitiser's own sentinel results
    assert second["crux"] == tx.NO_CRUX


def test_daily_report_with_a_model(ws, tickets):
    def model(frame):
        texts = ["" if "please" in p else ("Token expiry in Pay" if p.startswith("Give") else "Pay fails.") for p in frame["prompt"]]
        return pd.DataFrame({"reply": texts})

    first, second = dicts(cl.daily_report(ws, tickets, model), "cluster_id")
    assert first["recurring_summary"] == "Pay fails." and first["crux"] == "token expiry in pay"
    assert second["recurring_summary"].startswith("Grouped similar incidents.")


def test_pattern_report(ws, tickets):
    first, second = dicts(cl.pattern_report(ws, tickets), "cluster_id")
    assert (first["first_seen"], first["last_seen"], first["frequency"]) == ("2025-01-01", "2025-01-02", "1d + 2")
    assert first["features_impacted"] == "Pay, Web" and first["severity"] == "Low"
    assert first["pattern_summary"] == "Repeated issue pattern: pay page\nslow pay page..."
    assert (second["first_seen"], second["frequency"], second["error_types"]) == ("", "0d + 1", "")


def test_pattern_report_with_a_model(ws, tickets):
    def model(frame):
        return pd.DataFrame({"reply": ['so {"pattern_summary": "P", "root_cause": " "}'] * len(frame)})

    first = dicts(cl.pattern_report(ws, tickets, model), "cluster_id")[0]
    assert first["pattern_summary"] == "P" and first["root_cause"] == "Cause not confidently inferred."


def test_short_patterns_keep_the_null_group_and_skip_textless_ones(ws, tickets):
    rows = dicts(cl.short_patterns(ws, tickets), "cluster_id")
    assert [(r["cluster_id"], r["count"]) for r in rows] == [(None, 1), (0, 2), (1, 1)]
    textless = tickets.withColumn("combined", F.when(F.col("cluster_id") == 0, F.col("combined")))
    assert [r["cluster_id"] for r in cl.short_patterns(ws, textless).collect()] == [0]


@pytest.mark.parametrize("days,expected", [(23, 0), (25, 1), (0, 0)])
def test_spread_is_in_whole_days(spark, days, expected):
    t = d.datetime(2025, 1, 1)
    df = spark.createDataFrame([(t, t + d.timedelta(hours=days))], "a timestamp, b timestamp")
    assert df.select(ag.spread_days(F.col("a"), F.col("b")).alias("s")).first()["s"] == expected


def test_severity_status_and_rating_edges(spark):
    df = spark.range(1, 6)
    assert [r[0] for r in df.select(ag.severity(F.col("id"))).collect()] == ["Low", "Low", "Medium", "Medium", "High"]
    shares = spark.createDataFrame([(0.2,), (0.21,), (0.4,), (0.41,)], "s double")
    assert [r[0] for r in shares.select(ma.stability(F.col("s"))).collect()] == ["Stable", "Moderate", "Moderate", "Poor"]


def test_rank_positions_and_joins_with_a_hot_key(spark, ws):
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("o"))
    placed = rk.with_position(ws, df, ["o"]).orderBy("pos").collect()
    assert [r["pos"] for r in placed] == list(range(2000)) and placed[0]["o"] == -1999
    ranked = rk.rank_in_group(ws, df, "k", ["o"]).where("k = 7").orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(len(ranked))) and ranked[0]["n"] == len(ranked)
    assert ranked[0]["o"] < ranked[-1]["o"]
    groups = df.groupBy("k").agg(F.count("*").alias("n"))
    assert rk.join_by_key(df, groups, "k").where("n is null").count() == 0
    assert rk.join_by_key(df, groups, "k").count() == 2000


def test_lists_in_parts_and_head_of_text(spark):
    ranked = spark.range(25).select(F.lit("c").alias("g"), F.col("id").alias("rank"), F.col("id").cast("string").alias("v"))
    parts = dicts(ag.list_parts(ranked, "g", "v", size=10), "part")
    assert ", ".join(p["v"] for p in parts) == ", ".join(str(i) for i in range(25)) and len(parts) == 3
    head = ag.head_text(ranked, "g", "v", "t", length=9).first()["t"]
    assert head == "\n".join(str(i) for i in range(25))[:9]
    blank = ranked.withColumn("v", F.lit(""))
    assert ag.head_text(blank, "g", "v", "t", length=9).first()["t"] == "\n" * 9


def test_phrases_without_any_word_are_absent(spark):
    df = spark.createDataFrame([("a", "the of and"), ("b", "disk full disk full")], "g string, t string")
    rows = dicts(kp.top_phrases(df, "g", "t"), "n", "term")
    assert {r["g"] for r in rows} == {"b"}
    assert {(r["term"], r["n"]) for r in rows} == {("disk", 2), ("full", 2), ("disk full", 2), ("full disk", 1)}


def test_lookups(spark):
    boards = spark.createDataFrame([(0, "Ops", 10), (1, " critical DESK ", 11), (2, "Critical Desk", 12)], "p int, name string, id int")
    one = lambda df: df.first()["v"]
    assert one(lu.by_name_or_first(boards, "name", "Critical desk", "id", "p", "v")) == 11
    assert one(lu.by_name_or_first(boards, "name", "none", "id", "p", "v")) == 10
    assert one(lu.by_exact_name_or_first(boards, "name", "Critical Desk", "id", "p", "v")) == 12
    assert one(lu.by_part_of_name_or_first(boards, "name", "critical", "id", "p", "v")) == 11
    assert one(lu.first_row(boards.where("false"), "id", "p", "v")) is None
    wanted = spark.createDataFrame([("ops ",), ("zzz",)], "display string")
    assert [r["id"] for r in lu.ids_by_name(wanted, boards, "display", "name", "id", "p").orderBy("display").collect()] == ["10", ""]


def test_pages_of_issues(spark, ws):
    page = (
        '{"issues":[{"key":"K-1","fields":{"summary":"{\\"text\\": 1}","description":null,"customfield_10015":null,'
        '"status":{"name":"Open"},"created":"2025-01-01T00:00:00.000+0000","updated":"2025-01-02T00:00:00.000+0000","done":""}},'
        '{"key":"K-2","fields":{"summary":null,"description":{"content":[{"text":"b"}]},"customfield_10015":[{"value":"F"}],'
        '"status":"Closed","updated":"u","done":"d"}},{"key":"K-3"}]}\n{"issues":[]}\n'
    )
    path = ws.path("pages")
    spark.createDataFrame([(page,)], "value string").write.text(path)
    rows = dicts(src.with_option_text(src.flatten_issues(src.read_pages(spark, path), "done")), "id")
    assert rows[0] == {
        "id": "K-1", "summary": '{"text": 1}', "description": "", "feature": "Unknown", "error_type": "Unknown", "status": "Open",
        "priority": "Unknown", "created": "2025-01-01T00:00:00.000+0000", "updated": "2025-01-02T00:00:00.000+0000",
        "completion_date": "2025-01-02T00:00:00.000+0000",
    }
    assert (rows[1]["summary"], rows[1]["description"], rows[1]["feature"], rows[1]["status"], rows[1]["completion_date"]) == ("", "b", "F", "Closed", "d")
    assert (rows[2]["summary"], rows[2]["status"], rows[2]["created"]) == ("", "Unknown", "")


def test_csv_round_trip_and_required_columns(spark, ws):
    df = spark.createDataFrame([("1", 'say "hi"\nthere, you', "", None, "e\\", "c", "u")], src.ISSUE_SCHEMA)
    path = ws.path("csv")
    sinks.write_csv(df, path)
    back = src.read_csv(spark, path).fillna("").first().asDict()
    assert back == {"id": "1", "summary": 'say "hi"\nthere, you', "description": "", "feature": "", "error_type": "e\\", "created": "c", "updated": "u"}
    with pytest.raises(ValueError, match="cluster_id"):
        src.require_columns(df, "id", "cluster_id")


def test_months_are_replaced_one_by_one(spark, ws):
    df = spark.createDataFrame([("Jan-2025", 1), ("Feb-2025", 2), ("Mar-2025", 3)], "cluster_month string, n int").select("n", "cluster_month")
    path = ws.path("months")
    sinks.replace_months(df, path)
    sinks.replace_months(df.where("n = 2").withColumn("n", F.lit(20)), path, months=["Feb-2025", "Mar-2025"])
    assert {tuple(r) for r in sinks.read_months(spark, path, df.schema).collect()} == {(1, "Jan-2025"), (20, "Feb-2025")}


def test_empty_table_keeps_its_columns(spark, ws):
    df = spark.createDataFrame([], "cluster_id long, crux string")
    path = ws.path("empty")
    sinks.replace_table(df, path)
    assert spark.read.parquet(path).columns == ["cluster_id", "crux"]


def test_sources_in_order(spark):
    a = spark.createDataFrame([], "id string")
    b = spark.createDataFrame([("x",)], "id string")
    c = spark.createDataFrame([("x",), ("y",)], "id string")
    assert [r["id"] for r in src.first_non_empty([a, b, c]).collect()] == ["x"]
    assert sorted(r["id"] for r in src.append_sources(b, c).collect()) == ["x", "y"]
    assert sorted(r["id"] for r in src.append_sources(b, c, unique=False).collect()) == ["x", "x", "y"]


def test_labels_from_a_model(spark, tickets):
    calls = lambda frame: pd.DataFrame({"reply": ['{"feature": "F%d"}' % len(frame)] * len(frame)})
    rows = dicts(en.label_tickets(tickets, calls), "seq")
    assert all(r["feature"].startswith("F") and r["error_type"] == "General" for r in rows)
    kept = dicts(en.label_tickets(tickets, calls, override="unknown"), "seq")
    assert [r["feature"] for r in kept][:2] == ["Pay", "Web"] and kept[2]["feature"].startswith("F")
    checked = dicts(en.label_tickets(tickets, calls, features=["Pay"], check=True), "seq")
    assert {r["feature"] for r in checked} == {"General"}

    def failing(frame):
        raise RuntimeError("no service")

    assert {r["feature"] for r in en.label_tickets(tickets, failing).collect()} == {"General"}


def test_batches_of_64(spark):
    seen = en.enrich(spark.range(300).coalesce(1), lambda f: pd.DataFrame({"n": [len(f)] * len(f)}), en.T.StructType([en.T.StructField("n", en.T.LongType())]))
    assert sorted(r["n"] for r in seen.groupBy("n").count().select("n").collect()) == [44, 64]


def test_embedding_hook_feeds_the_clusters(spark, ws, tickets):
    def model(frame):
        return pd.DataFrame({"vector": [[1.0, float("pay" in t)] for t in frame["text"]]})

    embedded = en.embed(tickets.drop("cluster_id"), "combined", model)
    vectors = vx.given_vectors(ws, embedded, "seq", "vector", 2)
    found = cl.daily_clusters(ws, embedded.drop("vector", "combined"), 0.9, vectors, 2)
    assert [r["cluster_id"] for r in found.orderBy("seq").collect()] == [0, 0, 1, 1]


def test_monthly_report(spark, ws):
    rows = [
        (i, f"M-{i}", "disk full" if i < 7 else f"other thing {i}", "", "Disk", "IO", "Done", "2025-02-0%dT00:00:00Z" % (i % 9 + 1))
        for i in range(9)
    ] + [(9, "M-9", "disk full", "", "Disk", "IO", "Done", "2025-03-01T00:00:00Z"), (10, "M-10", "x", "", "", "", "", "junk")]
    df = spark.createDataFrame(rows, "seq long, id string, summary string, description string, feature string, error_type string, status string, completion_date string")
    clustered = mo.monthly_clusters(ws, mo.with_month(df))
    report = dicts(mo.monthly_report(ws, clustered), "month_start", "cluster_id")
    assert [(r["cluster_month"], r["cluster_id"], r["total_tickets"]) for r in report][0] == ("Feb-2025", 0, 7)
    assert report[0]["example_ids"] == "M-0, M-1, M-2, M-3, M-4" and report[0]["create_date"] == "2025-02-01"
    assert report[-1]["cluster_month"] == "Mar-2025" and report[-1]["cluster_id"] == 0
    assert report[0]["resolution_suggestion"] == "See summary"
    counts = mo.month_counts(mo.with_month(df), F.lit("2025-04-10").cast("timestamp"))
    assert [(r["cluster_month"], r["tickets"]) for r in counts.orderBy("month_start").collect()] == [("Feb-2025", 9), ("Mar-2025", 1), ("Apr-2025", 0)]


def test_summary_without_ages_and_tracker(spark):
    day = lambda m: d.date(2025, m, 1)
    rows = [(day(1), 1, "F", "E,G", "c1", 3), (day(2), 1, "F", "G", "c1", 1), (day(3), 1, "F", "E", "c2", 1), (day(2), 2, "H", "", "c3", 2)]
    snap = spark.createDataFrame(rows, "month_start date, cluster_id int, feature string, error_type string, root_cause string, total_tickets long")
    summary = dicts(ma.report_summary(snap), "month_start")
    assert [r["month"] for r in summary] == ["Jan-2025", "Feb-2025", "Mar-2025"] and summary[0]["avg_ticket_age"] is None
    tracker = {r["cluster_id"]: (r["frequency"], r["status"], r["ticket_count"]) for r in ma.recurrence_tracker(snap).collect()}
    assert tracker == {1: (3, "Chronic", 5), 2: (1, "Fixed", 2)}
    assert [r["new_root_causes"] for r in ma.new_root_causes(snap).orderBy("month_start").collect()] == [1, 1, 1]
    assert {r["month_start"].month: r["common_error_type"] for r in ma.common_error_type(snap).collect()} == {1: "E", 2: "G", 3: "E"}


def test_missing_causes_and_error_types_stay(spark):
    rows = [("2024-01-01", 1, "f", None, "a", 1), ("2024-02-01", 2, "f", None, None, 2), ("2024-03-01", 3, "g", "e , e", "a", 3)]
    snap = spark.createDataFrame(rows, "m string, cluster_id int, feature string, error_type string, root_cause string, total_tickets long")
    snap = snap.withColumn("month_start", F.to_date("m")).withColumn("pos", F.col("cluster_id"))
    assert [r["common_error_type"] for r in ma.month_health(snap).orderBy("month_start").collect()] == ["Unknown", "Unknown", "e"]
    assert [r["seen_before"] for r in ma.seen_before(snap).orderBy("month_start").collect()] == [False, False, True]
    assert ma.error_insights(snap, "pos").count() == 2
    assert [r[1] for r in ma.causes_not_in_previous_month(snap).orderBy("month_start").collect()] == [1, 0, 1]


def test_csv_goes_by_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,description,extra,summary\n1,"d ""x""\nline",e,s\n')
    row = src.read_csv(spark, str(tmp_path / "a.csv"), required=("summary", "description")).collect()[0]
    assert (row["id"], row["summary"], row["description"], row["extra"], row["feature"]) == ("1", "s", 'd "x"\nline', "e", None)
    (tmp_path / "b.csv").write_text("id,title\n1,t\n")
    with pytest.raises(ValueError, match="summary"):
        src.read_csv(spark, str(tmp_path / "b.csv"), required=("summary",))


def test_sources_keep_tickets_without_an_id(spark):
    a = spark.createDataFrame([("x", 1), ("", 2), ("", 3)], "id string, v int")
    b = spark.createDataFrame([("x", 4), ("", 5), ("y", 6), (None, 7)], "id string, v int")
    assert sorted(r["v"] for r in src.append_sources(a, b).collect()) == [1, 2, 3, 5, 6, 7]


def test_malformed_pages_are_an_error(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"issues": []}\n{"issues": [\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        src.read_pages(spark, str(tmp_path / "p.json")).collect()


def test_replies_lose_all_outer_white_space(spark):
    df = spark.createDataFrame([('{"feature": "Pay\\n", "error_type": "\\n"}',)], "r string")
    got = df.select(tx.label_from_reply("r", "feature").alias("a"), tx.label_from_reply("r", "error_type").alias("b")).collect()[0]
    assert (got["a"], got["b"]) == ("Pay", "General")
