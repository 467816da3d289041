"""Queries on the text, option, date and prompt functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketmill.functions import dates as dt
from ticketmill.functions import options as op
from ticketmill.functions import prompts as pr
from ticketmill.functions import text as tx
from ticketmill.operators import enrich as en
from ticketmill.plans import clusters as cl
from ticketmill.queries.tables import query
from ticketmill.queries.views import ISSUES, crux_sql, issues, norm_sql, table


@query("normalized_text", f"WITH {ISSUES} SELECT id, {norm_sql('summary || chr(10) || description')} AS normalized FROM issues")
def normalized_text(spark, folder):
    return issues(spark, folder).select("id", tx.normalize_text(tx.combined_text()).alias("normalized"))


@query("normalized_pages", f"SELECT page_id, {norm_sql('url')} AS url_text, {norm_sql('html')} AS html_text FROM pages")
def normalized_pages(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", tx.normalize_text("url").alias("url_text"), tx.normalize_text("html").alias("html_text")
    )


@query("ticket_keys_kept_or_stripped", f"""WITH k AS (SELECT o_orderkey, 'Order ORD-' || o_orderkey || ' of ' || o_orderpriority AS t FROM orders)
SELECT o_orderkey, {norm_sql('t')} AS kept, {norm_sql("regexp_replace(t, '[A-Z]{2,}-[0-9]+', ' ', 'g')")} AS stripped FROM k""")
def ticket_keys_kept_or_stripped(spark, folder):
    t = F.concat(F.lit("Order ORD-"), F.col("o_orderkey").cast("string"), F.lit(" of "), "o_orderpriority")
    return table(spark, folder, "orders").select(
        "o_orderkey", tx.normalize_text(t).alias("kept"), tx.normalize_text(t, strip_ticket_keys=True).alias("stripped")
    )


@query("crux_of_text", f"WITH {ISSUES} SELECT id, {crux_sql('summary')} AS crux FROM issues")
def crux_of_text(spark, folder):
    return issues(spark, folder).select("id", tx.crux_of("summary").alias("crux"))


@query("crux_of_noisy_text", f"""WITH k AS (SELECT event_id, 'Please FIX the issue 0xA' || user_id || 'f of abc-' || event_id || ' at www.x.y/' || user_id
    || ' or https://x.y/' || event_id || ', mail a.b' || user_id || '@x-y.com ' || event_type AS t FROM events)
SELECT event_id, {crux_sql('t')} AS crux FROM k""")
def crux_of_noisy_text(spark, folder):
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    t = F.concat(
        F.lit("Please FIX the issue 0xA"), user, F.lit("f of abc-"), event, F.lit(" at www.x.y/"), user,
        F.lit(" or https://x.y/"), event, F.lit(", mail a.b"), user, F.lit("@x-y.com "), "event_type",
    )
    return table(spark, folder, "events").select("event_id", tx.crux_of(t).alias("crux"))


@query("option_values", """SELECT doc_id, CASE doc_id % 7
    WHEN 0 THEN source WHEN 1 THEN lang WHEN 2 THEN source || ', ' || lang || ', x' WHEN 3 THEN 'Unknown'
    WHEN 4 THEN source WHEN 5 THEN 'Unknown' ELSE '{''id'': ' || doc_id || ', ''self'': ''' || source || '''}' END AS feature
  FROM documents""")
def option_values(spark, folder):
    shape = F.col("doc_id") % 7
    raw = (
        F.when(shape == 0, F.concat(F.lit('{"value":"'), "source", F.lit('"}')))
        .when(shape == 1, F.concat(F.lit('{"value":"","name":"'), "lang", F.lit('"}')))
        .when(shape == 2, F.concat(F.lit('[{"value":"'), "source", F.lit('"},{"name":"'), "lang", F.lit('"},"","x"]')))
        .when(shape == 3, F.lit("null"))
        .when(shape == 4, F.concat(F.lit('"'), "source", F.lit('"')))
        .when(shape == 5, F.lit("[]"))
        .otherwise(F.concat(F.lit('{"id":'), F.col("doc_id").cast("string"), F.lit(',"self":"'), "source", F.lit('"}')))
    )
    return table(spark, folder, "documents").select("doc_id", op.option_text(raw).alias("feature"))


@query("named_objects", """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN source WHEN 1 THEN '' WHEN 2 THEN lang ELSE 'Unknown' END AS status
  FROM documents""")
def named_objects(spark, folder):
    shape = F.col("doc_id") % 5
    raw = (
        F.when(shape == 0, F.concat(F.lit('{"name":"'), "source", F.lit('"}')))
        .when(shape == 1, F.lit('{"name":""}'))
        .when(shape == 2, F.concat(F.lit('"'), "lang", F.lit('"')))
        .when(shape == 3, F.lit("null"))
        .otherwise(F.lit('""'))
    )
    return table(spark, folder, "documents").select("doc_id", op.named_object_text(raw).alias("status"))


@query("rich_text", """SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN role || ' ' || text || ' end' ELSE '{''role'': ''' || role || '''}' END AS body
  FROM conversations""")
def rich_text(spark, folder):
    text = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    shape = F.col("turn") % 3
    raw = (
        F.when(shape == 0, text)
        .when(
            shape == 1,
            F.concat(
                F.lit('{"children":[{"text":"end"}],"text":"'), "role",
                F.lit('","content":[{"content":[{"items":[{"text":'), text, F.lit("},{}]}]}]}"),
            ),
        )
        .otherwise(F.concat(F.lit('{"role":"'), "role", F.lit('"}')))
    )
    return table(spark, folder, "conversations").select("conv_id", "turn", tx.rich_text(raw).alias("body"))


@query("text_cuts", "SELECT doc_id, left(text, 4000) AS label_text, left(text, 240) AS note, left(text, 120) AS sample FROM documents")
def text_cuts(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        tx.cut("text", pr.LABEL_TEXT_LENGTH).alias("label_text"),
        tx.cut("text", pr.NOTE_LENGTH).alias("note"),
        tx.cut("text", pr.SAMPLE_LENGTH).alias("sample"),
    )


@query("parsed_times", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders""")
def parsed_times(spark, folder):
    shape = F.col("o_orderkey") % 3
    text = (
        F.when(shape == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0530'"))
        .when(shape == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.concat(F.lit("day "), "o_orderpriority"))
    )
    parsed = F.date_format(dt.utc_time(text), "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "orders").select("o_orderkey", parsed.alias("parsed"))


@query("date_texts", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%b-%Y') AS month FROM events")
def date_texts(spark, folder):
    return table(spark, folder, "events").select("event_id", dt.day_text("ts").alias("day"), dt.month_tag("ts").alias("month"))


@query("json_in_reply", """SELECT event_id, props AS found, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_in_reply(spark, folder):
    reply = F.concat(F.lit("Here it is:\n"), "props", F.lit("\nfor "), "event_type")
    found = tx.json_object_in(reply)
    return table(spark, folder, "events").select(
        "event_id", found.alias("found"), F.get_json_object(found, "$.k").cast("bigint").alias("k")
    )


def _replies(frame):
    shape = frame["event_id"] % 6
    texts = [
        'Sure: {"feature": " %s ", "error_type": "%s"}',
        '{"feature": "%s", "error_type": ""}',
        "no labels for %s and %s",
        '{"feature": "%s"} and {"error_type": "%s"}',
        '{"feature": null, "error_type": 7} %s %s',
        '{"feature": false, "error_type": true} %s %s',
    ]
    values = []
    for s, kind, user in zip(shape, frame["event_type"], frame["user_id"]):
        n = texts[s].count("%s")
        values.append(texts[s] % (kind, user)[:n] if n else texts[s])
    return frame.assign(reply=values)[["reply"]]


@query("label_replies", """SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN event_type ELSE 'General' END AS feature,
  CASE event_id % 6 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 4 THEN '7' WHEN 5 THEN 'True' ELSE 'General' END AS error_type
FROM events""")
def label_replies(spark, folder):
    """Labels from a stand-in model that answers in several good and bad forms, by batches of 64."""
    from pyspark.sql import types as T

    events = table(spark, folder, "events").select("event_id", "event_type", "user_id")
    replied = en.enrich(events, _replies, T.StructType([T.StructField("reply", T.StringType())]))
    return replied.select(
        "event_id", tx.label_from_reply("reply", "feature").alias("feature"),
        tx.label_from_reply("reply", "error_type").alias("error_type"),
    )


@query("labels_without_model", f"WITH {ISSUES} SELECT id, 'General' AS feature, 'General' AS error_type FROM issues")
def labels_without_model(spark, folder):
    return en.label_tickets(issues(spark, folder)).select("id", "feature", "error_type")


@query("pattern_replies", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'many ' || event_type END AS pattern_summary,
  CASE WHEN event_id % 3 = 0 THEN 'user ' || user_id END AS root_cause FROM events""")
def pattern_replies(spark, folder):
    good = F.concat(
        F.lit('{"pattern_summary": " many '), "event_type", F.lit('", "root_cause": "user '),
        F.col("user_id").cast("string"), F.lit('", "recommendation": ""}'),
    )
    reply = F.when(F.col("event_id") % 3 == 0, good).when(F.col("event_id") % 3 == 1, F.lit("no idea"))
    return table(spark, folder, "events").select(
        "event_id", tx.pattern_field(reply, "pattern_summary").alias("pattern_summary"),
        tx.pattern_field(reply, "root_cause").alias("root_cause"),
    )


@query("vocabulary_lists", """SELECT doc_id, array_to_string(list_filter(list_transform(string_split(' ' || source || ' , ,' || lang || ',', ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS words,
  CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'General' END AS label FROM documents""")
def vocabulary_lists(spark, folder):
    text = F.concat(F.lit(" "), "source", F.lit(" , ,"), "lang", F.lit(","))
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(tx.vocabulary_of(text), "|").alias("words"),
        tx.label_in_vocabulary(F.col("lang"), tx.vocabulary_of(F.lit("en, de"))).alias("label"),
    )


@query("cluster_notes", f"""WITH {ISSUES}, f AS (SELECT feature AS cluster_id, seq, summary, row_number() OVER (PARTITION BY feature ORDER BY seq) AS rn FROM issues)
SELECT cluster_id, 'Grouped similar incidents. Representative notes: ' || left(string_agg(summary, ' ' ORDER BY seq), 240) || '...' AS note
FROM f WHERE rn <= 3 GROUP BY cluster_id""")
def cluster_notes(spark, folder):
    return cl.notes(issues(spark, folder).withColumn("cluster_id", F.col("feature")))


@query("label_prompts", f"""WITH {ISSUES} SELECT id, '{pr.LABEL_PROMPT.replace("'", "''")}' || chr(10) || 'Feature choices: src1, src2' || chr(10) || chr(10) || 'Text:' || chr(10)
  || left(summary || chr(10) || description, 4000) AS prompt FROM issues""")
def label_prompts(spark, folder):
    choices = tx.vocabulary_of(F.lit("src1, src2,"))
    prompt = pr.label_prompt(tx.combined_text(), choices, tx.vocabulary_of(F.lit("")))
    return issues(spark, folder).select("id", prompt.alias("prompt"))


@query("safe_numbers", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN user_id ELSE 500 END AS whole,
  CASE event_id % 3 WHEN 0 THEN CAST(user_id AS DOUBLE) WHEN 1 THEN value ELSE 0.85 END AS number FROM events""")
def safe_numbers(spark, folder):
    shape = F.col("event_id") % 3
    text = (
        F.when(shape == 0, F.col("user_id").cast("string"))
        .when(shape == 1, F.concat(F.col("value").cast("string"), F.lit("")))
        .otherwise(F.col("event_type"))
    )
    whole = F.when(shape == 1, F.lit("x")).otherwise(text)
    return table(spark, folder, "events").select(
        "event_id", tx.integer_or(whole, 500).alias("whole"), tx.number_or(text, 0.85).alias("number")
    )
