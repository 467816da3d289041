"""Queries on vectors, similarity, clusters and the reports built from them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ticketmill.functions import prompts as pr
from ticketmill.functions import text as tx
from ticketmill.operators import aggregates as ag
from ticketmill.operators import hyperplanes as hy
from ticketmill.operators import keyphrases as kp
from ticketmill.operators import leaders as ld
from ticketmill.operators import linkage as lk
from ticketmill.operators import similarity as sm
from ticketmill.operators import tracking as tr
from ticketmill.operators import vectors as vx
from ticketmill.operators.ranking import rank_in_group, with_position
from ticketmill.plans import clusters as cl
from ticketmill.plans import marts as ma
from ticketmill.plans import monthly as mo
from ticketmill.plans import runs
from ticketmill.queries.tables import query
from ticketmill.queries.views import ISSUES, TOKEN_SQL, crux_sql, day, issues, mode_sql, month_text, norm_sql, table
from ticketmill.session import Workspace
from ticketmill.sources import issues as src
from ticketmill.sources import sinks

DENSE_THRESHOLD = 0.30
DENSE_WIDTH = 64


def tfidf_sql(text: str) -> str:
    """CTEs from ``issues`` to the unit TF-IDF weights ``v`` (seq, term, w)."""
    return rf"""texts AS (SELECT seq, {text} AS txt FROM issues),
tok AS (SELECT seq, unnest(regexp_extract_all(lower(txt), '{TOKEN_SQL}')) AS term FROM texts),
tc AS (SELECT seq, term, count(*) AS n FROM tok GROUP BY seq, term),
vocab AS (SELECT term, sum(n) AS c, count(*) AS df FROM tc GROUP BY term ORDER BY c DESC, term LIMIT 1024),
raw AS (SELECT seq, term, n * (ln((1 + (SELECT count(*) FROM texts)) / (1.0 + df)) + 1) AS w FROM tc JOIN vocab USING (term)),
v AS MATERIALIZED (SELECT seq, term, w / sqrt(sum(w * w) OVER (PARTITION BY seq)) AS w FROM raw)"""


SPARSE_PAIRS = """p AS MATERIALIZED (SELECT a.seq AS l, b.seq AS r FROM v a JOIN v b USING (term) GROUP BY a.seq, b.seq HAVING sum(a.w * b.w) >= {t})"""
DENSE_PAIRS = """e AS (SELECT vec_id AS seq, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS MATERIALIZED (SELECT a.seq AS l, b.seq AS r FROM e a, e b WHERE list_cosine_similarity(a.x, b.x) >= {t})"""


def leaders_sql(rows: str) -> str:
    """CTEs from pairs ``p`` (both directions, with self) to ``ids`` (seq, cluster_id)."""
    return f"""nb AS MATERIALIZED (SELECT s.seq AS i, list(p.r) FILTER (p.r IS NOT NULL) AS ns FROM {rows} s LEFT JOIN p ON p.l = s.seq AND p.r < p.l GROUP BY s.seq),
scan(i, leaders) AS (SELECT CAST(-1 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
  SELECT nb.i, CASE WHEN list_has_any(coalesce(nb.ns, []), scan.leaders) THEN scan.leaders ELSE list_append(scan.leaders, nb.i) END
  FROM scan JOIN nb ON nb.i = scan.i + 1),
led AS (SELECT unnest(leaders) AS leader FROM scan WHERE i = (SELECT max(seq) FROM {rows})),
num AS (SELECT leader, row_number() OVER (ORDER BY leader) - 1 AS cid FROM led),
got AS (SELECT p.l AS seq, max(num.cid) AS cid FROM p JOIN num ON num.leader = p.r GROUP BY p.l),
ids AS MATERIALIZED (SELECT s.seq, got.cid AS cluster_id FROM {rows} s LEFT JOIN got ON got.seq = s.seq)"""


COMBINED = "summary || chr(10) || description"
DAILY = f"""WITH RECURSIVE {ISSUES}, {tfidf_sql(norm_sql(COMBINED))}, {SPARSE_PAIRS.format(t=cl.TEXT_THRESHOLD)}, {leaders_sql('issues')},
clustered AS MATERIALIZED (SELECT i.*, {COMBINED} AS combined, cluster_id FROM issues i JOIN ids USING (seq))"""
FILE = f"""WITH RECURSIVE {ISSUES}, {tfidf_sql(COMBINED)}, {SPARSE_PAIRS.format(t=cl.FILE_THRESHOLD)}, {leaders_sql('issues')},
clustered AS MATERIALIZED (SELECT i.*, {COMBINED} AS combined, cluster_id FROM issues i JOIN ids USING (seq))"""


def shown(df, column="cluster_id"):
    return df.withColumn(column, F.coalesce(column, F.lit(-1)))


def daily(spark, folder):
    ws = Workspace(spark)
    return ws, ws.save(cl.daily_clusters(ws, issues(spark, folder)), "clustered")


def by_file(spark, folder):
    ws = Workspace(spark)
    return ws, ws.save(cl.file_clusters(ws, issues(spark, folder)), "clustered")


# ---- aggregates over a plain group ---------------------------------------------------------------


@query("tickets_per_group", f"WITH {ISSUES} SELECT feature, count(*) AS total_tickets FROM issues GROUP BY feature")
def tickets_per_group(spark, folder):
    return issues(spark, folder).groupBy("feature").agg(F.count("*").alias("total_tickets"))


@query("most_frequent_labels", f"""WITH {ISSUES}, known AS (SELECT feature, error_type, nullif(status, 'Unknown') AS status FROM issues),
{mode_sql('known', 'feature', 'error_type', 'me')}, {mode_sql('known', 'feature', 'status', 'ms')}
SELECT k.feature, coalesce(me.error_type, 'Unknown') AS error_type, coalesce(ms.status, 'Unknown') AS status
FROM (SELECT DISTINCT feature FROM known) k LEFT JOIN me USING (feature) LEFT JOIN ms USING (feature)""")
def most_frequent_labels(spark, folder):
    known = issues(spark, folder).withColumn("status", F.nullif("status", F.lit("Unknown")))
    return ag.most_frequent(known, ["feature"], ["error_type", "status"])


@query("first_seen_mode", f"""WITH {ISSUES} SELECT error_type, feature FROM (SELECT error_type, feature,
  row_number() OVER (PARTITION BY error_type ORDER BY count(*) DESC, min(seq)) AS rn FROM issues GROUP BY error_type, feature) WHERE rn = 1""")
def first_seen_mode(spark, folder):
    return ag.first_seen_mode(issues(spark, folder), ["error_type"], "feature", "seq")


@query("earliest_completion", f"WITH {ISSUES} SELECT feature, coalesce({day('min(completion_date)')}, '') AS create_date FROM issues GROUP BY feature")
def earliest_completion(spark, folder):
    return issues(spark, folder).groupBy("feature").agg(ag.earliest_day("completion_date").alias("create_date"))


@query("first_and_last_seen", f"""WITH {ISSUES}, g AS (SELECT feature, error_type, count(*) AS n, least(min(created), min(updated)) AS a,
  greatest(max(created), max(updated)) AS b FROM issues GROUP BY feature, error_type)
SELECT feature, error_type, {day('a')} AS first_seen, {day('b')} AS last_seen,
  (greatest(0, (epoch_us(b) - epoch_us(a)) // 86400000000)) || 'd + ' || n AS frequency,
  CASE WHEN n >= 5 THEN 'High' WHEN n >= 3 THEN 'Medium' ELSE 'Low' END AS severity FROM g""")
def first_and_last_seen(spark, folder):
    first, last = ag.seen_between("created", "updated")
    grouped = issues(spark, folder).groupBy("feature", "error_type").agg(
        F.count("*").alias("n"), first.alias("a"), last.alias("b")
    )
    return grouped.select(
        "feature", "error_type", F.date_format("a", "yyyy-MM-dd").alias("first_seen"),
        F.date_format("b", "yyyy-MM-dd").alias("last_seen"),
        ag.frequency_label(ag.spread_days(F.col("a"), F.col("b")), F.col("n")).alias("frequency"),
        ag.severity(F.col("n")).alias("severity"),
    )


def _by_feature(spark, folder, *columns):
    ws = Workspace(spark)
    tickets = issues(spark, folder).select("feature", "seq", *columns)
    return ws.save(rank_in_group(ws, tickets, "feature", ["seq"]), "ranked")


@query("id_lists", f"""WITH {ISSUES}, r AS (SELECT feature, id, seq, row_number() OVER (PARTITION BY feature ORDER BY seq) - 1 AS rank FROM issues)
SELECT feature, CAST(rank // {ag.LIST_PART} AS BIGINT) AS part, string_agg(id, ', ' ORDER BY seq) AS ids FROM r GROUP BY feature, rank // {ag.LIST_PART}""")
def id_lists(spark, folder):
    parts = ag.list_parts(_by_feature(spark, folder, "id"), "feature", "id")
    return parts.select("feature", "part", F.col("id").alias("ids"))


@query("id_lists_in_parts", f"""WITH {ISSUES}, r AS (SELECT feature, id, seq, row_number() OVER (PARTITION BY feature ORDER BY seq) - 1 AS rank FROM issues)
SELECT feature, CAST(rank // 10 AS BIGINT) AS part, string_agg(id, ', ' ORDER BY seq) AS ids FROM r GROUP BY feature, rank // 10""")
def id_lists_in_parts(spark, folder):
    parts = ag.list_parts(_by_feature(spark, folder, "id"), "feature", "id", size=10)
    return parts.select("feature", "part", F.col("id").alias("ids"))


@query("first_five_ids", f"""WITH {ISSUES}, r AS (SELECT feature, id, seq, row_number() OVER (PARTITION BY feature ORDER BY seq) AS rn FROM issues)
SELECT feature, string_agg(id, ', ' ORDER BY seq) AS ids FROM r WHERE rn <= 5 GROUP BY feature""")
def first_five_ids(spark, folder):
    return ag.first_joined(_by_feature(spark, folder, "id"), "feature", "id", mo.EXAMPLES, "ids")


@query("distinct_labels", f"""WITH {ISSUES}, d AS (SELECT DISTINCT feature, error_type FROM issues)
SELECT feature, string_agg(error_type, ', ' ORDER BY error_type) AS error_type FROM d WHERE error_type NOT IN ('', 'nan') GROUP BY feature""")
def distinct_labels(spark, folder):
    return ag.distinct_sorted(issues(spark, folder), ["feature"], "error_type")


@query("head_of_joined_text", f"WITH {ISSUES} SELECT feature, left(string_agg({COMBINED}, chr(10) ORDER BY seq), 8000) AS context FROM issues GROUP BY feature")
def head_of_joined_text(spark, folder):
    ws = Workspace(spark)
    tickets = issues(spark, folder).select("feature", "seq", tx.combined_text().alias("combined"))
    ranked = ws.save(rank_in_group(ws, tickets, "feature", ["seq"]), "ranked")
    return ag.head_text(ranked, "feature", "combined", "context")


@query("joined_turns", "SELECT conv_id, left(string_agg(text, chr(10) ORDER BY turn), 8000) AS context FROM conversations GROUP BY conv_id")
def joined_turns(spark, folder):
    ws = Workspace(spark)
    ranked = ws.save(rank_in_group(ws, table(spark, folder, "conversations"), "conv_id", ["turn"]), "ranked")
    return ag.head_text(ranked, "conv_id", "text", "context")


@query("label_share", f"WITH {ISSUES} SELECT feature, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM issues GROUP BY feature")
def label_share(spark, folder):
    return ag.count_share(issues(spark, folder).groupBy("feature").agg(F.count("*").alias("n")), "feature")


_STOP = ", ".join(f"'{w}'" for w in tx.ENGLISH_STOP_WORDS)


def phrases_sql(source: str, key: str, text: str) -> str:
    return rf"""ws AS (SELECT {key}, list_filter(regexp_extract_all(lower({text}), '{TOKEN_SQL}'), lambda w: NOT list_contains([{_STOP}], w)) AS w FROM {source}),
ph AS (SELECT {key}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM ws),
phc AS (SELECT {key}, term, count(*) AS n, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, term) AS rn FROM ph GROUP BY {key}, term)"""


def phrase_crux_sql(key: str) -> str:
    joined = f"SELECT {key}, array_to_string((list(term ORDER BY term))[1:6], ' ') AS t FROM phc WHERE rn <= 8 GROUP BY {key}"
    return f"cruxes AS (SELECT {key}, {crux_sql('t')} AS phrase FROM ({joined}))"


@query("top_phrases", f"WITH {ISSUES}, {phrases_sql('issues', 'feature', COMBINED)} SELECT feature, term, n FROM phc WHERE rn <= 8")
def top_phrases(spark, folder):
    return kp.top_phrases(issues(spark, folder), "feature", tx.combined_text())


@query("phrase_crux", f"WITH {ISSUES}, {phrases_sql('issues', 'feature', COMBINED)}, {phrase_crux_sql('feature')} SELECT feature, phrase AS crux FROM cruxes")
def phrase_crux(spark, folder):
    return kp.phrase_crux(issues(spark, folder), "feature", tx.combined_text())


# ---- vectors and similarity ----------------------------------------------------------------------


@query("vocabulary", f"WITH {ISSUES}, {tfidf_sql(norm_sql(COMBINED))} SELECT term, CAST(c AS BIGINT) AS corpus_count, df FROM vocab")
def vocabulary(spark, folder):
    terms = vx.row_terms(Workspace(spark), issues(spark, folder), tx.normalize_text(tx.combined_text()))
    return vx.vocabulary(terms).select("term", "corpus_count", "df")


@query("tfidf_weights", f"""WITH {ISSUES}, {tfidf_sql(norm_sql(COMBINED))},
num AS (SELECT term, row_number() OVER (ORDER BY c DESC, term) - 1 AS idx FROM vocab)
SELECT seq, CAST(idx AS BIGINT) AS idx, round(w, 6) AS w FROM v JOIN num USING (term)""")
def tfidf_weights(spark, folder):
    vectors = vx.tfidf_vectors(Workspace(spark), issues(spark, folder), tx.normalize_text(tx.combined_text()))
    return vx.tfidf_long(vectors).select("seq", F.col("idx").cast("bigint").alias("idx"), F.round("w", 6).alias("w"))


@query("missing_vectors", "SELECT vec_id AS seq FROM embeddings WHERE label % 5 = 0")
def missing_vectors(spark, folder):
    rows = table(spark, folder, "embeddings")
    vectors = vx.given_vectors(Workspace(spark), rows.where("label % 5 <> 0"), "vec_id", "embedding", DENSE_WIDTH)
    return vx.missing_vectors(rows, vectors, "vec_id")


def _embeddings(ws, spark, folder):
    return vx.given_vectors(ws, table(spark, folder, "embeddings"), "vec_id", "embedding", DENSE_WIDTH)


@query("dense_similar_pairs", f"""WITH e AS (SELECT vec_id AS seq, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
SELECT a.seq AS l, b.seq AS r, round(list_cosine_similarity(a.x, b.x), 5) AS sim FROM e a, e b
WHERE a.seq < b.seq AND list_cosine_similarity(a.x, b.x) >= {DENSE_THRESHOLD}""")
def dense_similar_pairs(spark, folder):
    ws = Workspace(spark)
    rows = _embeddings(ws, spark, folder).withColumnRenamed("seq", "pos")
    return sm.cell_join(ws, rows, None, DENSE_THRESHOLD, DENSE_WIDTH).withColumn("sim", F.round("sim", 5))


@query("approximate_similar_pairs", f"""WITH e AS (SELECT vec_id AS seq, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS (SELECT a.seq AS l, b.seq AS r FROM e a, e b WHERE a.seq % 10 = 0 AND a.seq <> b.seq AND list_cosine_similarity(a.x, b.x) >= {DENSE_THRESHOLD})
SELECT count(DISTINCT (least(l, r), greatest(l, r))) AS pairs, TRUE AS enough FROM p""")
def approximate_similar_pairs(spark, folder):
    """Candidates by hyperplane signatures, held against the exact join for a tenth of the left rows: is recall at least 0.9?"""
    ws = Workspace(spark)
    rows = ws.save(_embeddings(ws, spark, folder).withColumnRenamed("seq", "pos"), "rows")
    found = ws.save(hy.approximate_pairs(ws, rows, DENSE_THRESHOLD, DENSE_WIDTH), "found")
    return hy.recall(ws, rows, found, DENSE_THRESHOLD, DENSE_WIDTH).select("pairs", (F.col("recall") >= 0.9).alias("enough"))


@query("sparse_similar_pairs", f"""WITH {ISSUES}, {tfidf_sql(norm_sql(COMBINED))},
f AS (SELECT min(seq) AS seq FROM (SELECT seq, list(term || ':' || round(w, 9) ORDER BY term) AS k FROM v GROUP BY seq) GROUP BY k)
SELECT a.seq AS l, b.seq AS r, round(sum(a.w * b.w), 5) AS sim FROM v a JOIN v b USING (term)
WHERE a.seq < b.seq AND a.seq IN (SELECT seq FROM f) AND b.seq IN (SELECT seq FROM f)
GROUP BY a.seq, b.seq HAVING sum(a.w * b.w) >= {cl.TEXT_THRESHOLD}""")
def sparse_similar_pairs(spark, folder):
    """Pairs of distinct vectors; copies are folded into their first ticket."""
    ws = Workspace(spark)
    vectors = vx.tfidf_vectors(ws, issues(spark, folder), tx.without_addresses(tx.combined_text()))
    rows = vx.distinct_vectors(ws, vx.with_vector_key(vectors)).withColumnRenamed("seq", "pos")
    return sm.term_join(ws, rows, None, cl.TEXT_THRESHOLD).withColumn("sim", F.round("sim", 5))


# ---- clusters ------------------------------------------------------------------------------------


@query("embedding_clusters", f"WITH RECURSIVE {DENSE_PAIRS.format(t=DENSE_THRESHOLD)}, {leaders_sql('e')} SELECT seq, coalesce(cluster_id, -1) AS cluster_id FROM ids")
def embedding_clusters(spark, folder):
    ws = Workspace(spark)
    return shown(ld.leader_clusters(ws, _embeddings(ws, spark, folder), DENSE_THRESHOLD, DENSE_WIDTH))


@query("daily_clusters", DAILY + " SELECT seq, id, coalesce(cluster_id, -1) AS cluster_id FROM clustered")
def daily_clusters(spark, folder):
    _, clustered = daily(spark, folder)
    return shown(clustered.select("seq", "id", "cluster_id"))


@query("file_clusters", FILE + " SELECT seq, combined, coalesce(cluster_id, -1) AS cluster_id FROM clustered")
def file_clusters(spark, folder):
    _, clustered = by_file(spark, folder)
    return shown(clustered.select("seq", "combined", "cluster_id"))


@query("inverted_index_clusters", FILE + " SELECT seq, coalesce(cluster_id, -1) AS cluster_id FROM clustered")
def inverted_index_clusters(spark, folder):
    """The same clusters without a bound on the vectors' width: rows meet in an inverted index, whose frequent terms are split."""
    ws = Workspace(spark)
    return shown(cl.file_clusters(ws, issues(spark, folder), width=None).select("seq", "cluster_id"))


@query("cluster_count", FILE + " SELECT (SELECT count(*) FROM led) AS clusters")
def cluster_count(spark, folder):
    ws = Workspace(spark)
    vectors = vx.tfidf_vectors(ws, issues(spark, folder), tx.combined_text())
    folded = vx.distinct_vectors(ws, vectors.transform(vx.with_vector_key))
    placed = ws.save(with_position(ws, folded, ["seq"]), "rows").select("pos", "idx", "val")
    leaders, _, _ = ld.find_leaders(ws, placed, ld.dense_near(ws, cl.FILE_THRESHOLD, vx.MAX_FEATURES))
    leaders = placed.select("pos").limit(0) if leaders is None else leaders.select("pos")
    alone = vectors.where(F.size("idx") == 0).select(F.col("seq").alias("pos"))
    return leaders.unionByName(alone).agg(F.count("*").alias("clusters"))


@query("guarded_singletons", "SELECT event_id AS seq, row_number() OVER (ORDER BY event_id) - 1 AS cluster_id FROM events")
def guarded_singletons(spark, folder):
    """All texts alike: the guard makes every row its own cluster."""
    ws = Workspace(spark)
    rows = table(spark, folder, "events").select(F.col("event_id").alias("seq"), F.lit("same text").alias("t"))
    return ld.leader_clusters(ws, vx.tfidf_vectors(ws, rows, "t"), cl.TEXT_THRESHOLD)


DAILY_PARTS = f"""{mode_sql('clustered', 'cluster_id', 'feature', 'mf')}, {mode_sql('clustered', 'cluster_id', 'error_type', 'me')},
{mode_sql('clustered', 'cluster_id', 'status', 'ms')},
nt AS (SELECT cluster_id, 'Grouped similar incidents. Representative notes: ' || left(string_agg(summary, ' ' ORDER BY seq), 240) || '...' AS recurring_summary
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY seq) AS rn FROM clustered) WHERE rn <= 3 GROUP BY cluster_id),
gs AS (SELECT cluster_id, count(*) AS total_tickets, coalesce({day('min(completion_date)')}, '') AS create_date
  FROM clustered WHERE cluster_id IS NOT NULL GROUP BY cluster_id)"""


def parts_sql(size: int, ids: str) -> str:
    """CTE with the id lists of clusters in parts."""
    return f"""il AS (SELECT cluster_id, CAST(rank // {size} AS BIGINT) AS part, string_agg(id, ', ' ORDER BY seq) AS {ids}
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY seq) - 1 AS rank FROM clustered WHERE cluster_id IS NOT NULL) GROUP BY cluster_id, rank // {size})"""


def daily_sql(size: int) -> str:
    return DAILY + f""", {DAILY_PARTS}, {parts_sql(size, 'example_ids')}, {phrases_sql('clustered', 'cluster_id', 'combined')}, {phrase_crux_sql('cluster_id')}
SELECT cluster_id, recurring_summary, coalesce(phrase, '{tx.NO_CRUX_TITLE}') AS crux, feature, error_type, total_tickets, example_ids, status, create_date, part
FROM gs JOIN il USING (cluster_id) JOIN nt USING (cluster_id) JOIN mf USING (cluster_id) JOIN me USING (cluster_id) JOIN ms USING (cluster_id) LEFT JOIN cruxes USING (cluster_id)"""


@query("daily_report", daily_sql(ag.LIST_PART))
def daily_report(spark, folder):
    ws, clustered = daily(spark, folder)
    return cl.daily_report(ws, clustered)


@query("daily_report_in_parts", daily_sql(10))
def daily_report_in_parts(spark, folder):
    ws, clustered = daily(spark, folder)
    return cl.daily_report(ws, clustered, list_part=10)


@query("board_report", DAILY + f""", {DAILY_PARTS}, {parts_sql(ag.LIST_PART, 'example_ids')}
SELECT cluster_id, recurring_summary, '{tx.NO_CRUX_TITLE}' AS crux, feature, error_type, total_tickets, example_ids, status, part
FROM gs JOIN il USING (cluster_id) JOIN nt USING (cluster_id) JOIN mf USING (cluster_id) JOIN me USING (cluster_id) JOIN ms USING (cluster_id)""")
def board_report(spark, folder):
    ws, clustered = daily(spark, folder)
    return cl.board_report(ws, clustered)


@query("pattern_report", FILE + f""", {parts_sql(ag.LIST_PART, 'tickets')}, g AS (SELECT cluster_id, count(*) AS n, least(min(created), min(updated)) AS a, greatest(max(created), max(updated)) AS b, arg_min(combined, seq) AS opening
  FROM clustered WHERE cluster_id IS NOT NULL GROUP BY cluster_id),
df AS (SELECT cluster_id, string_agg(feature, ', ' ORDER BY feature) AS features_impacted FROM (SELECT DISTINCT cluster_id, feature FROM clustered) GROUP BY cluster_id),
de AS (SELECT cluster_id, string_agg(error_type, ', ' ORDER BY error_type) AS error_types FROM (SELECT DISTINCT cluster_id, error_type FROM clustered) GROUP BY cluster_id)
SELECT cluster_id, 'Repeated issue pattern: ' || left(opening, 120) || '...' AS pattern_summary, '{pr.DETAILED_FALLBACK}' AS detailed_summary,
  '{pr.CAUSE_FALLBACK}' AS root_cause, '{pr.ADVICE_FALLBACK}' AS recommendation, n AS ticket_count, tickets, features_impacted, error_types,
  {day('a')} AS first_seen, {day('b')} AS last_seen, (greatest(0, (epoch_us(b) - epoch_us(a)) // 86400000000)) || 'd + ' || n AS frequency,
  CASE WHEN n >= 5 THEN 'High' WHEN n >= 3 THEN 'Medium' ELSE 'Low' END AS severity, part
FROM g JOIN il USING (cluster_id) JOIN df USING (cluster_id) JOIN de USING (cluster_id)""")
def pattern_report(spark, folder):
    ws, clustered = by_file(spark, folder)
    return cl.pattern_report(ws, clustered)


@query("short_patterns", FILE + """ SELECT coalesce(cluster_id, -1) AS cluster_id, 'Repeated issue pattern: ' || left(arg_min(combined, seq), 120) || '...' AS summary,
  count(*) AS count FROM clustered GROUP BY cluster_id""")
def short_patterns(spark, folder):
    ws, clustered = by_file(spark, folder)
    return shown(cl.short_patterns(ws, clustered))


@query("ticket_list_parts", DAILY + """ SELECT cluster_id, CAST(0 AS BIGINT) AS part, string_agg(id, ', ' ORDER BY seq) AS ids FROM clustered WHERE cluster_id IS NOT NULL GROUP BY cluster_id""")
def ticket_list_parts(spark, folder):
    ws, clustered = daily(spark, folder)
    return cl.ticket_list_parts(ws, clustered)


@query("joined_text_parts", FILE + """, r AS (SELECT cluster_id, combined, seq, row_number() OVER (PARTITION BY cluster_id ORDER BY seq) - 1 AS rank FROM clustered WHERE cluster_id IS NOT NULL)
SELECT cluster_id, CAST(rank // 200 AS BIGINT) AS part, string_agg(combined, chr(10) || chr(10) ORDER BY seq) AS combined FROM r GROUP BY cluster_id, rank // 200""")
def joined_text_parts(spark, folder):
    ws, clustered = by_file(spark, folder)
    return cl.text_parts(ws, clustered, sep="\n\n")


COMBINED_LABELS = "summary || ' ' || description || ' ' || feature || ' ' || error_type"


def monthly_sql(only: str = "true") -> str:
    """CTEs to ``clustered``: average linkage by months as rounds of mutual nearest neighbours, with mean distances from all pairs of tickets."""
    every = ISSUES.replace("issues AS (", "everything AS (", 1)
    return f"""WITH RECURSIVE {every},
issues AS MATERIALIZED (SELECT *, {COMBINED_LABELS} AS combined, coalesce(completion_date, updated) AS completed,
  date_trunc('month', coalesce(completion_date, updated)) AS month_start FROM everything WHERE {only}),
{tfidf_sql(norm_sql('combined'))},
keys AS (SELECT seq, list(term || ':' || round(w, 9) ORDER BY term) AS k FROM v GROUP BY seq),
start AS MATERIALIZED (SELECT i.seq, month_start, CASE WHEN k IS NULL THEN i.seq ELSE min(i.seq) OVER (PARTITION BY month_start, k) END AS root
  FROM issues i LEFT JOIN keys USING (seq)),
mv AS MATERIALIZED (SELECT v.*, month_start FROM v JOIN issues USING (seq)),
sims AS MATERIALIZED (SELECT a.seq AS l, b.seq AS r, sum(a.w * b.w) AS s FROM mv a JOIN mv b ON a.term = b.term AND a.month_start = b.month_start
  WHERE a.seq <> b.seq GROUP BY a.seq, b.seq),
rounds(it, seq, month_start, root) AS (SELECT 0, seq, month_start, root FROM start UNION ALL (
  WITH sized AS (SELECT root, count(*) AS n FROM rounds GROUP BY root),
  total AS (SELECT x.root AS a, y.root AS b, sum(s) AS s FROM sims JOIN rounds x ON x.seq = l JOIN rounds y ON y.seq = r WHERE x.root <> y.root GROUP BY x.root, y.root),
  mean AS (SELECT a, b, round(s / (p.n * q.n), 12) AS m FROM total JOIN sized p ON p.root = a JOIN sized q ON q.root = b),
  best AS (SELECT a, b FROM mean WHERE m > {1 - lk.CUT} QUALIFY row_number() OVER (PARTITION BY a ORDER BY m DESC, b) = 1),
  merges AS (SELECT x.a AS keep, x.b AS gone FROM best x JOIN best y ON x.a = y.b AND x.b = y.a WHERE x.a < x.b)
  SELECT it + 1, seq, month_start, coalesce(keep, root) FROM rounds LEFT JOIN merges ON gone = root WHERE EXISTS (SELECT 1 FROM merges))),
clustered AS MATERIALIZED (SELECT i.*, strftime(i.month_start, '%b-%Y') AS cluster_month,
  dense_rank() OVER (PARTITION BY i.month_start ORDER BY root) - 1 AS cluster_id
  FROM issues i JOIN rounds USING (seq) WHERE it = (SELECT max(it) FROM rounds))"""


def monthly_report_sql(only: str = "true") -> str:
    """CTEs to ``report``."""
    modes = ",\n".join(mode_sql("named", "k", field, f"m_{field}") for field in ("feature", "error_type", "status"))
    return f"""{monthly_sql(only)},
named AS (SELECT *, cluster_month || '/' || cluster_id AS k, row_number() OVER (PARTITION BY month_start, cluster_id ORDER BY seq) AS rn FROM clustered),
{modes},
told AS (SELECT k, 'Grouped similar incidents. Representative notes: ' || left(string_agg(summary, ' ' ORDER BY seq), {pr.NOTE_LENGTH}) || '...' AS recurring_summary FROM named WHERE rn <= 3 GROUP BY k),
listed AS (SELECT k, string_agg(id, ', ' ORDER BY seq) AS example_ids FROM named WHERE rn <= {mo.EXAMPLES} GROUP BY k),
report AS (SELECT cluster_month, month_start, cluster_id, recurring_summary, '{tx.NO_CRUX_TITLE}' AS crux, m_feature.feature, m_error_type.error_type, total_tickets, example_ids,
  m_status.status, '{pr.SEE_SUMMARY}' AS resolution_suggestion, create_date
FROM (SELECT k, cluster_month, month_start, cluster_id, count(*) AS total_tickets, {day('min(completed)')} AS create_date FROM named GROUP BY ALL)
JOIN told USING (k) JOIN listed USING (k) JOIN m_feature USING (k) JOIN m_error_type USING (k) JOIN m_status USING (k))"""


def _monthly(spark, folder):
    ws = Workspace(spark)
    tickets = issues(spark, folder)
    from ticketmill.sources.issues import completion_or_updated

    dated = mo.with_month(tickets.withColumn("completion_date", completion_or_updated("completion_date", "updated")))
    return ws, ws.save(mo.monthly_clusters(ws, dated), "monthly")


@query("monthly_clusters", monthly_sql() + " SELECT cluster_month, seq, cluster_id FROM clustered")
def monthly_clusters(spark, folder):
    _, clustered = _monthly(spark, folder)
    return clustered.select("cluster_month", "seq", "cluster_id")


@query("monthly_report", monthly_report_sql() + " SELECT * EXCLUDE (month_start) FROM report")
def monthly_report(spark, folder):
    ws, clustered = _monthly(spark, folder)
    return mo.monthly_report(ws, clustered).drop("month_start")


def tracks_sql(match: float) -> str:
    """CTEs from ``members`` (period, grp, seq) and unit weights ``mw`` (seq, term, w) to ``tracks`` (period, grp, n, first_period, first_group)."""
    side = lambda own, other: f"(SELECT a, b FROM near QUALIFY row_number() OVER (PARTITION BY {own} ORDER BY s DESC, {other}) = 1)"
    return f"""cent AS (SELECT period, grp, term, sum(w) AS w FROM members JOIN mw USING (seq) GROUP BY ALL),
groups AS MATERIALIZED (SELECT period, grp, count(*) AS n, row_number() OVER (ORDER BY period, grp) AS pos, dense_rank() OVER (ORDER BY period) AS number FROM members GROUP BY period, grp),
unit AS MATERIALIZED (SELECT pos, number, term, w / sqrt(sum(w * w) OVER (PARTITION BY pos)) AS w FROM cent JOIN groups USING (period, grp) WHERE w <> 0),
near AS MATERIALIZED (SELECT x.pos AS a, y.pos AS b, round(sum(x.w * y.w), 12) AS s FROM unit x JOIN unit y ON x.term = y.term AND y.number = x.number + 1
  GROUP BY x.pos, y.pos HAVING round(sum(x.w * y.w), 12) > {match}),
links AS MATERIALIZED (SELECT a, b FROM {side('a', 'b')} JOIN {side('b', 'a')} USING (a, b)),
chain(pos, head) AS (SELECT pos, pos FROM groups WHERE pos NOT IN (SELECT b FROM links) UNION ALL SELECT b, head FROM chain JOIN links ON a = chain.pos),
tracks AS MATERIALIZED (SELECT g.period, g.grp, g.n, f.period AS first_period, f.grp AS first_group FROM chain JOIN groups g ON g.pos = chain.pos JOIN groups f ON f.pos = head)"""


VECTOR_MATCH = 0.1  # the supplied vectors are drawn at random, so no two means are near each other


@query("tracked_vector_groups", f"""WITH RECURSIVE e AS (SELECT vec_id AS seq, vec_id % 6 AS period, label AS grp, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
members AS (SELECT seq, period, grp FROM e),
mw AS (SELECT seq, unnest(range(len(x))) AS term, unnest(list_transform(x, lambda z: z / sqrt(list_dot_product(x, x)))) AS w FROM e),
{tracks_sql(VECTOR_MATCH)} SELECT period, grp, n, first_period, first_group FROM tracks""")
def tracked_vector_groups(spark, folder):
    """The labels' groups in six periods, each matched with the next period's."""
    ws = Workspace(spark)
    members = table(spark, folder, "embeddings").select(F.col("vec_id").alias("seq"), (F.col("vec_id") % 6).alias("period"), F.col("label").alias("group"))
    groups = tr.centroids(ws, members, _embeddings(ws, spark, folder))
    return tr.track_groups(ws, groups, DENSE_WIDTH, VECTOR_MATCH).withColumnRenamed("group", "grp")


TRACKED = f"""{monthly_sql()},
members AS (SELECT month_start AS period, cluster_id AS grp, seq FROM clustered), mw AS (SELECT seq, term, w FROM v),
{tracks_sql(tr.MATCH)},
named_tracks AS (SELECT period AS month_start, grp AS cluster_id, strftime(first_period, '%b-%Y') || '/' || first_group AS track_id FROM tracks)"""


def _tracked(spark, folder):
    ws = Workspace(spark)
    dated = ws.save(mo.with_month(issues(spark, folder).withColumn("completion_date", src.completion_or_updated("completion_date", "updated"))), "dated")
    vectors = mo.monthly_vectors(ws, dated)
    clustered = ws.save(mo.monthly_clusters(ws, dated, vectors), "monthly")
    return ws, clustered, ws.save(mo.tracked_clusters(ws, mo.month_centroids(ws, clustered, vectors)), "tracks")


@query("tracked_clusters", f"{TRACKED} SELECT {day('month_start')} AS month_start, cluster_id, track_id FROM named_tracks")
def tracked_clusters(spark, folder):
    """Monthly clusters of tickets with a key that outlives the month."""
    _, _, tracks = _tracked(spark, folder)
    return tracks.withColumn("month_start", month_text("month_start"))


@query("tracked_recurrence", f"""{TRACKED},
sized AS (SELECT month_start, cluster_id, count(*) AS total_tickets, min(feature) AS feature, min(error_type) AS root_cause FROM clustered GROUP BY month_start, cluster_id),
g AS (SELECT track_id, arg_min(feature, month_start) AS feature, arg_min(root_cause, month_start) AS recurring_summary, CAST(sum(total_tickets) AS BIGINT) AS ticket_count,
  min(month_start) AS a, max(month_start) AS b, count(DISTINCT month_start) AS frequency FROM sized JOIN named_tracks USING (month_start, cluster_id) GROUP BY track_id)
SELECT track_id, feature, recurring_summary, ticket_count, {day('a')} AS first_seen, {day('b')} AS last_seen, frequency,
  CASE WHEN frequency > 2 THEN 'Chronic' WHEN frequency = 2 THEN 'Reappeared' ELSE 'Fixed' END AS status FROM g""")
def tracked_recurrence(spark, folder):
    """The recurrence tracker by that key."""
    _, clustered, tracks = _tracked(spark, folder)
    key = ["month_start", "cluster_id"]
    sized = clustered.groupBy(*key).agg(F.count("*").alias("total_tickets"), F.min("feature").alias("feature"), F.min("error_type").alias("root_cause"))
    tracker = ma.recurrence_tracker(sized.join(tracks, key), "track_id")
    return tracker.withColumns({c: month_text(c) for c in ("first_seen", "last_seen")})


RUN = FILE.replace("d.doc_id AS seq,", "row_number() OVER (ORDER BY d.doc_id DESC) - 1 AS seq,")


@query("file_run", RUN + f""" SELECT cluster_id, count(*) AS ticket_count, string_agg(id, ', ' ORDER BY seq) AS tickets,
  'Repeated issue pattern: ' || left(arg_min(combined, seq), {pr.SAMPLE_LENGTH}) || '...' AS pattern_summary
FROM clustered WHERE cluster_id IS NOT NULL GROUP BY cluster_id""")
def file_run(spark, folder):
    """CSV to CSV: tickets are numbered from the newest, clustered, and summed up in the pattern table."""
    ws = Workspace(spark)
    source = ws.path("issues-csv")
    sinks.write_csv(issues(spark, folder).select(*src.ISSUE_COLUMNS), source)
    paths = runs.run_files(ws, source, ws.path("out"))
    patterns = src.read_csv(spark, paths["patterns"], required=("cluster_id", "ticket_count", "tickets", "pattern_summary"))
    return patterns.select(F.col("cluster_id").cast("long"), F.col("ticket_count").cast("long"), "tickets", "pattern_summary")


def _stand_in(frame: pd.DataFrame) -> pd.DataFrame:
    """A model whose replies follow from the length of what it is asked."""
    asked = frame["prompt"].str.len()
    label = '{{"feature": "F{}", "error_type": "E{}"}}'.format
    is_label = frame["prompt"].str.startswith(pr.LABEL_PROMPT)
    return pd.DataFrame({"reply": [label(n % 3, n % 2) if x else f"Gist {n}" for n, x in zip(asked, is_label)]})


MODELS = runs.Models(labels=_stand_in, texts=_stand_in)
LABEL_CHARACTERS = f"({len(pr.LABEL_PROMPT) + len(chr(10) * 2 + 'Text:' + chr(10))} + length(left({COMBINED}, {pr.LABEL_TEXT_LENGTH})))"


def run_sql(only: str, context: str) -> str:
    """CTEs of a run with the stand-in model to its reports' parts; ``context`` is what the model sees of a cluster."""
    every = ISSUES.replace("issues AS (", "everything AS (", 1)
    return f"""WITH RECURSIVE {every},
issues AS MATERIALIZED (SELECT * REPLACE (row_number() OVER (ORDER BY created DESC, id) - 1 AS seq, coalesce(completion_date, updated) AS completion_date)
  FROM everything WHERE {only}),
{tfidf_sql(norm_sql(COMBINED))}, {SPARSE_PAIRS.format(t=cl.TEXT_THRESHOLD)}, {leaders_sql('issues')},
clustered AS MATERIALIZED (SELECT i.* REPLACE ('F' || ({LABEL_CHARACTERS} % 3) AS feature, 'E' || ({LABEL_CHARACTERS} % 2) AS error_type), {COMBINED} AS combined, cluster_id
  FROM issues i JOIN ids USING (seq)),
{mode_sql('clustered', 'cluster_id', 'feature', 'mf')}, {mode_sql('clustered', 'cluster_id', 'error_type', 'me')}, {mode_sql('clustered', 'cluster_id', 'status', 'ms')},
{parts_sql(ag.LIST_PART, 'example_ids')},
told AS (SELECT cluster_id, 'Gist ' || ({len(pr.SUMMARY_PROMPT)} + length({context})) AS recurring_summary, count(*) AS total_tickets, {day('min(completion_date)')} AS create_date
  FROM clustered WHERE cluster_id IS NOT NULL GROUP BY cluster_id),
report AS (SELECT cluster_id, recurring_summary, 'Gist ' || ({len(pr.CRUX_PROMPT)} + length(recurring_summary)) AS crux, feature, error_type, total_tickets, example_ids, status, create_date, part
  FROM told JOIN il USING (cluster_id) JOIN mf USING (cluster_id) JOIN me USING (cluster_id) JOIN ms USING (cluster_id))"""


ALL_TEXT = "string_agg(combined, chr(10) ORDER BY seq)"
RECENT = "created >= TIMESTAMP '2024-02-01' - to_days(15)"


@query("daily_run", run_sql(RECENT, f"left({ALL_TEXT}, {pr.CLUSTER_TEXT_LENGTH})") + " SELECT * REPLACE (lower(crux) AS crux) FROM report")
def daily_run(spark, folder):
    """Recent tickets, labelled and told by a stand-in model, to the stored report: all its columns."""
    ws = Workspace(spark)
    return runs.run_daily(ws, issues(spark, folder), F.lit("2024-02-01").cast("timestamp"), ws.path("report"), days=15, models=MODELS)


@query("board_run", run_sql("true", ALL_TEXT) + " SELECT * EXCLUDE (create_date) FROM report")
def board_run(spark, folder):
    """All tickets of a board to its report; the model sees whole clusters."""
    ws = Workspace(spark)
    return runs.run_board(ws, issues(spark, folder), ws.path("report"), MODELS)


@query("exported_tickets", run_sql(RECENT, "''") + " SELECT coalesce(cluster_id, -1) AS cluster_id, id, summary, feature, error_type FROM clustered")
def exported_tickets(spark, folder):
    """The ticket-level CSV of the daily run, read back."""
    ws = Workspace(spark)
    path = ws.path("tickets-csv")
    runs.run_daily(ws, issues(spark, folder), F.lit("2024-02-01").cast("timestamp"), ws.path("report"), days=15, models=MODELS, export=path)
    rows = src.read_csv(spark, path, required=("cluster_id", "id", "combined"))
    return rows.select(F.coalesce(F.col("cluster_id").cast("long"), F.lit(-1)).alias("cluster_id"), "id", F.coalesce("summary", F.lit("")).alias("summary"), "feature", "error_type")


def _first_listed(field: str) -> str:
    return f"""(SELECT month_start, {field} FROM report GROUP BY month_start, {field}
  QUALIFY row_number() OVER (PARTITION BY month_start ORDER BY count(*) DESC, min(cluster_id)) = 1)"""


LAST_MONTHS = "coalesce(completion_date, updated) >= TIMESTAMP '2024-01-01' AND coalesce(completion_date, updated) < TIMESTAMP '2024-04-01'"


@query("monthly_run_summary", f"""{monthly_report_sql(LAST_MONTHS)}
SELECT any_value(cluster_month) AS month, count(*) AS total_clusters, CAST(sum(total_tickets) AS BIGINT) AS total_tickets, any_value(f.feature) AS top_feature,
  any_value(c.recurring_summary) AS top_root_cause, round(avg(date_diff('day', CAST(create_date AS DATE), DATE '2024-03-10')), 1) AS avg_ticket_age
FROM report r JOIN {_first_listed('feature')} f ON f.month_start = r.month_start JOIN {_first_listed('recurring_summary')} c ON c.month_start = r.month_start
GROUP BY r.month_start""")
def monthly_run_summary(spark, folder):
    ws = Workspace(spark)
    tickets = issues(spark, folder)
    _, summary = runs.run_monthly(ws, tickets, F.lit("2024-03-10").cast("timestamp"), ws.path("months"))
    return summary.drop("month_start")
