"""The named queries of this package over the supplied tables, with the oracle's SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketmill.llm import bitpack, bpe, chat, collocations, decontaminate, jaccard, licences, mainhtml, periodic, tokencount, toxicity, voronoi, warc
from ticketmill.session import Workspace

try:
    from public_tokenizers import path as tokenizer_path
except ImportError:  # elsewhere, name the vocabulary files' folder

    def tokenizer_path(name: str) -> str:
        return f"/opt/tokenizers/{name}"


QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op3_preference_pairs", chat.preference_sql())
def preference_pairs(spark, folder):
    """Every conversation against the same one with its last reply cut to the first line."""
    talks = chat.gather(table(spark, folder, "conversations"))
    pairs = talks.select("pair_id", F.col("turns").alias("chosen"), chat.cut_last_reply(F.col("turns")).alias("rejected"))
    return chat.preference_rows(pairs)


@query("op5_licence_rules", licences.licence_sql())
def licence_rules(spark, folder):
    return licences.licence_matches(table(spark, folder, "documents"))


@query("op7_ngram_jaccard")
def ngram_jaccard(spark, folder):
    return jaccard.linked_groups(Workspace(spark), table(spark, folder, "documents"), k=4, num=85, den=100)


@query("op9_toxicity_grades")
def toxicity_grades(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(spark, docs, table(spark, folder, "labels")))


@query("op1_template_leaks")
def template_leaks(spark, folder):
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_bpe_round_trip")
def bpe_round_trip(spark, folder):
    return bpe.digests(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op4_packed_tokens")
def packed_tokens(spark, folder):
    manifest = bitpack.write_tokens(
        Workspace(spark), table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, vocabulary=50_257
    )
    return bitpack.read_index(manifest)


@query("op2_seekable_archives", warc.archive_sql())
def seekable_archives(spark, folder):
    manifest = warc.write_archives(Workspace(spark), table(spark, folder, "pages"))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_voronoi_top_k", voronoi.top_k_sql())
def voronoi_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return voronoi.top_k(Workspace(spark), vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query("op10_minimum_cut_text", mainhtml.article_sql())
def minimum_cut_text(spark, folder):
    return mainhtml.extract(table(spark, folder, "pages"))


@query("op11_whole_token_counts")
def whole_token_counts(spark, folder):
    return tokencount.token_counts(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op12_periodic_runs")
def periodic_runs(spark, folder):
    return periodic.run_rows(table(spark, folder, "documents"), change=periodic.repeated_tail)


@query("op13_collocations", collocations.collocation_sql())
def phrase_collocations(spark, folder):
    ws = Workspace(spark)
    return collocations.collocations(ws, collocations.frequent_ngrams(ws, table(spark, folder, "documents")))
