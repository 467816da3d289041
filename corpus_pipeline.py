"""From raw documents to token ids: toxic texts go, one of each group of near copies stays, texts with benchmark items go.

``STAGES`` lists the stages in their order. Each takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import bpe, decontaminate, jaccard, toxicity
from ticketmill.llm.queries import tokenizer_path
from ticketmill.session import Workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(spark, docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8, the document with the smallest id.

    Documents without words or without an id are in no group and stay.
    """
    groups = jaccard.linked_groups(Workspace(spark), docs, k=5, num=4, den=5)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, also not with other numbers, units or names. Those without an id stay."""
    found = decontaminate.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids) of what is left."""
    return bpe.encode_texts(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

# the stages cannot be written in SQL; tests hold them against brute force
ORACLE_SQL = None


# rows of whole texts that go to a Python worker at once; the usual 10,000 take room in the JVM and in the worker
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_000


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    usual = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(BATCH_ROWS))
    try:
        for name, stage in STAGES:
            docs = ws.save(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(BATCH, usual)
    return docs
