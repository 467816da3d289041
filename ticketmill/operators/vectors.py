"""Ticket vectors: TF-IDF over a bounded vocabulary, or vectors that come with the data.

A vector table has ``seq`` (unique row order), ``idx`` (ascending term numbers) and ``val`` (weights of
a unit vector). Rows without a single term have empty arrays: the zero vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions import text as tx
from ticketmill.session import Workspace

MAX_FEATURES = 1024
# rows whose words go to a Python worker at once; the usual 10,000 take room in the JVM and, several times over, in the worker
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seq, words) to the distinct words of each row with their counts."""
    for batch in batches:
        held = batch.column("words")
        row = np.repeat(np.arange(batch.num_rows), held.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        coded = held.flatten().dictionary_encode()
        kinds = max(1, len(coded.dictionary))
        found, n = np.unique(row * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        terms = [coded.dictionary.take(pa.array(found % kinds)).cast(pa.string()), pa.array(n, pa.int32())]
        offsets = pa.array(np.searchsorted(found, np.arange(batch.num_rows + 1) * kinds), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(terms, names=["term", "n"]))
        yield pa.RecordBatch.from_arrays([batch.column("seq"), lists], names=["seq", "terms"])


@contextmanager
def _few_rows(ws: Workspace) -> Iterator[None]:
    """Words go to the Python workers some rows at a time."""
    usual = ws.spark.conf.get(BATCH)
    ws.spark.conf.set(BATCH, str(min(int(usual), BATCH_ROWS) if int(usual) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        ws.spark.conf.set(BATCH, usual)


def row_terms(ws: Workspace, df: DataFrame, text: str | Column, seq: str = "seq") -> DataFrame:
    """The distinct words of each row with their counts: (seq, terms).

    Counting happens inside the row, so no shuffle is needed to group a ticket's words. The result is
    written once, since the vocabulary and the weights both read it and splitting text is the dear part.
    """
    words = df.select(F.col(seq).alias("seq"), tx.tokens(text).alias("words"))
    schema = f"seq {dict(words.dtypes)['seq']}, terms array<struct<term:string,n:int>>"
    with _few_rows(ws):
        return ws.save(words.mapInArrow(_count_words, schema), "terms")


def vocabulary(terms: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms: ``idx`` (0 = most frequent), corpus count and document frequency.

    Ties are cut by term. The result has at most ``max_features`` rows.
    """
    counted = (
        terms.select(F.explode("terms").alias("t"))
        .select("t.term", "t.n")
        .groupBy("term")
        .agg(F.sum("n").alias("corpus_count"), F.count("*").alias("df"))
    )
    top = counted.orderBy(F.desc("corpus_count"), F.asc("term")).limit(max_features)
    by_count = Window.orderBy(F.desc("corpus_count"), F.asc("term"))
    return top.withColumn("idx", F.row_number().over(by_count) - 1)


def _unit(entries: Column) -> tuple[Column, Column]:
    """Term numbers, and weights divided by the vector's length."""

    def scaled(norm: Column) -> Column:
        return F.transform(entries, lambda e: e["w"] / norm)

    norm = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda s, e: s + e["w"] * e["w"]))
    # one-element transform: the length is found once per row, not once per weight
    return F.transform(entries, lambda e: e["idx"]), F.flatten(F.transform(F.array(norm), scaled))


def _weigh(terms: list[str], idf: list[float]):
    """(seq, terms) to unit vectors: a batch's words are looked up in the vocabulary at once, nothing leaves its row."""

    def run(batches):
        names, weight = pa.array(terms, pa.string()), np.array(idf, float)
        for batch in batches:
            rows = batch.num_rows
            held = batch.column("terms")
            row = np.repeat(np.arange(rows), held.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            entries = held.flatten()
            at = pc.index_in(entries.field("term").cast(pa.string()), value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
            known = np.flatnonzero(at >= 0)
            known = known[np.lexsort((at[known], row[known]))]
            row, at = row[known], at[known]
            w = entries.field("n").to_numpy(zero_copy_only=False)[known] * weight[at]
            w = w / np.sqrt(np.bincount(row, w * w, minlength=rows))[row]
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=rows))], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (pa.array(at, pa.int32()), pa.array(w, pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("seq"), *lists], names=["seq", "idx", "val"])

    return run


def tfidf_vectors(
    ws: Workspace, df: DataFrame, text: str | Column, seq: str = "seq", max_features: int = MAX_FEATURES
) -> DataFrame:
    """Unit TF-IDF vectors with idf = ln((1 + rows) / (1 + df)) + 1.

    Only the counting of the vocabulary shuffles. Its at most ``max_features`` terms go to the tasks, which number and
    weigh the words inside each row.
    """
    terms = row_terms(ws, df, text, seq)
    vocab = vocabulary(terms, max_features).orderBy("idx").collect()  # at most max_features rows
    rows = terms.count()
    weigh = _weigh([v["term"] for v in vocab], [math.log((rows + 1) / (v["df"] + 1)) + 1 for v in vocab])
    schema = f"seq {dict(terms.dtypes)['seq']}, idx array<int>, val array<double>"
    with _few_rows(ws):
        return ws.save(terms.select("seq", "terms").mapInArrow(weigh, schema), "vectors")


def tfidf_long(vectors: DataFrame) -> DataFrame:
    """One row per (seq, idx) with its weight."""
    return vectors.select("seq", F.explode(F.arrays_zip("idx", "val")).alias("e")).select(
        "seq", F.col("e.idx").alias("idx"), F.col("e.val").alias("w")
    )


def given_vectors(ws: Workspace, df: DataFrame, seq: str, vector: str, size: int | None = None) -> DataFrame:
    """Unit vectors from an array column; a wrong dimension is an error, never a silent zero."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    if size is not None:
        values = F.when(F.size(values) == size, values).otherwise(
            F.raise_error(F.concat(F.lit(f"vector of {size} numbers expected at "), F.col(seq).cast("string")))
        )
    entries = F.filter(
        F.transform(values, lambda x, i: F.struct(i.alias("idx"), x.alias("w"))), lambda e: e["w"] != 0
    )
    idx, val = _unit(F.col("entries"))
    packed = df.select(F.col(seq).alias("seq"), entries.alias("entries"))
    return ws.save(packed.select("seq", idx.alias("idx"), val.alias("val")), "vectors")


def missing_vectors(rows: DataFrame, vectors: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows that got no vector; must be empty before clustering."""
    return rows.select(F.col(seq).alias("seq")).join(vectors.select("seq"), "seq", "left_anti")


def with_vector_key(vectors: DataFrame) -> DataFrame:
    """Add a 128-bit digest that is equal for equal vectors."""
    halves = [F.xxhash64(F.lit(half), "idx", "val").cast("string") for half in (1, 2)]
    return vectors.withColumn("vkey", F.concat_ws(":", *halves))


def distinct_vectors(ws: Workspace, keyed: DataFrame) -> DataFrame:
    """One row per distinct non-zero vector: the smallest seq, and how many tickets share it.

    Copies are folded here, with map-side partial aggregation, so that later joins never meet them.
    """
    folded = (
        keyed.where(F.size("idx") > 0)
        .groupBy("vkey")
        .agg(
            F.min("seq").alias("seq"),
            F.count("*").alias("n"),
            F.first("idx").alias("idx"),
            F.first("val").alias("val"),
        )
    )
    return ws.save(folded, "distinct")
