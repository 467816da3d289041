"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features of a text are its words (runs of letters, digits and bytes above 127, A-Z in lower case) and the first 4 to
9 bytes of words that have them, each as a 64-bit hash with value log(1 + count). From all labelled rows the features of toxic
texts are counted, then counted in all documents, and those that are much more frequent in toxic texts stay. The labels say only toxic or
not; a toxic text's grade is 1, 2 or 3 by the summed values of such features (thirds of the toxic rows).

The model is the proportional-odds one: P(grade > k) = sigmoid(w x - c_k) with one weight vector for all ordered cuts c_k. The
score is the expected grade, the sum of these probabilities; a text is rejected if P(grade > 0) is at least one half.

Feature statistics cover all labelled toxic rows and all documents. The model's size is bounded by parameters of ``train``: of the features
in at least ``min_toxic`` toxic texts the ``candidates`` most frequent ones are held against all documents, and of those that are at least
``min_lift`` times as frequent in toxic texts the ``features`` most telling ones get a weight. The weights are fitted on the driver on at most ``SAMPLE`` labelled rows,
taken by hash of the id; every row is scored in its own task without a shuffle.

Null and empty texts have no features and the lowest score. Without labels of both kinds nothing is toxic: severity 0.
Labels with a null id or value are ignored, repeated labels count as toxic if any says so. Rows repeat as they come in.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm.hashing import LOWER, flat_bytes, hash_spans, pieces, word_bounds
from ticketmill.llm.marks import few

HEADS = (4, 5, 6, 7, 8, 9)  # bytes of word beginnings
SAMPLE = 20_000  # labelled rows the weights are fitted on
CANDIDATES = 50_000  # features of toxic texts that are counted in all documents
FEATURES = 4_000  # features of the model
MIN_TOXIC = 5  # toxic texts a feature must appear in
MIN_LIFT = 2.5  # how much more frequent it must be in toxic texts than in all
GRADES = 3
RIDGE = 0.02
PIECE = 1 << 18  # bytes of text whose features a worker holds at once, some hundred bytes for each

OUTSIDE = np.ones(256, bool)
OUTSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Model(NamedTuple):
    features: np.ndarray  # ascending hashes
    weights: np.ndarray
    cuts: np.ndarray  # ascending, one for each grade above 0


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every feature occurrence."""
    data, rows = flat_bytes(texts)
    data = LOWER[data]
    starts, ends = word_bounds(data, rows, OUTSIDE)
    row = np.searchsorted(rows, starts, side="right") - 1
    found = hash_spans(data, starts, ends, HEADS)
    where = [row, *(row[ends - starts >= head] for head in HEADS)]
    found = [x ^ np.uint64(head) for x, head in zip(found, (0, *HEADS))]
    return np.concatenate(found).view(np.int64), np.concatenate(where)


def counted(hashes: np.ndarray, rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index into features, count) of the known features that occur."""
    if not len(features) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    i = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
    known = features[i] == hashes
    pair, count = np.unique(rows[known] * len(features) + i[known], return_counts=True)
    return pair // len(features), pair % len(features), count


def _distinct(batches):
    """Features of toxic texts with the number of texts that have them, by batch."""
    for batch in pieces(batches, PIECE):
        hashes, rows = text_features(batch.column("text"))
        order = np.lexsort((hashes, rows))
        h, r = hashes[order], rows[order]
        first = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])] if len(h) else np.zeros(0, bool)
        values, counts = np.unique(h[first], return_counts=True)
        yield pa.RecordBatch.from_pydict({"feature": values, "n": counts.astype(np.int64)})


def _known(features):
    """Numbers of texts that have the known features; the row of feature 0 also counts the texts."""

    def run(batches):
        held = features.value
        n, texts = np.zeros(len(held), np.int64), 0
        for batch in pieces(batches, PIECE):
            hashes, rows = text_features(batch.column("text"))
            _, i, _ = counted(hashes, rows, held)
            n += np.bincount(i, minlength=len(held))
            texts += batch.num_rows
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"feature": np.r_[0, held[has]], "n": np.r_[0, n[has]], "rows": np.r_[texts, np.zeros(len(has), np.int64)]})

    return run


def _design(features):
    def run(batches):
        held = features.value
        for batch in pieces(batches, PIECE):
            hashes, rows = text_features(batch.column("text"))
            row, i, count = counted(hashes, rows, held)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32()))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), lists(i), lists(count)], names=["toxic", "i", "count"]
            )

    return run


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit_ordinal(row: np.ndarray, col: np.ndarray, val: np.ndarray, grade: np.ndarray, width: int, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending cuts that maximise the penalised likelihood of the grades (Adam, full batch).

    The step is fixed: once the gradient has vanished, many more ``rounds`` than the default let it swing by some thousandths again.
    """
    n, top = len(grade), int(grade.max())
    over = np.array([(grade > k).mean() for k in range(top)])
    theta = np.r_[np.zeros(width), -np.log(over[0] / (1 - over[0])), np.full(top - 1, 0.5)]  # weights, first cut, log gaps
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        w, gaps = theta[:width], np.exp(theta[width + 1 :])
        cuts = theta[width] + np.r_[0.0, np.cumsum(gaps)]
        eta = np.bincount(row, val * w[col], minlength=n)
        p = _sigmoid(eta[:, None] - cuts[None, :])  # P(grade > k)
        high = np.c_[np.ones(n), p]  # P(grade >= j)
        low = np.c_[p, np.zeros(n)]
        at = np.arange(n)
        ph, pl = high[at, grade], low[at, grade]
        prob = np.maximum(ph - pl, 1e-12)
        dh, dl = ph * (1 - ph), pl * (1 - pl)
        g_eta = -(dh - dl) / prob / n
        g_cut = np.zeros((n, top + 2))
        g_cut[at, grade] += dh / prob / n  # cut below the grade is number grade - 1
        g_cut[at, grade + 1] -= dl / prob / n
        by_cut = g_cut.sum(axis=0)[1 : top + 1]
        tail = np.cumsum(by_cut[::-1])[::-1]
        grad = np.r_[np.bincount(col, val * g_eta[row], minlength=width) + RIDGE * w / n, tail[0], tail[1:] * gaps]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return theta[:width], theta[width] + np.r_[0.0, np.cumsum(np.exp(theta[width + 1 :]))]


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", sample: int = SAMPLE,
    candidates: int = CANDIDATES, features: int = FEATURES, min_toxic: int = MIN_TOXIC, min_lift: float = MIN_LIFT,
) -> Model:
    """A model from the texts that have a label. ``sample`` bounds the rows it is fitted on, ``candidates`` and ``features`` its size."""
    wanted = features
    said = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("hash"), F.col(text_col).cast("string").alias("text"))
    empty = Model(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    sizes = {r["toxic"]: r["n"] for r in said.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return empty
    bad = said.where("toxic = 1").select("id", F.xxhash64("id").alias("hash"))
    common = (
        few(texts, "hash", bad).join(bad.select("id"), "id").select("text").mapInArrow(_distinct, "feature long, n long")
        .groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= min_toxic).orderBy(F.desc("n"), "feature").limit(candidates).toPandas()
    )
    common = common.sort_values("feature")
    held = spark.sparkContext.broadcast(common["feature"].to_numpy(np.int64))
    every = texts.select("text").mapInArrow(_known(held), "feature long, n long, rows long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")).toPandas()
    known = dict(zip(every["feature"], every["n"]))
    rate1 = common["n"].to_numpy() / sizes[1]
    rate = np.array([known.get(f, 0) + 0.5 for f in common["feature"]]) / max(int(every["rows"].sum()), 1)
    speaks = np.flatnonzero(rate1 >= min_lift * rate)
    best = speaks[np.lexsort((speaks, -(rate1 * np.log(rate1 / rate))[speaks]))][:wanted]
    features = np.sort(common["feature"].to_numpy(np.int64)[best])
    if not len(features):
        return empty
    held = spark.sparkContext.broadcast(features)
    chosen = F.broadcast(said.orderBy(F.xxhash64("id"), "id").limit(sample))  # at most that many ids
    rows = texts.join(chosen, "id").select("text", "toxic").mapInArrow(_design(held), "toxic int, i array<int>, count array<int>").toArrow()
    if not rows.num_rows:
        return empty
    toxic = rows["toxic"].to_numpy()
    lists = rows["i"].combine_chunks()
    size = lists.value_lengths().to_numpy()
    row, col = np.repeat(np.arange(len(toxic)), size), lists.flatten().to_numpy().astype(np.int64)
    val = rows["count"].combine_chunks().flatten().to_numpy().astype(float)
    if toxic.min() == toxic.max():
        return empty
    val = np.log1p(val)
    amount = np.bincount(row, val, minlength=len(toxic))
    thirds = np.quantile(amount[toxic == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic == 1, 1 + np.searchsorted(thirds, amount, side="right"), 0)
    _, grade = np.unique(grade, return_inverse=True)  # without gaps, if amounts tie
    weights, cuts = fit_ordinal(row, col, val, grade, len(features))
    return Model(features, weights, cuts)


def severity(
    texts: pa.Array, features: np.ndarray, weights: np.ndarray, cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected grade, number of cuts that are rather passed than not, and whether the text is rejected."""
    if not len(cuts):
        return np.zeros(len(texts)), np.zeros(len(texts), np.int32), np.zeros(len(texts), bool)
    hashes, rows = text_features(texts)
    row, i, count = counted(hashes, rows, features)
    eta = np.bincount(row, np.log1p(count) * weights[i], minlength=len(texts))
    p = _sigmoid(eta[:, None] - cuts[None, :])
    return np.round(p.sum(axis=1), 6), (p >= 0.5).sum(axis=1).astype(np.int32), p[:, 0] >= 0.5


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, severity (double), grade (int) and toxic (boolean)."""
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        for batch in pieces(batches, PIECE):
            s, g, t = severity(batch.column("text"), *held.value)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(s), pa.array(g), pa.array(t)], names=[id_col, "severity", "grade", "toxic"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"`{id_col}` {dict(picked.dtypes)['id']}, severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns as they are."""
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in pieces(batches, PIECE):
            _, _, toxic = severity(batch.column(at), *held.value)
            yield batch.filter(pa.array(~toxic))

    return docs.mapInArrow(run, docs.schema)
