"""Words are counted and addresses looked for without work that no result depends on."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketmill.functions import text as tx
from ticketmill.operators import vectors as vx

TEXTS = [
    "Mail A.b-c@Host.org now", "see HTTPS://x.y/z?q=1@2 or http://a", "no address", "a@ b", "://", "x@y", " tabs\tand wide  blanks ",
    "OPS-12 fails at me@x.de", "", None, "ABC-1 http://q@r ABC-2", "İ@İ http:", "café café ÉTÉ été x",
]


@pytest.mark.parametrize("strip", [False, True])
def test_addresses_are_removed_as_ever(spark, strip):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    t = tx.blank_if_null("t")
    t = F.lower(F.regexp_replace(t, tx.TICKET_KEY, " ") if strip else t)
    t = F.regexp_replace(F.regexp_replace(t, tx.EMAIL, " "), tx.URL, " ")
    want = F.trim(F.regexp_replace(t, f"{tx.SPACE}+", " "))
    rows = df.select(tx.normalize_text("t", strip).alias("n"), want.alias("w"), tx.tokens(tx.without_addresses("t", strip)).alias("a"), tx.tokens(want).alias("b")).collect()
    assert [r.n for r in rows] == [r.w for r in rows] and [r.a for r in rows] == [r.b for r in rows]


def test_words_are_counted_for_a_batch_of_rows_at_once(spark, ws):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, "b b a c a b", "a" * 5])], "i long, t string").coalesce(1)
    rows = vx.row_terms(ws, df, "t", "i").collect()
    words = {r.i: r.w for r in df.select("i", tx.tokens("t").alias("w")).collect()}
    assert {r.seq: {e.term: e.n for e in r.terms} for r in rows} == {i: dict(Counter(w)) for i, w in words.items()}
    assert all(len(r.terms) == len(set(words[r.seq])) for r in rows) and len(rows) == len(TEXTS) + 2
    held = pa.RecordBatch.from_pydict({"seq": [4, 5, 6], "words": pa.array([["b", "a", "b"], None, ["a"]], pa.list_(pa.string()))})
    (batch,) = vx._count_words(iter([held]))
    assert [sorted((e["term"], e["n"]) for e in r) for r in batch.column("terms").to_pylist()] == [[("a", 1), ("b", 2)], [], [("a", 1)]]
