"""Model steps: failures, the memo, complete vectors and replies for texts of any number."""

import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.operators import enrich as en
from ticketmill.operators import vectors as vx
from ticketmill.plans import clusters as cl

REPLY = T.StructType([T.StructField("reply", T.StringType())])


def shouting(folder=None):
    """Upper-cases texts, refuses one, and leaves a file in the folder for each text it is asked."""

    def fn(frame):
        if folder:
            for t in frame["text"]:
                (folder / uuid.uuid4().hex).write_text(t)
        if (frame["text"] == "bad").any():
            raise RuntimeError("cannot take this")
        return pd.DataFrame({"reply": frame["text"].str.upper()})

    return fn


def test_a_bad_row_loses_only_its_own_answer(spark):
    rows = spark.createDataFrame([(i, "bad" if i == 70 else f"t{i}") for i in range(150)], "i long, text string").coalesce(1)
    count = spark.sparkContext.accumulator(0)
    got = en.enrich(rows, shouting(), REPLY, failed="lost", failures=count).collect()
    assert count.value == 1
    assert {r.i: (r.reply, r.lost) for r in got} == {i: (None, True) if i == 70 else (f"T{i}", False) for i in range(150)}


def test_a_wrong_number_of_rows_is_an_error(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "text string")
    with pytest.raises(Exception, match="rows in"):
        en.enrich(rows.coalesce(1), lambda f: f.head(1).assign(reply="x"), REPLY).collect()


def test_each_text_is_asked_once_and_never_again(spark, ws, tmp_path):
    texts = ["same"] * 400 + [f"t{i % 30}" for i in range(90)] + ["bad", None, ""]
    rows = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "i long, text string, reply string").repartition(3)
    memo = ws.path("memo")
    want = {i: None if t == "bad" else (t or "").upper() for i, t in enumerate(texts)}
    for name, asked in (("first", 33), ("second", 1)):
        folder = tmp_path / name
        folder.mkdir()
        got = en.enrich_distinct(ws, rows, "text", shouting(folder), REPLY, memo, batch_rows=1).collect()
        assert {r.i: r.reply for r in got} == want and len(got) == len(texts)
        # the one that failed is asked a second time by itself, and again in the next run
        assert len(set(f.read_text() for f in folder.iterdir())) == asked
    more = spark.createDataFrame([(1, "new"), (2, "same")], "i long, text string")
    folder = tmp_path / "third"
    folder.mkdir()
    assert {r.reply for r in en.enrich_distinct(ws, more, "text", shouting(folder), REPLY, memo).collect()} == {"NEW", "SAME"}
    assert [f.read_text() for f in folder.iterdir()] == ["new"]


def test_vectors_are_complete_or_of_another_kind(spark, ws):
    tickets = spark.createDataFrame([(0, "pay now"), (1, "pay"), (2, "web page")], "seq long, text string")
    size = lambda n: lambda f: pd.DataFrame({"vector": [[1.0] * (n - 1) + [float(len(t))] for t in f["text"]]})
    vectors, width = en.model_vectors(ws, tickets, F.col("text"), size(3), 3)
    assert width == 3 and sorted(r.seq for r in vectors.collect()) == [0, 1, 2]

    def one_short(frame):
        return pd.DataFrame({"vector": [[1.0, 2.0] if "web" in t else [1.0, 2.0, 3.0] for t in frame["text"]]})

    plain = {r.seq: (r.idx, r.val) for r in vx.tfidf_vectors(ws, tickets, "text").collect()}
    vectors, width = en.model_vectors(ws, tickets, F.col("text"), one_short, 3)
    assert width == vx.MAX_FEATURES and {r.seq: (r.idx, r.val) for r in vectors.collect()} == plain
    with pytest.raises(ValueError, match="1 of 3 rows"):
        en.model_vectors(ws, tickets, F.col("text"), one_short, 3, fallback=False)
    failing = lambda f: 1 / 0
    assert en.model_vectors(ws, tickets, F.col("text"), failing, 3)[1] == vx.MAX_FEATURES
    assert en.model_vectors(ws, tickets, F.col("text"), None, 3)[1] == vx.MAX_FEATURES


def told_plainly(texts, part):
    while True:
        texts = ["(" + "+".join(texts[i : i + part]) + ")" for i in range(0, len(texts), part)]
        texts = [t for t in texts if "lost" not in t]
        if len(texts) <= 1:
            return texts[0] if texts else None


@pytest.mark.parametrize("part", [2, 3, 200])
def test_one_reply_for_any_number_of_texts(spark, ws, part):
    sizes = {1: 1, 2: 2, 3: 7, 4: 23}
    rows = [(k, i, f"{k}.{i}") for k, n in sizes.items() for i in range(n)] + [(5, 0, "lost")]
    texts = spark.createDataFrame(rows, "k long, rank long, combined string").repartition(3)
    model = lambda f: pd.DataFrame({"reply": [None if "lost" in p else f"({p})" for p in f["prompt"]]})
    got = cl.told_of_all(ws, texts, "k", lambda c: c, model, "told", sep="+", part=part)
    want = {k: told_plainly([f"{k}.{i}" for i in range(n)], part) for k, n in sizes.items()} | {5: None}
    assert {r.k: r.told for r in got.collect()} == want


def test_a_part_without_reply_is_left_out(spark, ws):
    rows = [(1, i, t) for i, t in enumerate(["a", "lost", "c", "d", "e"])]
    texts = spark.createDataFrame(rows, "k long, rank long, combined string")
    model = lambda f: pd.DataFrame({"reply": [None if "lost" in p else f"({p})" for p in f["prompt"]]})
    (row,) = cl.told_of_all(ws, texts, "k", lambda c: c, model, "told", sep="+", part=2).collect()
    assert row.told == "(((c+d))+((e)))"  # its place in the next round stays empty


def test_terms_are_weighed_inside_the_row(spark, ws):
    rows = [(0, "disk full disk"), (1, "disk"), (2, ""), (3, None), (4, "web disk page é")]
    df = spark.createDataFrame(rows, "seq long, t string")
    got = {r.seq: dict(zip(r.idx, r.val)) for r in vx.tfidf_vectors(ws, df, "t", max_features=3).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4] and got[2] == got[3] == {} and got[1] == {0: 1.0}
    assert all(abs(sum(v * v for v in x.values()) - 1) < 1e-12 for x in got.values() if x)
    plan = vx.tfidf_vectors(ws, df, "t")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
