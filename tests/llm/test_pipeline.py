"""The pipeline's stages on small tables."""

from __future__ import annotations

import pytest

import corpus_pipeline as cp

pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _gone long"
ITEM = "A farmer keeps a number of sheep in the field behind his house and sells every third one of them in spring"


def test_stages(spark, tmp_path):
    plain = "this is document number {} and it says nothing that another one says about item {} or thing {} in place {} at time {}"
    rows = [(i, plain.format(*[f"w{i}x{j}" for j in range(5)])) for i in range(40)]
    rows += [(50, rows[3][1]), (51, rows[3][1].upper()), (52, "before it " + ITEM + " and after it"), (53, None), (54, ""), (None, "no id"), (None, "no id")]
    rows += [(60 + i, f"you vileword nastybit vileword {i} w{i}") for i in range(12)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1) for i, t in rows], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 60)) for i, _ in rows if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held, left = docs, []
    for name, stage in cp.STAGES:
        before = held.columns
        stage(spark, held, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        held = spark.read.parquet(f"{tmp_path}/{name}")
        left.append(held.count())
        if name != cp.STAGES[-1][0]:
            assert held.columns == before
    assert left == [47, 45, 44, 44]
    ids = {r.doc_id for r in held.collect()}
    assert ids == {*range(40), 53, 54, None}
    assert cp.run(spark, str(tmp_path)).count() == 44


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
