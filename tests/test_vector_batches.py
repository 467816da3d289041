"""Weights are found for few rows at a time, whatever the session's batches are."""

from ticketmill.operators import vectors as vx


def test_few_rows_are_weighed_at_once(spark, ws, monkeypatch):
    monkeypatch.setattr(vx, "BATCH_ROWS", 7, raising=False)
    seen = spark.sparkContext.accumulator(0)
    weigh = vx._weigh

    def counting(*args):
        inner = weigh(*args)

        def run(batches):
            for batch in batches:
                seen.add(int(batch.num_rows > 7))
                yield from inner(iter([batch]))

        return run

    monkeypatch.setattr(vx, "_weigh", counting)
    usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.range(60).selectExpr("id AS seq", "concat('word', id % 5, ' every') AS t").coalesce(1)
    rows = vx.tfidf_vectors(ws, df, "t").orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(60)) and all(len(r.idx) == 2 for r in rows)
    assert seen.value == 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == usual
