"""A task counts the known features of all its texts together, in small pieces of text."""

import numpy as np
import pyarrow as pa

from ticketmill.llm import toxicity


class Held:
    value = np.unique(toxicity.text_features(pa.array(["awful words here"]))[0])


def test_a_task_gives_one_batch_of_counts():
    texts = ["awful words", None, "", "here here " * 20_000, "nothing known"] * 4
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[:7])}), pa.RecordBatch.from_pydict({"text": pa.array(texts[7:])})]
    (out,) = toxicity._known(Held)(iter(batches))
    got = dict(zip(out["feature"].to_pylist()[1:], out["n"].to_pylist()[1:]))
    rows = [set(toxicity.text_features(pa.array([t]))[0].tolist()) & set(Held.value.tolist()) for t in texts]
    assert got == {f: sum(f in r for r in rows) for f in set().union(*rows)}
    assert sum(out["rows"].to_pylist()) == len(texts)
