"""Matrix entries are packed so that what most of them have in common takes no room, and come back as they were."""

import numpy as np
import pyarrow as pa

from ticketmill.llm import jaccard


def test_packed_entries_have_no_signs_and_come_back():
    rng = np.random.default_rng(1)
    n = 500
    token = rng.integers(-(1 << 63), (1 << 63) - 1, n)
    often = np.where(rng.random(n) < 0.5, -1, rng.integers(0, 100_000, n))
    rows = {"token": np.r_[token, token], "doc_id": np.repeat([7, 9], n), "n": np.repeat([600, 700], n), "pos": np.r_[np.arange(n), np.arange(n)]}
    rows |= {"last": np.where(rng.random(2 * n) < 0.5, -5, 1 << 30), "often": np.r_[often, often]}
    names = ("token", "doc_id", "n", "last", "pos", "often")
    packed = pa.Table.from_batches(jaccard._packed(names, 1)([pa.RecordBatch.from_pydict({c: rows[c] for c in names})]))
    for count, cells in zip(packed["columns"].to_pylist(), packed["cells"].to_pylist()):
        planes = dict(zip(names, np.frombuffer(cells, np.uint8).reshape(count, 8, -1)))
        assert not planes["often"][3:].any() and not planes["last"][4:].any() and not planes["token"][:3].any()
    got = pa.Table.from_batches(jaccard._meeting(packed.to_batches())).to_pydict()
    got = {c: np.array(v, np.int64) for c, v in got.items()}
    want = sorted(zip(rows["token"] >> 24, rows["doc_id"], rows["n"], rows["last"], rows["pos"], rows["often"]))
    assert sorted(zip(got["token"] >> 24, got["gid"], got["least"], got["last"], got["pos"], got["often"])) == want


def test_a_group_whose_prefixes_end_at_different_tokens_stays_a_candidate(spark):
    # 20 tokens are those of a member whose prefix ends right after them, one far behind is another member's
    rows = [(i << 33, 9, 1, 9, 9, 200, 200, 100, i, -1) for i in range(1, 47)]
    rows += [(i << 33, 1, 2, 1, 2, 200, 200, 21 if i <= 20 else 90, i, -1) for i in [*range(1, 21), 43]]
    shared = spark.createDataFrame(rows, jaccard.MATRIX)
    assert [tuple(r) for r in jaccard._candidates(shared, 85, 100).collect()] == [(1, 9)]
    few = spark.createDataFrame([r for r in rows if r[0] >> 33 <= 15 or r[0] >> 33 > 43], jaccard.MATRIX)
    assert jaccard._candidates(few, 85, 100).count() == 0
