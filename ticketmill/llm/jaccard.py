"""Exact n-gram Jaccard join of documents by a token-group matrix, giving the groups of linked documents.

A document is the set of its distinct k-word shingles (tokens here). Two documents link if num/den of their union is
shared, and a group is what links reach. The work is done on groups of similar documents rather than on pairs:

1. Every document gets its size, a 128-bit digest of its set and its smallest token. Copies share a digest, and one
   document stands for them from here on.
2. Documents with the same smallest tokens in two orders form a first group, cut into chunks of bounded size that also hold the
   group's leader. A task opens one chunk, compares its members and reports one edge per newly linked member, so a large
   group of near copies yields about one edge a document. The same is done once more for the other choices of two among three
   orders, where groups hold more than one component yet. This only saves work later; one order alone would bring together
   documents by chance, more of them the more documents there are.
3. Documents that share the smallest token in two of the three orders are similar and partitioned into groups of bounded size,
   others stand alone. The matrix has the token union of each group. By the prefix principle only the first tokens in a common order,
   frequent ones last, need to be stored: two documents that link share one of them. Groups that share tokens are
   candidates, unless they are all of one component, and the number of shared tokens bounds the overlap of a document with
   a group: what a prefix misses in the other's visible range is missing in the other set.
4. Only qualifying groups, and pairs of them, are opened. First counts of the unions' tokens by buckets bound what two groups share,
   so most pairs end without their sets being moved. In what is opened each member's overlap with the other group's whole union is
   bounded once more, and what remains is compared exactly.

The order of tokens only decides how much is compared, never the result. Sets are compared by 64-bit hashes of
their tokens.

Null ids take no part. Null and empty texts, and texts without words, have no tokens and link with nothing. Ids are
meant to be unique; rows that repeat an id share one component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.components import components
from ticketmill.llm.hashing import mixed, pieces, shingle_sets
from ticketmill.llm.marks import bitmap, few, marked, only_marked
from ticketmill.operators.ranking import join_by_key
from ticketmill.session import Workspace

# members and tokens of a group that is opened in one task
GROUP_DOCS = 64
GROUP_TOKENS = 200_000
# the most frequent tokens, which go last in the order; more would only change the work
FREQUENT = 100_000
# a token can be one of them if it comes so often in a stretch of so many tokens
FREQUENT_TIMES = 2
TOKENS_COUNTED = 2_000_000
# digests a task remembers; forgetting some only means more documents that stand for themselves
SEEN = 100_000

# matrix entries a task packs at once, and those of a part of the matrix, about
PACKED = 400_000
PART_CELLS = 150_000

LOWS = ("low", "low2", "low3")
SIGNATURE = "kind int, doc_id long, carrier long, n long, k1 long, k2 long, low long, low2 long, low3 long"


def _signatures(k: int):
    def run(batches):
        seen: dict = {}
        held, waiting = [], 0
        for batch in pieces(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tokens, at = shingle_sets(batch.column(1), k)
            n = np.diff(at)
            u = tokens.view(np.uint64)
            sums = [np.r_[np.uint64(0), np.cumsum(mixed(u ^ np.uint64(salt)))] for salt in (0x51ED270B, 0xC2B2AE3D27D4EB4F)]
            k1, k2 = ((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)
            full = n > 0
            lows = np.zeros((3, len(n)), np.int64)
            lows[0, full] = tokens[at[:-1][full]]
            for j, salt in ((1, 0x8EBC6AF09C88C6E3), (2, 0x589965CC75374CC3)):
                if full.any():
                    lows[j, full] = np.minimum.reduceat(mixed(u ^ np.uint64(salt)), at[:-1][full]).view(np.int64)
            carrier = np.array([seen.setdefault(key, i) for key, i in zip(zip(k1.tolist(), k2.tolist()), ids.tolist())], np.int64)
            if len(seen) > SEEN:
                seen.clear()
            row = {"kind": np.zeros(len(n), np.int32), "doc_id": ids, "carrier": carrier, "n": n, "k1": k1, "k2": k2}
            yield pa.RecordBatch.from_pydict(row | dict(zip(LOWS, lows)))
            held.append(tokens[np.repeat(carrier == ids, n)])
            waiting += len(held[-1])
            if waiting >= TOKENS_COUNTED:
                yield repeated(held)
                held, waiting = [], 0
        if held:
            yield repeated(held)

    def repeated(held):
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        values, counts = values[counts >= FREQUENT_TIMES], counts[counts >= FREQUENT_TIMES]
        none = np.zeros(len(values), np.int64)
        row = {"kind": np.ones(len(values), np.int32), "doc_id": none, "carrier": none, "n": counts, "k1": none, "k2": none}
        return pa.RecordBatch.from_pydict(row | {"low": values, "low2": none, "low3": none})

    return run


def _as_tokens(k: int):
    """Batches with their lists of (label, text) as lists of (label, tokens)."""

    def tokenised(lists: pa.Array) -> pa.Array:
        held = lists.flatten()
        tokens, at = shingle_sets(held.field("text"), k)
        sets = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens))
        offsets = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([held.field("label"), sets], names=["label", "tokens"]))

    def run(batches):
        for batch in pieces(batches):
            columns = [tokenised(c) if pa.types.is_list(c.type) else c for c in batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


FIRST_FREQUENT = 1 << 30  # keys of frequent tokens follow those of all others


def _prefixes(k: int, num: int, den: int, frequent, keep: list[str], special=None):
    """Matrix entries of each document: its first tokens in the common order, with the columns ``keep``.

    ``pos`` counts from 1, ``often`` is a frequent token's place or -1, ``last`` the key of the last token (see ``_key``).
    With ``special``, a bitmap, documents marked in it are left out.
    """

    def run(batches):
        held = frequent.value  # tokens ascending, and the place of each among the frequent ones
        for batch in pieces(batches):
            if special is not None:
                batch = batch.filter(pa.array(~marked(batch.column("doc_id").to_numpy(zero_copy_only=False), special.value)))
            tokens, at = shingle_sets(batch.column("text"), k)
            place = np.full(len(tokens), -1, np.int64)
            if len(held[0]) and len(tokens):
                i = np.minimum(np.searchsorted(held[0], tokens), len(held[0]) - 1)
                same = held[0][i] == tokens
                place[same] = held[1][i[same]]
            out, often, last, size = [], [], [], []
            for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                n = e - s
                p = n + num * n // -den + 1 if n else 0  # n - ceil(n num / den) + 1, what the principle needs
                p = min(n, p + p // 2)  # and half as much again, which tightens the bounds
                own, put = tokens[s:e], place[s:e]
                rare = put < 0
                if not rare.all():
                    order = np.r_[np.flatnonzero(rare), np.flatnonzero(~rare)[np.argsort(put[~rare], kind="stable")]]
                    own, put = own[order], put[order]
                out.append(own[:p])
                often.append(put[:p])
                last.append(0 if not p else FIRST_FREQUENT + put[p - 1] if put[p - 1] >= 0 else own[p - 1] >> 33)
                size.append(p)
            size = np.array(size, np.int64)
            rep = lambda x, size=size: np.repeat(np.asarray(x), size)
            yield pa.RecordBatch.from_pydict(
                {c: rep(batch.column(c).to_numpy(zero_copy_only=False)) for c in keep}
                | {
                    "token": np.concatenate(out) if out else np.zeros(0, np.int64),
                    "n": rep(np.diff(at)),
                    "last": rep(np.array(last, np.int32)),
                    "pos": (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + 1).astype(np.int32),
                    "often": np.concatenate(often).astype(np.int32) if often else np.zeros(0, np.int32),
                }
            )

    return run


ENTRY = "token long, n long, last int, pos int, often int"


def _key(token: Column, often: Column) -> Column:
    """A token's place in the common order, coarsely: 31 bits of its hash, frequent ones behind."""
    return F.when(often >= 0, often + FIRST_FREQUENT).otherwise(F.shiftright(token, 33).cast("int"))


def _links(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which of the sets link with which."""
    sizes = np.array([len(x) for x in sets])
    values, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)
    column = np.full(len(values), -1)
    column[shared] = np.arange(len(shared))
    column = column[where]
    grid = np.zeros((len(sets), len(shared)), np.float32)  # whole numbers below 2^24 are exact in it
    grid[np.repeat(np.arange(len(sets)), sizes)[column >= 0], column[column >= 0]] = 1
    inter = np.rint(grid @ grid.T).astype(np.int64)
    return inter * den >= (sizes[:, None] + sizes[None, :] - inter) * num


def _ties(labels: np.ndarray, link: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges between labels that make each connected part one: every other label of a part to its smallest."""
    ends: tuple[list, list] = ([], [])
    link = link | (labels[:, None] == labels[None, :])
    waiting = np.ones(len(labels), bool)
    for first in np.argsort(labels, kind="stable"):
        if waiting[first]:
            part = front = np.arange(len(labels)) == first
            while front.any():
                front = link[front].any(axis=0) & ~part
                part = part | front
            waiting &= ~part
            others = np.setdiff1d(labels[part], labels[first])
            ends[0].extend([int(labels[first])] * len(others))
            ends[1].extend(others.tolist())
    return ends


def _members(scalar) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and token sets of a list of (label, tokens)."""
    held = scalar.values
    lists = held.field("tokens")
    bounds = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    return held.field("label").to_numpy(), [flat[s:e] for s, e in zip(bounds[:-1], bounds[1:])]


def _open(num: int, den: int):
    """Groups (members), or pairs of groups (members and others), to edges between the labels of what links.

    In a pair only documents whose overlap with the other group's union is large enough are compared.
    """

    def within(sets, others):
        union = np.unique(np.concatenate(others))
        return np.array([np.isin(x, union, assume_unique=True).sum() * den >= len(x) * num for x in sets], bool)

    def run(batches):
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for row in range(batch.num_rows):
                labels, sets = _members(batch.column("members")[row])
                if batch.num_columns > 1 and batch.column("others")[row].is_valid:
                    more, others = _members(batch.column("others")[row])
                    left, right = within(sets, others), within(others, sets)
                    if not left.any() or not right.any():
                        continue
                    labels = np.r_[labels[left], more[right]]
                    sets = [x for x, w in zip([*sets, *others], np.r_[left, right]) if w]
                if len(sets) > 1:
                    ends = _ties(labels, _links(sets, num, den))
                    a += ends[0]
                    b += ends[1]
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _open_texts(k: int, num: int, den: int):
    return lambda batches: _open(num, den)(_as_tokens(k)(batches))


SKETCH = "gid long, least long, sketch binary, members array<struct<n: long, sketch: binary>>"


def _sketch(tokens: np.ndarray) -> bytes:
    """How many tokens fall into each of about as many buckets, by their leading bits; 255 stands for more too."""
    log = max(4, (len(tokens) - 1).bit_length())
    count = np.bincount((tokens.view(np.uint64) >> np.uint64(64 - log)).astype(np.int64), minlength=1 << log)
    return np.minimum(count, 255).astype(np.uint8).tobytes()


def _sketches(batches):
    """Groups (gid, members) to the size of the smallest member, the sketch of the union, and size and sketch of each member of several."""
    for batch in batches:
        least, sketches, members = [], [], []
        for row in range(batch.num_rows):
            _, sets = _members(batch.column("members")[row])
            least.append(min([len(x) for x in sets]))
            sketches.append(_sketch(np.unique(np.concatenate(sets))))
            members.append([{"n": len(x), "sketch": _sketch(x)} for x in sets] if len(sets) > 1 else [])
        kind = pa.list_(pa.struct([("n", pa.int64()), ("sketch", pa.binary())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("gid"), pa.array(least, pa.int64()), pa.array(sketches, pa.binary()), pa.array(members, kind)], names=["gid", "least", "sketch", "members"]
        )


def _most_shared(a: bytes, b: bytes) -> int:
    """Sets with these sketches share at most so many tokens."""
    x, y = (np.frombuffer(s, np.uint8).astype(np.int64) for s in (a, b))
    x, y = (np.where(s == 255, 1 << 40, s) for s in (x, y))
    size = min(len(x), len(y))
    x, y = (s.reshape(size, -1).sum(axis=1) for s in (x, y))  # neighbouring buckets are those of fewer leading bits
    return int(np.minimum(x, y).sum())


def _may_link(num: int, den: int):
    """Pairs of groups whose sketches leave room for a link: between the unions, and of a member of each with the other's union."""

    def fits(members, union) -> bool:
        return not members or any([_most_shared(m["sketch"], union) * den >= m["n"] * num for m in members])

    def run(batches):
        names = ("a_least", "b_least", "a_sketch", "b_sketch", "a_members", "b_members")
        for batch in batches:
            keep = [
                _most_shared(x, y) * (num + den) >= (la + lb) * num and fits(mx, y) and fits(my, x)
                for la, lb, x, y, mx, my in zip(*[batch.column(c).to_pylist() for c in names])
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _chunks(count: Column, tokens: Column) -> Column:
    return F.greatest(F.ceil(count / GROUP_DOCS), F.ceil(tokens / GROUP_TOKENS)).cast("long")


def _chunk_of(doc: str, chunks: str) -> Column:
    return F.pmod(F.xxhash64(doc), F.col(chunks))


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (with a ``doc_id``) with the texts of their documents, which take less room on the way than their tokens."""
    return wanted.join(few(docs, "doc_id", wanted), "doc_id").select(*wanted.columns, "text")


def _open_groups(ws: Workspace, docs: DataFrame, keyed: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Rows (key, rep, n, comp) to edges (a, b) inside the groups of a key that hold more than one component."""
    groups = keyed.groupBy("key").agg(
        F.count("*").alias("m"), F.sum("n").alias("tokens"), F.min("rep").alias("leader"), F.min("comp").alias("c0"), F.max("comp").alias("c1")
    )
    groups = groups.where("c0 <> c1").select("key", "leader", "m", _chunks(F.col("m"), F.col("tokens")).alias("chunks"))
    groups = ws.save(groups, "groups")
    own = join_by_key(keyed, groups, "key", "m").where("chunks IS NOT NULL").select("key", _chunk_of("rep", "chunks").alias("chunk"), F.col("rep").alias("doc_id"))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    led = groups.where("chunks > 1").select("key", numbers.alias("chunk"), F.col("leader").alias("doc_id"))
    wanted = ws.save(own.union(led).distinct(), "members")
    chunks = _fetch(docs, wanted).groupBy("key", "chunk").agg(F.collect_list(F.struct(F.col("doc_id").alias("label"), "text")).alias("members"))
    return ws.save(chunks.select("members").mapInArrow(_open_texts(k, num, den), "a long, b long"), "near")


# columns of a matrix entry of a document that stands alone, and those of a group beyond them
CELL = ("token", "gid", "least", "last", "pos", "often")
GROUP_CELL = (*CELL, "most", "members", "c0", "c1")
PACKED_ROWS = "part int, columns int, cells binary"
# leading bits of a token's hash that the matrix keeps: tokens that agree in them count as one, so more is compared, not less
KEPT_BITS = np.int64(-1 << 24)
LEAST = {"often": -1, "last": -(1 << 30)}  # what is taken off a column, as negative numbers have other leading bytes
MATRIX = "token long, gid long, members long, c0 long, c1 long, least long, most long, last int, pos int, often int"


def _packed(names: tuple[str, ...], bits: int):
    """Matrix entries to rows (part, columns, cells): those whose tokens have the same leading bits, column by column.

    Bytes of equal weight stand together, so what is equal or zero in most entries takes little room when it is shuffled.
    """

    def flush(held):
        columns = [np.concatenate(c) - LEAST.get(name, 0) for name, c in zip(names, zip(*held))]
        held.clear()
        columns[0] &= KEPT_BITS
        order = np.argsort(columns[0].view(np.uint64))
        columns = [c[order] for c in columns]
        part = (columns[0].view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
        at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for s, e in zip(at.tolist(), [*at[1:].tolist(), len(part)]):
            cells = b"".join([np.ascontiguousarray(c[s:e].view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns])
            yield pa.RecordBatch.from_pydict({"part": pa.array([part[s]], pa.int32()), "columns": pa.array([len(columns)], pa.int32()), "cells": [cells]})

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
                size += batch.num_rows
            if size >= PACKED:
                yield from flush(held)
                size = 0
        if size:
            yield from flush(held)

    return run


def _meeting(batches):
    """Matrix entries of the tokens that meet in groups of different components; rows come sorted by part."""

    def finish(held):
        columns: dict[str, list] = {c: [] for c in GROUP_CELL}
        for count, cells in held:
            own = np.frombuffer(cells, np.uint8).reshape(count, 8, -1)
            own = {name: np.ascontiguousarray(c.T).view(np.int64).reshape(-1) + LEAST.get(name, 0) for name, c in zip(GROUP_CELL, own)}
            if count == len(CELL):
                own |= {"most": own["least"], "members": np.ones(len(own["gid"]), np.int64), "c0": own["gid"], "c1": own["gid"]}
            for c, values in own.items():
                columns[c].append(values)
        every = {c: np.concatenate(v) for c, v in columns.items()}
        order = np.argsort(every["token"], kind="stable")
        token = every["token"][order]
        first = np.r_[True, token[1:] != token[:-1]]
        at, which = np.flatnonzero(first), np.cumsum(first) - 1
        over = lambda f, c: f.reduceat(every[c][order], at)
        meets = (over(np.minimum, "gid") != over(np.maximum, "gid")) & (over(np.minimum, "c0") != over(np.maximum, "c1"))
        kept = order[meets[which]]
        kind = dict(f.split(" ") for f in MATRIX.split(", "))
        return pa.RecordBatch.from_pydict({c: pa.array(every[c][kept], pa.int32() if kind[c] == "int" else pa.int64()) for c in kind})

    now, held = None, []
    for batch in batches:
        for part, count, cells in zip(*[batch.column(c).to_pylist() for c in ("part", "columns", "cells")]):
            if part != now and held:
                yield finish(held)
                held = []
            now = part
            held.append((count, cells))
    if held:
        yield finish(held)


def _candidates(shared: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of groups (a, b) that may hold a link between different components."""
    side = lambda s: shared.select("token", *[F.col(c).alias(f"{s}_{c}") for c in shared.columns if c != "token"])
    met = side("a").join(side("b"), "token").where(
        (F.col("a_gid") < F.col("b_gid")) & (F.col("a_often") == F.col("b_often"))
        & ((F.col("a_c0") != F.col("b_c1")) | (F.col("a_c1") != F.col("b_c0")))
        & (F.col("a_most") * den >= F.col("b_least") * num) & (F.col("b_most") * den >= F.col("a_least") * num)
    )
    # what lies surely below the end of both prefixes is seen from both sides
    seen = _key(F.col("token"), F.col("a_often")) < F.least("a_last", "b_last")
    pairs = met.groupBy("a_gid", "b_gid", "a_members", "b_members").agg(
        F.count("*").alias("all"),
        F.count_if(seen).alias("c"),
        *[F.min(f"{s}_{c}").alias(f"{s}_{c}") for s in "ab" for c in ("least", "last")],
        *[F.max(F.when(seen, F.col(f"{s}_pos"))).alias(f"{s}_pos") for s in "ab"],
    )
    need = F.ceil((F.col("a_least") + F.col("b_least")) * num / F.lit(num + den))  # the least overlap of a link

    def needed(n: Column) -> Column:
        return n - F.ceil(n * num / F.lit(den)) + 1

    def fits(s: str, o: str) -> Column:
        """Not more of a single document's tokens are missing on the other side than a link allows.

        The ends of a group's prefixes differ, so what is visible of its union may end anywhere. But prefixes are half as long again as
        they must be, so a member that links shares as many tokens more: with the document's prefix, and so does the union.
        """
        n = F.col(f"{s}_least")
        prefix = F.least(n, needed(n) + F.floor(needed(n) / 2))
        whole = F.col(f"{s}_last") < F.col(f"{o}_last")
        missing = F.when(whole, prefix - F.col("all")).otherwise(F.coalesce(f"{s}_pos", F.lit(0)) - F.col("c"))
        smallest = F.greatest(F.col(f"{o}_least"), F.ceil(n * num / F.lit(den)))
        enough = F.col("all") >= 1 + F.floor(needed(F.least(n, smallest)) / 2)
        return F.when(F.col(f"{s}_members") > 1, True).when(F.col(f"{o}_members") > 1, enough).otherwise(missing <= n - need)

    return pairs.where(fits("a", "b") & fits("b", "a")).select(F.col("a_gid").alias("a"), F.col("b_gid").alias("b"))


def linked_groups(
    ws: Workspace, docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles (long) and component_id, the smallest id that links reach."""
    spark = ws.spark
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.where(F.col("doc_id").isNotNull())

    # 1. sizes, digests, smallest tokens; one document for each set
    signed = ws.save(docs.mapInArrow(_signatures(k), SIGNATURE), "signatures")
    rows = signed.where("kind = 0").drop("kind")
    often = signed.where("kind = 1").groupBy("low").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "low").limit(FREQUENT)
    often = often.select("low").toArrow()["low"].to_numpy()  # at most FREQUENT numbers
    by_value = np.argsort(often)
    frequent = spark.sparkContext.broadcast((often[by_value], (len(often) - 1 - by_value).astype(np.int64)))
    carriers = rows.where("n > 0 AND doc_id = carrier").drop("carrier").distinct()
    reps = ws.save(
        carriers.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), *[F.min(c).alias(c) for c in LOWS]), "sets"
    )

    # 2. open the first groups, then those that agree in the two other choices of two
    two_of_three = [F.xxhash64(F.lit(a + b), a, b) for a, b in zip(LOWS, (*LOWS[1:], LOWS[0]))]
    keyed = reps.select("rep", "n", two_of_three[0].alias("key"), F.col("rep").alias("comp"))
    edges = _open_groups(ws, docs, keyed, k, num, den)
    near = components(ws, edges)
    keyed = (
        reps.join(near.withColumnRenamed("id", "rep"), "rep", "left")
        .select("rep", "n", F.coalesce("component", "rep").alias("comp"), F.explode(F.array(*two_of_three[1:])).alias("key"))
    )
    edges = edges.union(_open_groups(ws, docs, keyed, k, num, den))
    near = ws.save(components(ws, edges), "components")

    # 3. groups of similar documents: all that share two of the three smallest tokens, by the smallest leader
    keyed = (
        reps.join(near.withColumnRenamed("id", "rep"), "rep", "left")
        .select("rep", "n", F.coalesce("component", "rep").alias("comp"), F.explode(F.array(*two_of_three)).alias("key"))
    )
    leaders = keyed.groupBy("key").agg(F.min("rep").alias("leader"))
    similar = keyed.join(leaders, "key").groupBy("rep", "n", "comp").agg(F.min("leader").alias("leader"))
    similar = ws.save(similar, "similar")
    sizes = similar.groupBy("leader").agg(F.count("*").alias("m"), _chunks(F.count("*"), F.sum("n")).alias("chunks"))
    part = join_by_key(similar, sizes, "leader", "m").select("rep", "comp", "leader", _chunk_of("rep", "chunks").alias("chunk"))
    gids = part.groupBy("leader", "chunk").agg(
        F.min("rep").alias("gid"), F.count("*").alias("members"), F.min("comp").alias("c0"), F.max("comp").alias("c1")
    )
    units = ws.save(part.join(gids, ["leader", "chunk"]).select(F.col("rep").alias("doc_id"), "comp", "gid", "members", "c0", "c1"), "units")

    # the matrix; documents that stand alone need nothing of the units and are not moved for them
    alone = units.where("members = 1 AND comp = doc_id").select("doc_id")
    grouped = rows.where("n > 0").select("doc_id").join(alone, "doc_id", "left_anti")
    special = spark.sparkContext.broadcast(bitmap(grouped, "doc_id"))
    total = rows.agg(F.sum(F.col("n") * (1.5 * (den - num) / den) + 1.5).alias("cells")).first()["cells"] or 0
    bits = max(1, int(total // PART_CELLS).bit_length())
    alone_of = _prefixes(k, num, den, frequent, ["doc_id"], special)
    names = ("token", "doc_id", "n", "last", "pos", "often")
    single = docs.mapInArrow(lambda batches: _packed(names, bits)(alone_of(batches)), PACKED_ROWS)
    keep = ["gid", "members", "c0", "c1"]
    mine = units.join(docs.mapInArrow(only_marked("doc_id", special), docs.schema), "doc_id").select(*keep, "text")
    joined = mine.mapInArrow(_prefixes(k, num, den, frequent, keep), "".join(f"{c} long, " for c in keep) + ENTRY)
    union = joined.groupBy("token", *keep, "often").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("last").alias("last"), F.max("pos").alias("pos")
    )
    packed = single.unionByName(union.mapInArrow(_packed(GROUP_CELL, bits), PACKED_ROWS))
    dealt = packed.repartitionById(1 << bits, "part").sortWithinPartitions("part")
    shared = ws.save(dealt.mapInArrow(_meeting, MATRIX), "matrix")
    pairs = ws.save(_candidates(shared, num, den), "candidates")

    # 4. open what qualifies: pairs, and groups of more than one component
    # what a group is called for stays with it, so that its sets are moved for nothing else
    roles = ("as_a", "as_b", "mixed")
    called_as = lambda df, gid, role: df.select(F.col(gid).alias("gid"), *[F.lit(r == role).alias(r) for r in roles])
    called = called_as(pairs, "a", "as_a").union(called_as(pairs, "b", "as_b")).union(called_as(units.where("c0 <> c1"), "gid", "mixed"))
    called = called.groupBy("gid").agg(*[F.bool_or(r).alias(r) for r in roles])
    wanted = units.join(called, "gid").select("doc_id", F.col("comp").alias("label"), "gid", *roles)
    sets = _fetch(docs, wanted).groupBy("gid", *roles).agg(F.collect_list(F.struct("label", "text")).alias("members"))
    sets = ws.save(sets, "opened")
    sketches = ws.save(sets.select("gid", "members").mapInArrow(lambda batches: _sketches(_as_tokens(k)(batches)), SKETCH), "sketches")
    side = lambda x: sketches.select(F.col("gid").alias(x), F.col("least").alias(f"{x}_least"), F.col("sketch").alias(f"{x}_sketch"), F.col("members").alias(f"{x}_members"))
    pairs = ws.save(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_may_link(num, den), "a long, b long"), "likely")
    own = sets.where("as_a").select(F.col("gid").alias("a"), "members")
    other = sets.where("as_b").select(F.col("gid").alias("b"), F.col("members").alias("others"))
    met = pairs.join(own, "a").join(other, "b").select("members", "others")
    within = sets.where("mixed").select("members")
    links = met.mapInArrow(_open_texts(k, num, den), "a long, b long").union(within.mapInArrow(_open_texts(k, num, den), "a long, b long"))
    joined = components(ws, links)

    # labels go back from components to sets, to the documents that carry them, to all documents
    label = units.join(joined.withColumnRenamed("id", "comp"), "comp", "left").select(
        F.col("doc_id").alias("rep"), F.coalesce("component", "comp").alias("label")
    )
    smallest = rows.where("n > 0").groupBy("carrier").agg(F.min("doc_id").alias("first"))
    held = ws.save(
        carriers.select(F.col("doc_id").alias("carrier"), "k1", "k2").join(reps.select("k1", "k2", "rep"), ["k1", "k2"])
        .join(label, "rep").join(smallest, "carrier").select("carrier", "label", "first"),
        "labels",
    )
    ids = held.groupBy("label").agg(F.min("first").alias("component_id"))
    held = held.join(ids, "label").groupBy("carrier").agg(F.min("component_id").alias("component_id"))
    return rows.join(held, "carrier", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
