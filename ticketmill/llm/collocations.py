"""Phrases whose words occur together more often than their parts explain, from exact counts of all frequent n-grams.

First pass. N-grams of 1 to ``order`` words are hashed, and the leading bits of the hash give one of P partitions. Tasks count what they
hold and send each partition its counts as packed arrays. A partition merges them into a Misra-Gries summary: beyond its capacity the
(capacity + 1)-th largest count is taken off all counters, and those left without are dropped. That takes at least
capacity + 1 times as much off the partition's mass, so the error, which is carried along, stays below
mass / capacity. The capacity is ``SLACK`` times mass / threshold, so every n-gram that reaches the threshold survives, with all but a
``SLACK``-th of it; counters that cannot reach it, even with the error added, are dropped at the end. Hashes that collide only add up.

Second pass. The survivors go into a bitmap (a Bloom filter of one word a key) of at most ``MAX_BITS``; n-grams that pass it, and whose
shorter parts do, are numbered exactly inside a batch and counted by their words. What passes is counted wherever it occurs, so counts
at or above the threshold are exact. If very many survive, the bitmap lets more through and the second pass
shuffles more; the result stays the same.

Texts have A-Z in lower case, are cut into pieces at ``. , ; : ! ?``, line ends and form feeds, and pieces into words at blanks and tabs.
A null language is ``und``; a null text is empty. Repeated rows count each time; ids and other columns are not read. Empty tables
and texts without words give no rows. Texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.hashing import LOWER, U64, flat_bytes, hash_spans, mixed, pieces, word_bounds
from ticketmill.operators.ranking import join_by_key
from ticketmill.session import Workspace

ORDER = 5
THRESHOLD = 100
SLACK = 4
KEY_BITS = 48
FLUSH = 3 << 20  # hashes a task gathers before it counts them
PART_MASS = 2 << 20  # n-grams of a partition, about
MAX_PARTITIONS = 1 << 17
MAX_BITS = 1 << 30
SEGMENT = 1 << 13  # 64-bit words of the bitmap in a row
TEXT = 2 << 20  # bytes of text numbered at a time
SHARES = 64  # of a language, ranked apart first

ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
OUTSIDE = ENDS.copy()
OUTSIDE[[0x20, 0x09]] = True


class Words:
    """The words of a batch: their bytes, hashes, languages, and how many words of the piece follow."""

    def __init__(self, batch: pa.RecordBatch):
        data, rows = flat_bytes(batch.column("text"))
        data = LOWER[data]
        self.starts, self.ends = word_bounds(data, rows, OUTSIDE)
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], U64)
        row = np.searchsorted(rows, self.starts, side="right") - 1
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[row]
        self.hashes = hash_spans(data, self.starts, self.ends)[0]
        self.seeds = seeds[self.lang] if len(row) else np.zeros(0, U64)
        n = len(row)
        # a piece ends between two words if a row or an end mark does
        marks = np.flatnonzero(ENDS[data])
        mark = np.searchsorted(marks, self.starts)
        last = np.flatnonzero(np.r_[(row[1:] != row[:-1]) | (mark[1:] != mark[:-1]), True]) if n else np.zeros(0, np.int64)
        self.left = np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(n) + 1 if n else last
        self.data = data

    def keys(self, order: int):
        """For each n up to ``order``: the positions with n words left in their piece, and the keys of these n-grams."""
        at = np.arange(len(self.hashes))
        acc = mixed(self.hashes ^ self.seeds)
        for n in range(1, order + 1):
            if n > 1:
                has = self.left[at] >= n
                at, acc = at[has], acc[has]
                acc = mixed(acc * U64(0xD6E8FEB86659FD93) + self.hashes[at + n - 1])
            yield n, at, acc >> U64(64 - KEY_BITS)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """Each word as a number into the distinct words."""
        size = self.ends - self.starts
        offsets = np.r_[0, np.cumsum(size)]
        index = np.arange(offsets[-1]) + np.repeat(self.starts - offsets[:-1], size)
        words = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[index].tobytes()))
        words = words.dictionary_encode()
        return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys, first those that count one, and counts of the others; bytes of equal weight stand together, so the leading ones compress well."""
    one = counts == 1
    parts = [np.array([one.sum(), len(keys) - one.sum()], "<u4").tobytes()]
    for some in (keys[one], keys[~one]):
        parts.append(np.ascontiguousarray(some.astype("<u8").view(np.uint8).reshape(-1, 8).T[: KEY_BITS // 8]).tobytes())
    parts.append(counts[~one].astype("<u4").tobytes())
    return b"".join(parts)


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = KEY_BITS // 8
    one, more = np.frombuffer(blob, "<u4", 2).tolist()
    out, at = [], 8
    for n in (one, more):
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :width] = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n).T
        out.append(whole.view("<u8").reshape(-1))
        at += n * width
    return np.concatenate(out), np.r_[np.ones(one, np.int64), np.frombuffer(blob, "<u4", more, at).astype(np.int64)]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary; ``error`` is the most a count may be too low by."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, U64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        """Take in another summary's counters and error."""
        self.keys, self.counts = summed(np.r_[self.keys, keys], np.r_[self.counts, counts])
        self.error += error
        over = len(self.keys) - self.capacity
        if over > 0:
            cut = int(np.partition(self.counts, over - 1)[over - 1])  # the (capacity + 1)-th largest
            kept = self.counts > cut
            self.keys, self.counts = self.keys[kept], self.counts[kept] - cut
            self.error += cut

    def reaching(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.error >= threshold]


def _partition_counts(order: int, bits: int):
    """Rows (part, mass, counts) of a task's n-grams."""
    shift = U64(KEY_BITS - bits)

    def flush(held):
        keys = np.concatenate(held)
        held.clear()
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        counts = np.diff(np.r_[first, len(keys)])
        keys = keys[first]
        part = (keys >> shift).astype(np.int64)
        at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        ends = np.r_[at[1:], len(keys)]
        blobs = [pack_counts(keys[a:b], counts[a:b]) for a, b in zip(at, ends)]
        mass = np.add.reduceat(counts, at)
        for s in range(0, len(at), 256):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[at[s : s + 256]], pa.int32()), pa.array(mass[s : s + 256], pa.int64()), pa.array(blobs[s : s + 256], pa.binary())],
                names=["part", "mass", "counts"],
            )

    def run(batches):
        held, size = [], 0
        for batch in pieces(batches, 1 << 20):
            for _, at, keys in Words(batch).keys(order):
                held.append(keys)
                size += len(keys)
                if size >= FLUSH:
                    yield from flush(held)
                    size = 0
        if size:
            yield from flush(held)

    return run


def _survivors(threshold: int):
    """Rows (key) of what reaches the threshold; the task's rows come sorted by partition.

    A partition's packed counts are held until its mass is known; that is what the number of partitions bounds.
    """

    def finish(held, mass):
        summary = Summary(SLACK * mass // threshold + 1)
        keys, counts, size = [], [], 0
        for i, blob in enumerate(held):
            k, c = unpack_counts(blob)
            keys.append(k)
            counts.append(c)
            size += len(k)
            if size >= max(summary.capacity, 1 << 19) or i + 1 == len(held):
                summary.merge(np.concatenate(keys), np.concatenate(counts))
                keys, counts, size = [], [], 0
        if summary.error >= threshold:
            raise RuntimeError("the summary's capacity is too small")
        return pa.RecordBatch.from_arrays([pa.array(summary.reaching(threshold).view(np.int64))], names=["key"])

    def run(batches):
        now, held, mass = None, [], 0
        for batch in batches:
            for part, m, blob in zip(*[batch.column(c).to_pylist() for c in ("part", "mass", "counts")]):
                if part != now:
                    if held:
                        yield finish(held, mass)
                    now, held, mass = part, [], 0
                held.append(blob)
                mass += m
        if held:
            yield finish(held, mass)

    return run


def _bits_of(keys: np.ndarray) -> np.ndarray:
    one = U64(1)
    return (one << (keys & U64(63))) | (one << (keys >> U64(6) & U64(63))) | (one << (keys >> U64(12) & U64(63)))


def _segments(log_words: int):
    """Rows (segment, words) of the bitmap from keys that come sorted."""

    def run(batches):
        now, words = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([words.tobytes()], pa.binary())], names=["segment", "words"])

        for batch in batches:
            keys = batch.column("key").to_numpy().view(U64)
            place = (keys >> U64(KEY_BITS - log_words)).astype(np.int64)
            segment = place // SEGMENT
            for s in np.unique(segment).tolist():
                if s != now:
                    if now is not None:
                        yield row()
                    now, words = s, np.zeros(SEGMENT, "<u8")
                own = segment == s
                np.bitwise_or.at(words, place[own] % SEGMENT, _bits_of(keys[own]))
        if now is not None:
            yield row()

    return run


def bitmap(survivors: DataFrame) -> tuple[np.ndarray, int]:
    """The bitmap's 64-bit words and the logarithm of their number: 16 bits a survivor, at most MAX_BITS."""
    n = survivors.count()
    log_words = min(max((n // 4).bit_length(), 13), (MAX_BITS >> 6).bit_length() - 1)
    out = np.zeros(1 << log_words, U64)
    segment = F.shiftright("key", KEY_BITS - log_words + 13)
    rows = survivors.repartition(segment).sortWithinPartitions("key").mapInArrow(_segments(log_words), "segment int, words binary")
    for row in rows.toLocalIterator():
        out[row.segment * SEGMENT :][:SEGMENT] |= np.frombuffer(row.words, "<u8")
    return out, log_words


def _exact_counts(order: int, held, log_words: int):
    """Rows (lang, phrase, n) of what passes the bitmap, and per language a row with an empty phrase and the number of words."""

    def passing(keys, words):
        own = _bits_of(keys)
        return words[(keys >> U64(KEY_BITS - log_words)).astype(np.int64)] & own == own

    def run(batches):
        words = held.value
        for batch in pieces(batches, TEXT):
            w = Words(batch)
            total = len(w.hashes)
            if not total:
                continue
            codes, names = w.codes()
            base = len(names) + 1
            langs, phrases, counts = [], [], []

            def add(lang, phrase, n):
                langs.append(pa.DictionaryArray.from_arrays(pa.array(lang, pa.int32()), pa.array(w.langs, pa.string())).cast(pa.string()))
                phrases.append(phrase)
                counts.append(pa.array(n, pa.int64()))

            each = np.bincount(w.lang, minlength=len(w.langs))
            some = np.flatnonzero(each)
            add(some, pa.array([""] * len(some), pa.string()), each[some])
            before = None  # number of the n-gram at each position, -1 if it does not pass
            for n, at, keys in w.keys(order):
                if n == 1:
                    at = at[passing(keys, words)]
                    number = w.lang[at].astype(np.int64) * base + codes[at]
                else:
                    parts = (before[at] >= 0) & (before[at + 1] >= 0)
                    at, keys = at[parts], keys[parts]
                    at = at[passing(keys, words)]
                    number = before[at] * base + codes[at + n - 1]
                if not len(at):
                    break
                distinct, first, inverse, times = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
                before = np.full(total, -1, np.int64)
                before[at] = inverse
                where = at[first]
                text = [names.take(pa.array(codes[where + k])) for k in range(n)]
                add(w.lang[where], pc.binary_join_element_wise(*text, pa.scalar(" ", pa.large_string())).cast(pa.string()), times)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in (langs, phrases, counts)], names=["lang", "phrase", "n"])

    return run


def frequent_ngrams(ws: Workspace, docs: DataFrame, threshold: int = THRESHOLD, order: int = ORDER, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (lang, phrase, n): the exact count of every n-gram of 1 to ``order`` words that occurs at least ``threshold`` times.

    A row with an empty phrase holds the number of words of the language, however small.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    bits = min(max(int(size * 0.6 / PART_MASS), 1).bit_length(), MAX_PARTITIONS.bit_length() - 1)
    counted = texts.mapInArrow(_partition_counts(order, bits), "part int, mass long, counts binary")
    dealt = counted.repartitionById(1 << bits, "part").sortWithinPartitions("part")
    survivors = ws.save(dealt.mapInArrow(_survivors(threshold), "key long"), "survivors")
    words, log_words = bitmap(survivors)
    held = docs.sparkSession.sparkContext.broadcast(words)
    exact = texts.mapInArrow(_exact_counts(order, held, log_words), "lang string, phrase string, n long")
    exact = exact.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return ws.save(exact.where((F.col("n") >= threshold) | (F.col("phrase") == "")), "ngrams")


def collocations(ws: Workspace, ngrams: DataFrame, order: int = ORDER, top: int = 2000) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score, all numbers long.

    Cutting a phrase gives the counts l and r of its parts and the score floor(1000 * a * n / (l * r)); the lowest counts, of equal ones that
    with the shortest first part. Phrases that a longer frequent one holds equally often are left out.
    """
    key = lambda phrase: F.concat(F.col("lang"), F.lit("\t"), phrase)  # noqa: E731  (words hold no tab)
    phrases = ngrams.where("phrase <> ''").withColumn("words", F.size(F.split("phrase", " ")))
    candidates = phrases.where("words > 1")
    # both parts of every cut, with their counts
    sides = F.expr(
        "flatten(transform(sequence(1, words - 1), k -> array("
        "named_struct('k', k, 'side', 'l', 'part', substring_index(phrase, ' ', k)),"
        "named_struct('k', k, 'side', 'r', 'part', substring_index(phrase, ' ', k - words)))))"
    )
    cuts = candidates.select("lang", "phrase", F.explode(sides).alias("cut")).select("lang", "phrase", "cut.*")
    cuts = ws.save(cuts.withColumn("key", key(F.col("part"))).drop("part"), "cuts")
    uses = cuts.groupBy("key").agg(F.count("*").alias("uses"))
    parts = phrases.where(F.col("words") < order).select(key(F.col("phrase")).alias("key"), F.col("n").alias("f"))
    parts = ws.save(parts.join(uses, "key"), "parts")
    counted = join_by_key(cuts, parts, "key", "uses")
    pivot = [F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f"))).alias(f"{s}{k}") for k in range(1, order) for s in "lr"]
    counted = counted.groupBy("lang", "phrase").agg(*pivot)
    # the largest count of a longer candidate around each phrase
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
    )
    around = (
        candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("outer"))
        .groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    )
    kept = candidates.join(around, ["lang", "phrase"], "left").where("outer is null or outer < n").select("lang", "phrase", F.col("n").alias("a"))
    totals = ngrams.where("phrase = ''").select("lang", F.col("n").alias("total"))
    held = kept.groupBy("lang").agg(F.count("*").alias("uses"))
    rows = join_by_key(ws.save(kept.join(counted, ["lang", "phrase"]), "counted"), ws.save(totals.join(held, "lang"), "totals"), "lang", "uses")
    # wide enough for 10^14 occurrences of a phrase in 10^17 words, and exact
    product = "cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(total as decimal(17,0))"
    scored = []
    for k in range(1, order):
        score = F.expr(f"({product}) div (cast(l{k} as decimal(18,0)) * cast(r{k} as decimal(18,0)))")
        cut = F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        scored.append(F.when(F.col(f"l{k}").isNotNull(), cut))
    rows = rows.withColumn("best", F.least(*scored) if len(scored) > 1 else scored[0])
    rows = rows.select("lang", "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score")
    # a language's first rows among those of each of some shares, then among what is left
    share = F.pmod(F.hash("phrase"), F.lit(SHARES))
    for group in (["lang", share], ["lang"]):
        order_by = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        rows = rows.withColumn("rank", F.row_number().over(order_by).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocation_sql(threshold: int = THRESHOLD, top: int = 2000) -> str:
    return f"""
    WITH docs AS (
      SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    ), pieces AS (
      SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM docs
    ), worded AS (
      SELECT lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
    ), totals AS (
      SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang
    ), grams AS (
      SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)]) AS phrase
      FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m
    ), f AS (
      SELECT lang, m, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY lang, m, phrase HAVING count(*) >= {threshold}
    ), cuts AS (
      SELECT lang, m, phrase, a, unnest(range(1, m)) AS k FROM f WHERE m > 1
    ), parted AS (
      SELECT *, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS p1, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS p2 FROM cuts
    ), scored AS (
      SELECT c.lang, c.m, c.phrase, c.a, c.k, x.a AS l, y.a AS r, n, (1000 * c.a * n) // (x.a * y.a) AS score
      FROM parted c JOIN f x ON x.lang = c.lang AND x.phrase = c.p1 JOIN f y ON y.lang = c.lang AND y.phrase = c.p2 JOIN totals t ON t.lang = c.lang
    ), best AS (
      SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), spans AS (
      SELECT lang, a, phrase, string_split(phrase, ' ') AS w, m, unnest(range(2, m)) AS s FROM f WHERE m > 2
    ), inner_phrases AS (
      SELECT lang, a, unnest([array_to_string(w[i:i + s - 1], ' ') for i in range(1, m - s + 2)]) AS phrase FROM spans
    ), around AS (
      SELECT lang, phrase, max(a) AS outside FROM inner_phrases GROUP BY lang, phrase
    ), kept AS (
      SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE outside IS NULL OR 100 * outside < 100 * b.a
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
           a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept QUALIFY rank <= {top}
    """
