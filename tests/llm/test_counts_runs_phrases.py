"""Token counts, periodic runs and collocations: the library, brute force and SQL on small tables with edge rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest

from ticketmill.llm import collocations, periodic, tokencount
from ticketmill.session import Workspace

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
VOCABULARY = public.path("byte_bpe_50k.json")

BITS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "É", "ß", "é", "1", "23", "!", "?!", "<|endoftext|>", "<|", "'s", "'ll", "\x1c", "\x85"]
BITS += ["\xa0", "　", "日本", "😀", "՘", "꟎", "\U00010d50", "aaaaaaaa", "½", "\x00"]


@pytest.fixture(scope="module")
def proof():
    return tokencount.prove(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(VOCABULARY)


def test_whole_tokens_are_one_token_to_the_library(proof, library):
    texts = sorted(proof.whole)
    assert len(texts) > 45_000
    got = library.encode_batch(texts, add_special_tokens=False)
    assert all(len(e.ids) == 1 for e in got)


def test_counts_equal_the_library(proof, library):
    r = random.Random(3)
    texts = ["".join(r.choice(BITS) for _ in range(r.randrange(60))) for _ in range(2000)]
    texts += ["ab" * 20000, "x" * 5000, " " * 4000, "ha ho " * 100_000, "日" * 3000, "zq" * 30 + " end"]
    counter = tokencount.Counter(proof, VOCABULARY)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == want
    assert len(counter.kept) <= tokencount.KEPT


def test_shortcut_and_merges_agree(proof):
    alone = tokencount.Counter(proof._replace(whole=frozenset()), VOCABULARY)
    both = tokencount.Counter(proof, VOCABULARY)
    for text in ("the cat sat", " of the  people's", "unbelievable antidisestablishment"):
        assert alone.count(text) == both.count(text)


def test_token_count_rows(spark, library):
    rows = [(1, "a cat é", 7), (2, None, 7), (None, "", 7), (1, "a cat é", 7), (5, "word " * 600, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = tokencount.token_counts(docs, VOCABULARY).collect()
    key = lambda x: (x[0] or 0, x[1])
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert tokencount.token_counts(docs.limit(0), VOCABULARY).count() == 0


def plain_runs(w, least, times):
    """Every stretch with a period by definition."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            smaller = any(all(w[x] == w[x + p] for x in range(s, s + n - p)) for p in range(1, q))
            if n >= max(least, times * q) and not smaller:
                out.append((s, n, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 3), (4, 2), (10, 2), (40, 5)])
def test_runs_equal_the_definition(least, times):
    r, found = random.Random(least), 0
    for _ in range(300):
        letters = r.choice([1, 2, 3, 5, 30])
        w = [bytes([97 + r.randrange(letters)]) for _ in range(r.randrange(100))]
        if w:
            a, p = r.randrange(len(w)), r.randrange(1, 12)
            w = w[:a] + (w[a : a + p] * 40)[: r.randrange(120)] + w[a:]
        want = plain_runs(w, least, times)
        found += len(want)
        assert periodic.periodic_runs(periodic.coded(w), least, times) == want
    assert found > 50


def test_ranks_order_the_suffixes():
    r = random.Random(5)
    for _ in range(100):
        codes = np.array([r.randrange(3) for _ in range(r.randrange(1, 80))])
        rank, deep, _ = periodic.suffix_ranks(codes, 4)
        order = np.argsort(rank).tolist()
        assert order == sorted(range(len(codes)), key=lambda i: codes[i:].tolist())
        windows = Counter(tuple(codes[i : i + 4].tolist()) for i in range(len(codes) - 3))
        assert deep.tolist() == [i for i in range(len(codes) - 3) if windows[tuple(codes[i : i + 4].tolist())] > 1]


def test_repeated_windows_are_never_missed():
    r = random.Random(6)
    texts = [" ".join(r.choice("ab") for _ in range(r.randrange(60))) for _ in range(300)] + [None, "", "x"]
    got = periodic.has_twice(pa.array(texts, pa.large_string()), 6)
    for text, flag in zip(texts, got.tolist()):
        w = (text or "").split()
        windows = [tuple(w[i : i + 6]) for i in range(len(w) - 5)]
        assert flag == (len(windows) > len(set(windows)))


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    w = periodic.repeated_tail(w, doc_id) or w
    runs = plain_runs(w, 24, 3)
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    kept = b" ".join([x for i, x in enumerate(w) if i not in gone])
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_rows(spark):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(["x", "y", "Zed", "é"]) for _ in range(r.randrange(90))) + " x y" * r.choice([0, 0, 30]), i) for i in range(120)]
    rows += [(200, None, 1), (201, "", 1), (202, " \t\n ", 1), (None, "a b " * 30, 1), (3, "b " * 30, 1), (203, "one " * 5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, period int")
    got = periodic.run_rows(docs, change=periodic.repeated_tail).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[-1])
    assert sorted(map(tuple, got), key=key) == sorted([plain_row(i, t) for i, t, _ in rows], key=key)
    assert any(x.n_runs for x in got) and periodic.run_rows(docs.limit(0)).count() == 0


def test_planted_rule():
    import zlib

    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    words = [b"%d" % i for i in range(100)]
    for i in ids:
        g = zlib.crc32(str(i).encode()) // 10
        a, p = g % 100, 1 + (100 - g % 100) // (3 + g % 8)
        assert periodic.repeated_tail(words, i) == [words[x if x < a else a + (x - a) % p] for x in range(100)]
    assert periodic.repeated_tail(words, next(i for i in range(400) if i not in ids)) is None
    assert periodic.repeated_tail([], ids[0]) is None and periodic.repeated_tail(words, None) is None


def test_packed_counts_come_back():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 1 << 48, 5000, dtype=np.uint64))
    counts = r.integers(1, 4, len(keys))
    a, b = collocations.summed(*collocations.unpack_counts(collocations.pack_counts(keys, counts)))
    assert (a == keys).all() and (b == counts).all()
    none = np.zeros(0, np.uint64)
    assert [len(x) for x in collocations.unpack_counts(collocations.pack_counts(none, none.view(np.int64)))] == [0, 0]


def test_merged_summaries_keep_what_is_frequent():
    r = random.Random(2)
    for _ in range(60):
        stream = [r.choice([r.randrange(5), r.randrange(400)]) for _ in range(2000)]
        threshold = r.choice([20, 60])
        parts = []
        for s in range(0, 2000, 250):
            own = collocations.Summary(len(stream) // threshold + 1)
            for t in range(s, s + 250, 50):
                k, c = np.unique(np.array(stream[t : t + 50], np.uint64), return_counts=True)
                own.merge(k, c)
            parts.append(own)
        whole = parts[0]
        for p in parts[1:]:
            whole.merge(p.keys, p.counts, p.error)
        assert whole.error < threshold
        true = Counter(stream)
        assert {k for k, n in true.items() if n >= threshold} <= set(whole.reaching(threshold).tolist())
        assert all(true[k] - whole.error <= c <= true[k] for k, c in zip(whole.keys.tolist(), whole.counts.tolist()))


def sample_documents(spark, n=400):
    r = random.Random(11)
    words = ["Alpha", "beta", "gamma", "DELTA", "of", "the", "eps", "é", "日本"]
    fixed = ["new york city", "of the", "big red dog of the house", "a  b\tc d e f g"]
    rows = []
    for i in range(n):
        text = "".join(r.choice([*words, *fixed]) + r.choice([" ", " ", " ", ", ", ". ", "\n", "\t", "; "]) for _ in range(r.randrange(30)))
        rows.append((i, text, r.choice(["en", "en", "en", "de", None, "und"]), "x"))
    rows += [(None, None, "en", "x"), (1, "", None, "x"), (2, " ,. ", "zz", "x"), (3, "one", "yy", "x"), (4, "go go " * 300, "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string"), rows


def plain_counts(rows, threshold):
    import re

    counts, totals = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            totals[lang] += len(w)
            counts.update((lang, " ".join(w[i : i + m])) for m in range(1, 6) for i in range(len(w) - m + 1))
    return {k: n for k, n in counts.items() if n >= threshold}, totals


def plain_collocations(rows, threshold, top):
    f, totals = plain_counts(rows, threshold)
    by_lang: dict[str, list] = {}
    for (lang, phrase), a in f.items():
        w = phrase.split(" ")
        if len(w) < 2:
            continue
        cuts = []
        for k in range(1, len(w)):
            l, r = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        inside = any(g >= a and x == lang and len(p.split(" ")) > len(w) and f" {phrase} " in f" {p} " for (x, p), g in f.items())
        if not inside:
            by_lang.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, a, l, r, totals[lang], score))
    return {(lang, i + 1, *x[3:]) for lang, xs in by_lang.items() for i, x in enumerate(sorted(xs)[:top])}


@pytest.mark.parametrize(("threshold", "top"), [(20, 2000), (40, 7)])
def test_collocations_equal_brute_force(spark, threshold, top):
    docs, rows = sample_documents(spark)
    ws = Workspace(spark)
    grams = collocations.frequent_ngrams(ws, docs.repartition(3), threshold)
    f, totals = plain_counts(rows, threshold)
    got = {(r.lang, r.phrase): r.n for r in grams.collect()}
    assert {k: n for k, n in got.items() if k[1]} == f
    assert {k[0]: n for k, n in got.items() if not k[1]} == {k: n for k, n in totals.items() if n}
    assert set(map(tuple, collocations.collocations(ws, grams, top=top).collect())) == plain_collocations(rows, threshold, top)


def test_a_full_bitmap_only_costs_work(spark, monkeypatch):
    docs, rows = sample_documents(spark)
    monkeypatch.setattr(collocations, "bitmap", lambda survivors: (np.full(1 << 13, -1, np.int64).view(np.uint64), 13))
    grams = collocations.frequent_ngrams(Workspace(spark), docs, 20)
    assert {(r.lang, r.phrase): r.n for r in grams.collect() if r.phrase} == plain_counts(rows, 20)[0]


def test_no_words_no_rows(spark):
    docs = spark.createDataFrame([(1, None, None), (2, " .", "en")], "doc_id long, text string, lang string")
    for some in (docs, docs.limit(0)):
        ws = Workspace(spark)
        grams = collocations.frequent_ngrams(ws, some)
        assert grams.count() == 0 and collocations.collocations(ws, grams).count() == 0


def test_exact_where_products_pass_64_bits(spark):
    big = 3_000_000_000_007
    rows = [("en", "", 20 * big), ("en", "a", 2 * big), ("en", "b", big + 3), ("en", "a b", big)]
    got = collocations.collocations(Workspace(spark), spark.createDataFrame(rows, "lang string, phrase string, n long")).collect()
    assert [(r.phrase, r.score) for r in got] == [("a b", 1000 * big * 20 * big // (2 * big * (big + 3)))]


def test_pieces_and_neighbours():
    batch = pa.RecordBatch.from_pydict({"text": ["A b, c d e", "", "f.g h", "i"], "lang": ["x", "x", "y", "x"]})
    w = collocations.Words(batch)
    assert w.left.tolist() == [2, 1, 3, 2, 1, 1, 2, 1, 1]
    sizes = [len(at) for _, at, _ in w.keys(3)]
    assert sizes == [9, 4, 1] and all(a < b for a, b in pairwise(w.starts.tolist()))
