"""Archives, token files, BPE, chat formatting, nearest neighbours and page text: round trips, brute force, edge rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest

from ticketmill.llm import bitpack, bpe, chat, mainhtml, voronoi, warc

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

ALPHABET = ["a", "b", "the", "ing", " ", "  ", "   ", "\n", "\t", "É", "ß", "ΑΣ", "é", "1", "23", "!", "?!", "<|endoftext|>", "<|startoftext|>", "<|", "'s"]
ALPHABET += ["'LL", "\x1c", "\x1f", "\xa0", "　", "日本", "😀", "é", "İ", "\x00", "\x85", "aaaaaaaa", "​", "½", "word,", "end. "]


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(public.path("word_bpe_49k.json"))


def test_bpe_equals_the_library(coder):
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    for text in [*random_texts(800), "a" * 5000, "ha" * 3000, "the" * 2000 + "n", "é" * 700, "".join(random.Random(4).choices("abcdehinorst", k=20000))]:
        want = library.encode(text, add_special_tokens=False).ids
        n, _ = coder.coded(text)
        assert coder.encode(text) == want and n == len(want)
        assert bpe.decode(coder, want, library=True) == library.decode(want, skip_special_tokens=False)


def test_digests_of_long_texts_are_the_library_s(spark):
    """Texts of several blocks, special strings, ids and decoded text from the stream."""
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    r = random.Random(7)
    special = next(iter(bpe.Coder(public.path("word_bpe_49k.json")).specials), "x")
    texts = [" ".join(random_texts(6000, seed=s)) for s in (2, 3)] + [" ", "\u00a0", special, f"a{special}b {special}", "ab " * (2 * bpe.RUNS), "x" * 30_000]
    texts += ["".join(r.choice("abcxyz .,'-\n") for _ in range(50_000))]
    got = bpe.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), public.path("word_bpe_49k.json"))
    want = {}
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in got.collect()} == want


def test_blocks_go_through_both_decoders(coder):
    text = "the wörld 😀 " * 40
    _, ids = coder.coded(text)
    for library in (True, False):
        machine, parts = bpe.Decoder(coder, library), ids.split(b" ")
        out = b"".join([machine.feed_decimals(b" ".join(parts[k : k + 7])) for k in range(0, len(parts), 7)]).decode() + machine.close()
        assert out == bpe.decode(coder, coder.encode(text), library)
    assert bpe.Decoder(coder, True).feed_decimals(b"") == b"" and bpe.Decoder(coder, True).feed_decimals(b"99999999") == b""


def test_transducer_keeps_a_bounded_window(coder):
    machine, out = bpe.Transducer(coder.merges), []
    for _ in range(2000):
        out += machine.feed("tharon")
        assert len(machine.text) <= 4 * coder.merges.lookahead + 1
    assert out + machine.close() == coder.word("tharon" * 2000)


def test_decoding_to_text(coder):
    text = "hello the wörld 😀 123"
    assert bpe.decode(coder, coder.encode(text)).split() == ["hello", "the", "wörld", "😀", "1", "2", "3"]
    machine = bpe.Decoder(coder)
    broken = coder.merges.ids[coder.alphabet[0xF0]]
    assert machine.feed(broken) == "" and machine.close() == "�"


def test_bpe_rows(spark):
    docs = spark.createDataFrame([(1, "a cat", 5), (2, None, 5), (None, "", 5), (1, "a cat", 5)], "doc_id long, text string, n_tokens int")
    got = bpe.digests(docs, public.path("word_bpe_49k.json")).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 2, 2] and len({r.ids_sha256 for r in got}) == 2
    assert bpe.digests(docs.limit(0), public.path("word_bpe_49k.json")).count() == 0
    assert [len(r.ids) for r in bpe.encode_texts(docs, public.path("word_bpe_49k.json")).collect()] == [2, 0, 0, 2]


def test_pack_and_unpack():
    r = np.random.default_rng(0)
    for bits in (1, 5, 16, 17, 31, 32):
        for n in (0, 1, 63, 64, 65, 1000):
            ids = r.integers(0, 1 << bits, n).astype(np.uint32)
            assert (bitpack.unpack(bitpack.pack(ids, bits), bits, n) == ids).all()
    assert [bitpack.bits_for(v) for v in (1, 2, 3, 50_257, 1 << 16, (1 << 16) + 1)] == [1, 1, 2, 16, 16, 17]


def test_token_file_random_access(tmp_path):
    r = np.random.default_rng(1)
    docs = [r.integers(0, 50_257, n).astype(np.uint32) for n in (0, 3, 500, 1, 64, 2000, 0)]
    fs = pafs.LocalFileSystem()
    writer = bitpack.Writer(fs.open_output_stream(str(tmp_path / "x.tok")), 16, block=128)
    for i, ids in enumerate(docs):
        writer.add(i * 10, ids)
    writer.close()
    with fs.open_input_file(str(tmp_path / "x.tok")) as source:
        reader = bitpack.Reader(source)
        assert [(d, s, ids.tolist()) for d, s, ids in reader.documents()] == [
            (i * 10, sum(map(len, docs[:i])), ids.tolist()) for i, ids in enumerate(docs)
        ]
        whole = np.concatenate(docs)
        for a, b in ((0, 1), (100, 300), (127, 129), (2567, 2568), (5, 5)):
            assert (reader.slice(a, b) == whole[a:b]).all()


def test_pieces_equal_the_library():
    path = public.path("byte_bpe_50k.json")
    library, own = tokenizers.Tokenizer.from_file(path), bitpack.Encoder(path)
    texts = random_texts(1500, seed=2)
    assert [x.tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files_read_back(spark, ws):
    path = public.path("byte_bpe_50k.json")
    rows = [(5, "five five"), (1, None), (3, ""), (2, "two " * 3000), (4, "x"), (4, "a x"), (None, "none")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int")
    got = bitpack.read_index(bitpack.write_tokens(ws, docs, path, end_id=2, vocabulary=50_257)).collect()
    library = tokenizers.Tokenizer.from_file(path)
    at, want = 0, []
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0], x[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert bitpack.read_index(bitpack.write_tokens(ws, docs.limit(0), path, 2, 50_257)).count() == 0


def test_archives(spark, ws):
    rows = [(3, "http://a/\r\nx", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (5, "u", ""), (4, "u", "y" * 400_000), (None, "u", "z"), (None, "v", "q"), (None, "w", None), (None, "w", None), (9, "u", "y" * 400_000), (-4, "u", "q")]
    pages = spark.createDataFrame([(*r, "no") for r in rows], "page_id long, url string, html string, record_type string")
    manifest = warc.write_archives(ws, pages, frame_bytes=1000)
    rows_out = warc.read_archives(manifest).collect()
    without = sorted((r.record_type, r.refers_to, r.payload_bytes) for r in rows_out if r.page_id is None and r.payload_bytes != 1)
    assert without == [("revisit", 2, 0), ("revisit", 2, 0)]
    assert sorted((r.record_type, r.refers_to) for r in rows_out if r.page_id is None and r.payload_bytes == 1) == [("response", None), ("revisit", -4)]
    got = {r.page_id: r for r in rows_out if r.page_id is not None}
    assert len(rows_out) == len(got) + 4
    assert {i: (r.record_type, r.refers_to, r.payload_bytes) for i, r in got.items()} == {
        1: ("response", None, 9), 3: ("revisit", 1, 9), 2: ("response", None, 0), 5: ("revisit", 2, 0),
        4: ("response", None, 400_000), 9: ("revisit", 4, 400_000), -4: ("response", None, 1),
    }
    for m in manifest.collect():  # each record is found alone by its place
        headers, block = warc.read_record(m.bundle, m.frame, m.offset)
        assert warc.page_of(headers["WARC-Record-ID"]) == m.page_id
        if m.page_id is not None:
            assert headers["WARC-Payload-Digest"].endswith(got[m.page_id].payload_digest)
        if m.page_id == 1:
            assert block.endswith("<p>é</p>".encode())
    below = warc.read_archives(warc.write_archives(ws, pages, revisit_from=10)).where("record_type = 'revisit'").collect()
    assert [(r.page_id, r.refers_to) for r in below] == [(9, 4)]
    assert warc.read_archives(warc.write_archives(ws, pages.limit(0))).count() == 0


def talk(spark, rows):
    return chat.gather(spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, status string"))


def test_preference_rows(spark):
    base = [("user", "q"), ("assistant", "a")]
    cases = {
        1: (base + [("user", "r"), ("assistant", "good")], base + [("user", "r"), ("assistant", "bad")], ("pair", 3)),
        2: (base, base, ("identical", 2)),
        3: (base + [("user", "r")], base, ("extension", 2)),
        4: (base, [("system", "s"), ("user", "q")], ("no_reply", 0)),
        5: (base + [(None, None)], base + [(None, "t")], ("no_reply", 2)),
    }
    side = lambda k: talk(spark, [(i, n, *t) for i, c in cases.items() for n, t in enumerate(c[k])] + [(None, 0, "user", "lost")])
    pairs = side(0).withColumnRenamed("turns", "chosen").join(side(1).withColumnRenamed("turns", "rejected"), "pair_id")
    got = {r.pair_id: r for r in chat.preference_rows(pairs).collect()}
    assert {i: (r.status, r.prompt_turns) for i, r in got.items()} == {i: c[2] for i, c in cases.items()}
    one = got[1]
    assert one.prompt == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n<|user|>\nr<|end|>\n"
    assert one.chosen == "<|assistant|>\ngood<|end|>\n" and one.rejected == "<|assistant|>\nbad<|end|>\n"
    for text, mask in ((one.chosen, one.chosen_mask), (one.rejected, one.rejected_mask)):
        runs = [tuple(map(int, x.split(":"))) for x in mask.split(",")]
        assert sum(n for n, _ in runs) == len(text) and [f for _, f in runs] == [0, 1]
    assert chat.preference_rows(pairs.limit(0)).count() == 0


@pytest.mark.parametrize("pivots", [1, 4])
def test_top_k_equals_brute_force(spark, ws, monkeypatch, pivots):
    monkeypatch.setattr(voronoi, "BLOCK", 16)
    monkeypatch.setattr(voronoi, "QUERY_BLOCK", 8)
    r = np.random.default_rng(5)
    vectors = [(i, (r.normal(size=6) + 5 * (i % 3)).tolist()) for i in range(150)]
    vectors += [(200 + i, [1.0] * 6) for i in range(40)]  # one vector many times
    odd = [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6)]
    vectors += [(304, [1.0] * 3), (310, [])]  # filled up with zeros
    df = spark.createDataFrame([(*v, 1) for v in vectors + odd], "vec_id long, embedding array<double>, score int")
    got = voronoi.top_k(ws, df, df.where("vec_id % 10 = 0"), k=10, pivots=pivots).collect()
    whole = {i: np.floor(np.array(v + [0.0] * (6 - len(v))) * 1024).astype(int) for i, v in vectors}
    want = []
    for q in whole:
        if q % 10 == 0:
            best = sorted((-int(whole[q] @ x), i) for i, x in whole.items() if i != q)[:10]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_few_rows(spark, ws):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in voronoi.top_k(ws, df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert voronoi.top_k(ws, df.limit(0), df).count() == 0
    assert voronoi.top_k(ws, df, df.limit(0)).count() == 0


def test_queries_go_to_few_cells_of_clustered_vectors(spark, ws):
    r = np.random.default_rng(6)
    centres = 20 * r.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + r.normal(size=8)).tolist()) for i in range(2400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = voronoi.top_k(ws, df, df.where("vec_id % 20 = 0"), k=5, pivots=24).collect()
    whole = np.floor(np.array([v for _, v in rows]) * 1024).astype(int)
    for q in range(0, 2400, 400):
        best = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)[:5]
        assert [(x.vec_id, x.score) for x in sorted(got, key=lambda x: x["rank"]) if x.query_id == q] == [(i, -s) for s, i in best]
    assert spark.read.parquet(f"{ws.base}/*-sent").count() < 120 * 24 / 2


def test_minimum_cut_equals_all_labellings():
    r = random.Random(2)
    for _ in range(60):
        n = r.randrange(1, 8)
        odds = [r.choice([-3, -2, -1, 1, 2, 3]) + r.random() for _ in range(n)]
        edges = [(i, j, r.random() * 2) for i in range(n) for j in range(i) if r.random() < 0.5]
        cost = lambda keep: sum(abs(x) for x, k in zip(odds, keep) if (x > 0) != k) + sum(w for a, b, w in edges if keep[a] != keep[b])  # noqa: E731, B023
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(mainhtml.minimum_cut(odds, edges)) == pytest.approx(best)


PAGES = {
    "<html><head><title>T</title></head><body><div id='header'><a href=/>Home</a></div><ul class=menu><li><a>One</a><li><a>Two</a></ul>"
    "<div class='content'><h2>Heading</h2><p>First paragraph of a story, with a good number of words.<p>Second &amp; last&nbsp;one, again\n long enough.</div>"
    "<div class=sidebar>Related</div><div class=comments><p>Great post, I really liked every word!</p></div><div id=footer>Copyright</div>":
        "Heading\nFirst paragraph of a story, with a good number of words.\nSecond & last one, again long enough.",
    "<article><p>Unclosed <b>bold<p>Next 5 < 6<script>var a='<p>no</p>';</script><style>p{}</style><!-- c --><p>Short.</article><div class=cookie-notice>We use cookies</div>":
        "Unclosed bold\nNext 5 < 6\nShort.",
    "<main><article><header><h1>Title</h1></header><p>Body text.</p><div class='ad'>Buy</div><aside>Aside</aside><form><button>Go</button></form>"
    "<section class='comments'><p>Nice</p></section><footer>By me</footer></article></main>": "Title\nBody text.",
    "<nav>Menu</nav>": "",
    "": "",
}


def test_main_text(spark):
    for page, want in PAGES.items():
        assert mainhtml.main_text(page) == want
    df = spark.createDataFrame([(1, "u", list(PAGES)[1], 1), (2, None, None, 1), (None, "u", "", 1)], "page_id long, url string, html string, n_chars int")
    got = mainhtml.extract(df).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", 31), (2, None, 0), (None, "u", 0)]
    long = "<article>" + "<p>Some words here.</p>" * 5000 + "</article>"
    assert mainhtml.main_text(long).count("\n") == 4999
    assert mainhtml.main_text("<div>" * 3000 + "x") == mainhtml.main_text("<div>x")
