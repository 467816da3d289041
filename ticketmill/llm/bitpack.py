"""Token ids in files of fixed-width packed blocks, with random access.

A file has a 32-byte header (magic, bits, block size, number of tokens, of documents, of blocks), the blocks, and an
index: the byte offset of each block, and id and first token of each document. Each id takes the least number of bits that
holds the vocabulary, least significant bit first. 64 ids of b bits fill b 64-bit words, so both directions are 64 numpy
steps over all such groups of a block at once.

Documents are range-partitioned by id; each task encodes its texts and writes one file under a fresh name, so a task that is
lost and run again leaves at most a file nobody names. The manifest the tasks return (file, tokens, documents, first id) is
the directory of the corpus; positions across files are running sums over it.

Ids are those of the ``tokenizers`` library. Byte-level pre-tokens never reach across a blank between two other
characters, and a line feed between two others is a token of its own; so each distinct piece between such blanks and feeds
is encoded once per worker, by the library, and put together.

Null and empty texts hold only the end id. Null ids sort first. Rows that share an id are ordered by their text.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.bpe import worker_state
from ticketmill.llm.hashing import pieces
from ticketmill.session import Workspace

MAGIC = b"TOKBITS1"
HEADER = "<8sIIIIQ"  # magic, bits, block size, documents, blocks, tokens
HEADER_SIZE = struct.calcsize(HEADER)
BLOCK = 1 << 16  # ids of a block, a multiple of 64
PIECES = 400_000  # pieces kept per Python worker, twice
MANY_PIECES = 1_000  # distinct pieces of a column from which it pays to part words and marks in the column
FILE_TOKENS = 1 << 26  # a longer partition goes on in another file


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as packed little-endian 64-bit words; the last group of 64 is filled with zeros."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, np.uint64)
    padded[: len(ids)] = ids
    lanes = padded.reshape(groups, 64).T
    words = np.zeros((bits, groups), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[word] |= lanes[k] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return words.T.astype("<u8").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    groups = -(-count // 64)
    words = np.frombuffer(data, "<u8", groups * bits).reshape(groups, bits).T
    lanes = np.empty((64, groups), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        lanes[k] = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[k] |= words[word + 1] << np.uint64(64 - shift)
    return (lanes & mask).T.reshape(-1)[:count].astype(np.uint32)


class Writer:
    """One file, block by block; the index stays in memory until the end (16 bytes a document, 8 a block)."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.held: list[np.ndarray] = []
        self.waiting = self.tokens = 0
        self.at = HEADER_SIZE
        self.offsets: list[int] = []
        self.docs: list[int] = []
        self.starts: list[int] = []
        out.write(struct.pack(HEADER, MAGIC, bits, block, 0, 0, 0))

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.tokens)
        self.tokens += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 16 * self.block:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        full = len(ids) if last else len(ids) // self.block * self.block
        for s in range(0, full, self.block):
            data = pack(ids[s : min(s + self.block, full)], self.bits)
            self.offsets.append(self.at)
            self.at += len(data)
            self.out.write(data)
        self.held, self.waiting = [ids[full:]], len(ids) - full

    def close(self) -> None:
        """The last block, the index, and a footer that repeats the header with its numbers."""
        self._blocks(True)
        for x in (self.offsets, self.docs, self.starts):
            self.out.write(np.array(x, "<i8").tobytes())
        self.out.write(struct.pack(HEADER, MAGIC, self.bits, self.block, len(self.docs), len(self.offsets), self.tokens))
        self.out.close()


class Reader:
    """Random access to the documents and tokens of one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - HEADER_SIZE)
        magic, self.bits, self.block, docs, blocks, self.tokens = struct.unpack(HEADER, source.read(HEADER_SIZE))
        if magic != MAGIC:
            raise ValueError("not a token file")
        index = 8 * (blocks + 2 * docs)
        source.seek(size - HEADER_SIZE - index)
        held = np.frombuffer(source.read(index), "<i8")
        self.offsets, self.docs, self.starts = held[:blocks], held[blocks : blocks + docs], held[blocks + docs :]

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids start to end; reads only the blocks they are in."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        out = []
        for b in range(first, last + 1):
            count = min(self.block, self.tokens - b * self.block)
            self.source.seek(int(self.offsets[b]))
            out.append(unpack(self.source.read(-(-count // 64) * 8 * self.bits), self.bits, count))
        return np.concatenate(out)[start - first * self.block : end - first * self.block]

    def documents(self):
        """(id, first token, ids) of each document, a stretch of blocks at a time."""
        ends = np.r_[self.starts[1:], self.tokens]
        at = 0
        while at < len(self.docs):
            to = max(at + 1, int(np.searchsorted(ends, self.starts[at] + 16 * self.block, side="right")))
            ids = self.slice(int(self.starts[at]), int(ends[to - 1]))
            base = self.starts[at]
            for d in range(at, to):
                yield int(self.docs[d]), int(self.starts[d]), ids[self.starts[d] - base : ends[d] - base]
            at = to


class Encoder:
    """Whole texts to ids of a byte-level vocabulary, each distinct piece through the library once."""

    cut = regex.compile(r"(?<=\S) (?=\S)")
    # texts in which a blank may stand beside other white space; too many of them only cost time
    gap = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}|^[\s\x0b\x1c-\x1f\x{85}\p{Z}]|[\s\x0b\x1c-\x1f\x{85}\p{Z}]$"
    # letters, then a run of other characters: never one pre-token
    ended = regex.compile(r"(\n?\p{L}+)([^\s\p{L}\p{N}]+)")
    # the usual ones of them, told apart in the column: Latin letters and one ASCII mark
    marked = r"^\n?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+[!-/:-@\[-`{-~]$"

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        blank = self.library.encode(" ", add_special_tokens=False).tokens[0]
        names = sorted(self.library.get_vocab().items(), key=lambda x: x[1])
        self.opens = np.zeros(names[-1][1] + 1, bool)  # tokens that start with a blank
        self.opens[[i for t, i in names if t.startswith(blank)]] = True
        feed = self.library.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else -1
        # ids, as 32-bit numbers, of pieces that start with a line feed or come after a blank: those met lately, and those met before them
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}  # ids of single marks at the end of a piece

    @property
    def size(self) -> int:
        return self.library.get_vocab_size()

    def _each(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def _after_blank(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece with a blank before it.

        Those without white space and special tokens go through the library as one text, as only their first tokens start with a blank.
        """
        plain = [p for p in pieces if p.isalpha() or (p.split() == [p] and "<|" not in p)]
        found = self._at_once(plain, lambda some: " " + " ".join(some), lambda ids: self.opens[ids])
        return self._others(pieces, found, lambda rest: self._each([" " + p for p in rest]))

    def _after_feed(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece, which is a line feed and what stands between it and the next white space.

        They go through the library as one text too, in which only the feeds are the feed's token.
        """
        plain = [p for p in pieces if p[1:].split() == [p[1:]] and "<|" not in p]
        found = self._at_once(plain, "".join, lambda ids: ids == self.feed)
        return self._others(pieces, found, self._each)

    def _others(self, pieces: list[str], found: dict[str, bytes], each) -> dict[str, bytes]:
        """``found``, with those of the pieces it lacks."""
        if len(found) < len(pieces):
            rest = [p for p in pieces if p not in found]
            found.update(zip(rest, each(rest)))
        return found

    def _at_once(self, plain: list[str], joined, first) -> dict[str, bytes]:
        """Ids of the pieces, 2000 in one text; ``first`` tells a piece's first token from its others. Left out if they do not come apart."""
        found: dict[str, bytes] = {}
        for s in range(0, len(plain), 2000):
            some = plain[s : s + 2000]
            ids = np.array(self.library.encode_batch_fast([joined(some)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(first(ids))
            if len(at) == len(some):
                held, at = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
                found.update(zip(some, [held[i:j] for i, j in zip(at[:-1], at[1:])]))
        return found

    def _learn(self, new: list[str]) -> None:
        """Put new pieces into ``known``; of one that ends in other characters than letters, both parts."""
        split = {p: m.groups() for p in new if not p[-1:].isalnum() and (m := self.ended.fullmatch(p))}
        words = {w for w, _ in split.values() if w not in self.known}
        words.update(p for p in new if p not in split)
        ends = list({e for _, e in split.values()})
        todo = []
        for w in words:
            if w in self.older:
                self.known[w] = self.older[w]
            else:
                todo.append(w)
        feeds, blanks = [w for w in todo if w.startswith("\n")], [w for w in todo if not w.startswith("\n")]
        self.known.update(self._after_feed(feeds))
        self.known.update(self._after_blank(blanks))
        tails = dict(zip(ends, self._each(ends)))
        for p, (w, e) in split.items():
            self.known[p] = self.known[w] + tails[e]

    def _without_marks(self, pieces: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, list[bytes]]:
        """Distinct pieces without their single marks, number of each given one's, number of its mark or -1, and ids of the marks."""
        if len(pieces) < MANY_PIECES:
            return pieces.to_pylist(), np.arange(len(pieces)), np.full(len(pieces), -1), []
        with_mark = pc.match_substring_regex(pieces, self.marked)
        marked, plain = pieces.filter(with_mark), pieces.filter(pc.invert(with_mark))
        marked = marked.cast(pa.large_binary())
        bare = pc.binary_slice(marked, 0, -1).cast(pa.large_string())
        distinct = pa.concat_arrays([plain, bare]).dictionary_encode()
        marks = pc.binary_slice(marked, -1).cast(pa.large_string()).dictionary_encode()
        where = with_mark.to_numpy(zero_copy_only=False).astype(bool)
        own, mark = np.empty(len(pieces), np.int64), np.full(len(pieces), -1)
        numbers = distinct.indices.to_numpy(zero_copy_only=False)
        own[~where], own[where] = numbers[: len(plain)], numbers[len(plain) :]
        mark[where] = marks.indices.to_numpy(zero_copy_only=False)
        new = [m for m in marks.dictionary.to_pylist() if m not in self.marks]
        self.marks.update(zip(new, self._each(new)))
        return distinct.dictionary.to_numpy(zero_copy_only=False).tolist(), own, mark, [self.marks[m] for m in marks.dictionary.to_pylist()]

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, which are learned if they are new."""
        if len(self.known) > PIECES:
            self.older, self.known = self.known, {}
        found = list(map(self.known.get, pieces))
        new = [i for i, f in enumerate(found) if f is None]
        if new:
            again = {p: self.older[p] for i in new if (p := pieces[i]) in self.older}
            self.known.update(again)
            self._learn([p for i in new if (p := pieces[i]) not in again] if again else [pieces[i] for i in new])
            for i in new:
                found[i] = self.known[pieces[i]]
        return found

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text of a list or string column."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = texts.fill_null("")
        gaps = pc.match_substring_regex(texts, self.gap)
        # a line feed of these stands alone between other characters: it opens a piece, as blanks part them
        lists = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(gaps)), "\n", " \n"), " ")
        odd = [self.cut.split(t) for t in texts.filter(gaps).to_pylist()]
        flat = pa.concat_arrays([lists.flatten(), pa.array([p for c in odd for p in c], pa.large_string())])
        counts = np.r_[pc.list_value_length(lists).to_numpy(zero_copy_only=False), [len(c) for c in odd]].astype(np.int64)
        starts = np.cumsum(counts) - counts
        distinct = flat.dictionary_encode()
        codes = distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pieces, own, mark, marks = self._without_marks(distinct.dictionary)
        found = self._known(pieces)
        # the first piece of a text has no blank before it
        found += [*marks, *self._each(flat.take(pa.array(starts)).to_numpy(zero_copy_only=False).tolist())]
        mark = np.where(mark >= 0, mark + len(pieces), -1)[codes]
        codes = own[codes]
        codes[starts], mark[starts] = len(pieces) + len(marks) + np.arange(len(starts)), -1
        # a piece's mark comes behind it
        at = np.arange(len(codes)) + np.cumsum(mark >= 0) - (mark >= 0)
        both = np.empty(len(codes) + np.count_nonzero(mark >= 0), np.int64)
        both[at], both[at[mark >= 0] + 1] = codes, mark[mark >= 0]
        taken = pa.array(found, pa.large_binary()).take(pa.array(both))
        _, ends, held = taken.buffers()
        ids = np.frombuffer(held, "<u4") if held is not None else np.zeros(0, "<u4")
        bounds = np.frombuffer(ends, np.int64)[np.r_[at[starts], len(both)]] >> 2
        place = np.argsort(np.r_[np.flatnonzero(~(g := gaps.to_numpy(zero_copy_only=False).astype(bool))), np.flatnonzero(g)])
        return [ids[bounds[i] : bounds[i + 1]] for i in place.tolist()]


def _open(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    return fs, path


def _encode_partition(folder: str, tokenizer: str, end_id: int, vocabulary: int):
    def run(batches):
        encoder = worker_state(f"pieces {tokenizer}", lambda: Encoder(tokenizer))
        writer, name, first, null = None, None, None, False

        def done():
            writer.close()
            return pa.RecordBatch.from_pydict({"file": [name], "first_id": pa.array([first], pa.int64()), "docs": [len(writer.docs)], "tokens": [writer.tokens]})

        for batch in pieces(batches, 4 << 20):
            ids = batch.column("id").fill_null(-(1 << 63)).to_pylist()
            for i, tokens in zip(ids, encoder.encode(batch.column("text"))):
                if writer is None:
                    fs, base = _open(folder)
                    fs.create_dir(base, recursive=True)
                    name, first = f"{folder}/{uuid.uuid4().hex}.tok", i
                    writer = Writer(fs.open_output_stream(_open(name)[1], compression=None), bits_for(vocabulary))
                writer.add(i, np.r_[tokens, np.uint32(end_id)].astype(np.uint32))
                if writer.tokens >= FILE_TOKENS:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    return run


def write_tokens(
    ws: Workspace, docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the token files in ascending order of the ids; returns the manifest (file, first_id, docs, tokens)."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # ranges come from a sample of the keys on the driver, so only a few characters of a text are part of them
    ordered = picked.repartitionByRange("id", F.substring("text", 1, 16)).sortWithinPartitions("id", "text")
    folder = ws.path("tokens")
    write = _encode_partition(folder, tokenizer, end_id, vocabulary)
    return ws.save(ordered.mapInArrow(write, "file string, first_id long, docs long, tokens long"), "manifest")


def _read_files(batches):
    for batch in batches:
        for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
            fs, path = _open(file)
            with fs.open_input_file(path) as source:
                rows: list[list] = [[], [], [], []]
                for doc, start, ids in Reader(source).documents():
                    for column, value in zip(rows, (None if doc == -(1 << 63) else doc, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        column.append(value)
                    if len(rows[0]) == 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["id", "start", "n_tokens", "ids_crc32"])
                        rows = [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["id", "start", "n_tokens", "ids_crc32"])


def read_index(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read the files back: rows of the id, start (tokens of all documents before it), n_tokens and ids_crc32 (all long)."""
    order = Window.orderBy(F.col("first_id"), F.col("file")).rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = manifest.select("file", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))
    # a number of partitions that stays: the manifest is small, what it names is not
    files = based.repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(_read_files, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)
