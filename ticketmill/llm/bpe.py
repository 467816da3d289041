"""BPE encoding as a bounded-lookahead streaming transducer, and decoding as an incremental byte-to-text machine.

Merges cross the boundary of two neighbouring tokens or they do not, whatever stands further away; so a token sequence is the BPE
of its string exactly if every neighbouring pair is (``Merges.stands``), and for every prefix of a string there is one last token.
The transducer reads symbols and keeps, for each end position in a window, that last token. Later tokens can only start at one of
the last ``lookahead`` ends (the longest token of the merge list, in symbols); what all chains from these ends share is stable
and is emitted, and the window moves on. Memory is constant however long a word is.

Texts are handled as the ``tokenizers`` library does for a vocabulary with word ends: special tokens are cut out of the raw text, the
rest is put in NFC and lower case, split by white space and then into letters, digits and other runs, and each such word
ends in a symbol of its own. Words between white space do not influence each other, so a task keeps the results of
the words it has seen, up to a bound.

Null and empty texts have no tokens. Null ids are kept as they are; rows repeat as they come in.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import json
import sys
import types
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.hashing import give_back, pieces

# words kept, of at most so many characters, and pairs of tokens kept
CACHE = 600_000
CACHED_LENGTH = 48
STOOD = 600_000
# words a task keeps that frees its coder at the end, as other work follows in the same workers
TASK_CACHE = 200_000
ENDLESS = 1 << 60
# runs between white space whose ids go to the hashes and to the decoder at once
RUNS = 8192


def worker_state(name: str, make):
    """Something a Python worker builds once and keeps between tasks."""
    held = sys.modules.setdefault("_ticketmill_worker_state", types.ModuleType("_ticketmill_worker_state"))
    if name not in held.__dict__:
        held.__dict__[name] = make()
    return held.__dict__[name]


def byte_alphabet() -> list[str]:
    """The printable character for each byte in byte-level vocabularies: itself if printable Latin-1, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


class Merges:
    """Vocabulary and merge list, with the spines of every token."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str = ""):
        self.ids, self.word_end = vocab, word_end
        self.rank = {pair: r for r, pair in enumerate(merges)}
        self.parts = {}
        for a, b in merges:
            self.parts.setdefault(a + b, (a, b))
        symbols = lambda t: len(t.removesuffix(word_end)) if word_end and t != word_end else len(t)
        merged = [a + b for a, b in merges]
        self.lookahead = max([1, *map(symbols, merged)])
        # a token counts only if its own string is encoded as itself
        self.tokens = {t for t in vocab if symbols(t) == 1 or t in self.parts}
        self.spines: dict[str, tuple[list, list]] = {}
        self.stood: dict[tuple[str, str], bool] = {}
        self.tokens -= {t for t in self.tokens if t in self.parts and not self._itself(t)}
        # tokens by their symbols from the last to the first; "" holds the token itself
        self.endings: dict = {word_end: {}} if word_end else {}
        for t in self.tokens:
            ends = bool(word_end) and t.endswith(word_end) and t != word_end
            node = self.endings[word_end] if ends else self.endings
            for c in reversed(t.removesuffix(word_end) if ends else t):
                node = node.setdefault(c, {})
            node[""] = t

    def _made(self, token: str) -> int:
        return self.rank[self.parts[token]] if token in self.parts else -1

    def _itself(self, token: str) -> bool:
        """Its two parts are made before it and would stand until then."""
        a, b = self.parts[token]
        own = self.rank[a, b]
        return self._made(a) < own and self._made(b) < own and self._stands(a, b, own)

    def _spine(self, token: str) -> tuple[list, list]:
        """What stands at the right and at the left edge of the token over time: [(symbol, rank at which it goes)]."""
        if token not in self.spines:
            right, left = [], []
            for out, side in ((right, 1), (left, 0)):
                t, until = token, ENDLESS
                while True:
                    out.append((t, until))
                    if t not in self.parts:
                        break
                    until = self.rank[self.parts[t]]
                    t = self.parts[t][side]
                out.reverse()
            self.spines[token] = (right, left)
        return self.spines[token]

    def _stands(self, a: str, b: str, before: int) -> bool:
        """No merge of rank under ``before`` crosses the boundary of a and b."""
        right, left = self._spine(a)[0], self._spine(b)[1]
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = right[i], left[j]
            cross = self.rank.get((x, y), ENDLESS)
            # of equal ranks the leftmost merge goes first
            if cross < before and cross < x_until and cross <= y_until:
                return False
            if x_until == ENDLESS and y_until == ENDLESS:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def stands(self, a: str, b: str) -> bool:
        """The two tokens stay as they are beside each other."""
        key = (a, b)
        if key not in self.stood:
            if len(self.stood) > STOOD:
                self.stood.clear()
            self.stood[key] = self._stands(a, b, ENDLESS)
        return self.stood[key]


class Transducer:
    """Feed symbols of one word, then close it; tokens come out as soon as they are stable."""

    def __init__(self, merges: Merges):
        self.m = merges
        self._start()

    def _start(self) -> None:
        self.text = ""  # symbols from the first end position that is kept
        self.back: list[tuple[int, str] | None] = [None]  # for each end: (start, last token)
        self.before: str | None = None  # the token before the window

    def _last(self, ending: bool = False) -> tuple[int, str] | None:
        """The last token of what has been read, and where it starts."""
        end, m = len(self.text), self.m
        suffix = m.word_end if ending else ""
        for start in range(max(0, end - m.lookahead), end):
            token = self.text[start:end] + suffix
            if token in m.tokens:
                prior = self.back[start]
                if prior is None and start:
                    continue
                held = prior[1] if prior else self.before
                if held is None or m.stands(held, token):
                    return start, token
        return None

    def feed(self, symbols: str) -> list[str]:
        out: list[str] = []
        for s in symbols:
            self.text += s
            self.back.append(self._last())
            if len(self.text) > 4 * self.m.lookahead:
                out += self._stable()
        return out

    def short(self, symbols: str) -> list[str]:
        """A whole word that fits the window: the same steps as feeding and closing, in one loop."""
        m, text = self.m, symbols
        stood, n = m.stood, len(symbols)
        last: list[str | None] = [""] * (n + 1)
        starts = [0] * (n + 1)
        for end in range(1, n + 1):
            suffix = m.word_end if end == n else ""
            last[end] = None
            # tokens that end here are met from the shortest on, as long as anything ends like this; one of them is right
            node = m.endings
            if suffix:
                node = node[suffix]
            for start in range(end - 1, max(-1, end - m.lookahead - 1), -1):
                node = node.get(text[start])
                if node is None:
                    break
                held = last[start]
                if held is None or "" not in node:
                    continue
                token = node[""]
                if start:
                    good = stood.get((held, token))
                    if not (m.stands(held, token) if good is None else good):
                        continue
                last[end], starts[end] = token, start
                break
        if last[n] is None:
            raise ValueError("a symbol is not in the vocabulary")
        out, end = [], n
        while end:
            out.append(last[end])
            end = starts[end]
        return out[::-1]

    def close(self) -> list[str]:
        """The rest of the tokens; the last symbol becomes one that ends a word."""
        if not self.text:
            return []
        self.back[-1] = self._last(ending=True)
        if self.back[-1] is None:
            raise ValueError("a symbol is not in the vocabulary")
        out = self._chain(len(self.text))
        self._start()
        return out

    def _chain(self, end: int) -> list[str]:
        out = []
        while end:
            start, token = self.back[end]
            out.append(token)
            end = start
        return out[::-1]

    def _stable(self) -> list[str]:
        """Emit what every chain from the last ends has in common. The very last end may still become a word's end."""
        n = len(self.text)
        ends = {e for e in range(n - self.m.lookahead, n + 1) if self.back[e]}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(self.back[last][0])
        cut = ends.pop() if ends else 0
        if not cut:
            return []
        out = self._chain(cut)
        self.before = out[-1]
        self.text = self.text[cut:]
        # an end whose token starts before the cut is on no chain that can go on
        self.back = [None, *((b[0] - cut, b[1]) if b and b[0] >= cut else None for b in self.back[cut + 1 :])]
        return out


class Coder:
    """A text coder for a vocabulary file with word ends."""

    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, cache: int = CACHE):
        self.cached = cache
        held = json.loads(Path(path).read_text(encoding="utf-8"))
        model = held["model"]
        self.merges = Merges(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]], model["end_of_word_suffix"] or "")
        self.specials = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.specials.items()}
        self.split = regex.compile(self.SPLIT)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.alphabet = byte_alphabet()
        self.bytes = {c: b for b, c in enumerate(self.alphabet)}
        self.transducer = Transducer(self.merges)
        self.by_decimal = {b"%d" % i: t.encode() for i, t in self.names.items()}
        self.cache: dict[str, tuple[int, bytes]] = {}

    def word(self, word: str) -> list[str]:
        """Tokens of one word."""
        symbols = word if word.isascii() and word.isprintable() else "".join([self.alphabet[b] for b in word.encode()])
        if len(symbols) <= self.merges.lookahead:
            return self.transducer.short(symbols)
        return self.transducer.feed(symbols) + self.transducer.close()

    def runs(self, text: str) -> list[str]:
        """What stands between white space, normalised; special tokens stand alone."""
        parts = self.special.split(text) if self.special and "<" in text else [text]
        out: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append("\0" + part)
            elif part:
                if not part.isascii():
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final sigma
                low = part.lower()
                out += low.split() if not self.odd.search(low) else [x for x in regex.split(r"\s+", low) if x]
        return out

    # split() also parts at these, the library does not
    odd = regex.compile("[\x1c-\x1f]")

    def of_word(self, word: str) -> tuple[int, bytes]:
        """Number of tokens and decimal ids of one word; kept."""
        tokens = self.word(word)
        got = len(tokens), b" ".join([b"%d" % self.merges.ids[t] for t in tokens])
        if len(word) <= CACHED_LENGTH:
            if len(self.cache) >= self.cached:
                self.cache.clear()
            self.cache[word] = got
        return got

    def free(self) -> None:
        """Give up all that was built and kept; a worker outlives its tasks."""
        self.__dict__.clear()
        gc.collect()
        give_back()

    def of_run(self, run: str) -> tuple[int, bytes]:
        """The same for what stands between white space."""
        if run[0] == "\0" and run[1:] in self.specials:
            return 1, b"%d" % self.specials[run[1:]]
        got = [self.cache.get(w) or self.of_word(w) for w in self.split.findall(run)]
        return got[0] if len(got) == 1 else self.joined(got)

    @staticmethod
    def joined(parts: list[tuple[int, bytes]]) -> tuple[int, bytes]:
        return sum([p[0] for p in parts]), b" ".join([p[1] for p in parts])

    def blocks(self, text: str):
        """The ids of a text in order, some runs at a time: (number of tokens, decimal ids joined by one space)."""
        known, new = self.cache.get, self.of_run
        runs = self.runs(text)
        for at in range(0, len(runs), RUNS):
            yield self.joined([known(r) or new(r) for r in runs[at : at + RUNS]])

    def coded(self, text: str) -> tuple[int, bytes]:
        """Number of tokens and decimal ids joined by one space."""
        return self.joined(list(self.blocks(text)))

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.coded(text)[1].split()]


class Decoder:
    """Ids to text, one by one.

    ``library`` gives what the library's decode does for a file without a decoder: token names joined by one space. Otherwise names
    go back to bytes, word ends to spaces, and bytes to characters as soon as these are complete; broken ones become U+FFFD.
    """

    def __init__(self, coder: Coder, library: bool = False):
        self.coder, self.library = coder, library
        self.first = True
        self.utf8 = None if library else codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id: int) -> str:
        name = self.coder.names.get(token_id)
        if name is None:
            return ""
        if self.library:
            out = name if self.first else " " + name
            self.first = False
            return out
        if name in self.coder.specials:
            return self.utf8.decode(b"", True) + name
        end = self.coder.merges.word_end
        whole = bool(end) and name.endswith(end)
        held = bytes(self.coder.bytes[c] for c in (name.removesuffix(end) if whole else name))
        return self.utf8.decode(held + b" " * whole)

    def feed_decimals(self, ids: bytes) -> bytes:
        """A block of ids, decimal and joined by one space, at once; text in UTF-8."""
        if not ids:
            return b""
        if not self.library:
            return "".join([self.feed(int(i)) for i in ids.split(b" ")]).encode()
        names = self.coder.by_decimal
        known = [names[i] for i in ids.split(b" ") if i in names]
        out = b" ".join(known) if self.first or not known else b" " + b" ".join(known)
        self.first = self.first and not known
        return out

    def close(self) -> str:
        return "" if self.library else self.utf8.decode(b"", True)


def decode(coder: Coder, ids: list[int], library: bool = False) -> str:
    machine = Decoder(coder, library)
    return "".join([machine.feed(i) for i in ids]) + machine.close()


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of the id, n_tokens (long) and ids (array of int)."""

    def run(batches):
        coder = Coder(path, TASK_CACHE)  # built in half a second, and gone with the task
        try:
            for batch in pieces(batches):
                coded = [coder.coded(t.as_py() or "") for t in batch.column("text")]
                n = [c[0] for c in coded]
                flat = np.fromstring(b" ".join([c[1] for c in coded if c[0]]).decode(), np.int32, sep=" ")
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), ids], names=[id_col, "n_tokens", "ids"])
        finally:
            coder.free()

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"`{id_col}` {dict(picked.dtypes)['id']}, n_tokens long, ids array<int>")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode: rows of the id, n_tokens (long), ids_sha256 and decoded_sha256.

    The first hash is of the decimal ids joined by one space, the second of the decoded text as the library gives it.
    The coder and the words it met, up to the bounds above, stay with the worker for its next tasks.
    The ids of a text go to the first hash and to the decoder block by block, and what the decoder gives to the second, so
    neither all ids nor the decoded text of a long document are held.
    """

    def run(batches):
        coder = worker_state(f"bpe {path}", lambda: Coder(path))
        for batch in pieces(batches):
            n, a, b = [], [], []
            for t in batch.column("text"):
                machine, of_ids, of_text, count = Decoder(coder, library=True), hashlib.sha256(), hashlib.sha256(), 0
                for some, ids in coder.blocks(t.as_py() or ""):
                    of_ids.update(b" " + ids if count and some else ids)
                    of_text.update(machine.feed_decimals(ids))
                    count += some
                of_text.update(machine.close().encode())
                n.append(count)
                a.append(of_ids.hexdigest())
                b.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {dict(picked.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return picked.mapInArrow(run, schema)
