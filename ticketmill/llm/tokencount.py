"""Token counts of whole texts, where most pre-tokens are known to be one token and are never merged.

A vocabulary string is *whole* if the merge list, applied to it alone, ends in that one token (``prove``). A vocabulary entry need not
be whole: its parts may be taken by earlier merges, or its bytes may be no text. The proof is made once, before any text is read, and
its result (at most as many strings as the vocabulary has) is sent to the tasks. A pre-token that is whole counts one; only the rest
goes through the merges.

Pre-tokens are those of a byte-level vocabulary. Characters that the installed Unicode tables put in another class than the
tokenizer does are found by the proof too; texts that hold one are split by the tokenizer itself. Special tokens inside a text
count one each, as the library does by default.

Null and empty texts have no bytes and no tokens. Null and repeated ids are kept, a row for each row; other columns are not
read. Long texts are split at single blanks between other characters, which never lie inside a pre-token, so a task
holds the pre-tokens of one slice; a pre-token without end is merged with a heap, in time n log n.
"""

from __future__ import annotations

import heapq
import json
import re
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.bpe import byte_alphabet
from ticketmill.llm.hashing import pieces

SLICE = 1 << 18  # characters split at a time
KEPT = 200_000  # counts of merged pre-tokens kept by a task,
KEPT_LENGTH = 64  # of this length at most
LONG = 48  # symbols from which on a heap finds the next merge

# the split of byte-level vocabularies, a fixed value
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


class Proof(NamedTuple):
    whole: frozenset[str]  # texts that are encoded as one token
    ranks: dict[tuple[str, str], int]  # the merge list
    specials: tuple[str, ...]  # cut out of the raw text, one token each
    unsettled: str  # characters the tokenizer may see otherwise, as ranges of a pattern


def merged_length(symbols: str, ranks: dict[tuple[str, str], int]) -> int:
    """How many tokens are left when no merge applies; of equal pairs the leftmost goes first."""
    parts = list(symbols)
    if len(parts) < LONG:
        rank, none = ranks.get, len(ranks)
        near = [rank(pair, none) for pair in zip(parts, parts[1:])]  # of each part and the next
        while near and (best := min(near)) < none:
            at = near.index(best)
            parts[at] += parts.pop(at + 1)
            del near[at]
            if at:
                near[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(near):
                near[at] = rank((parts[at], parts[at + 1]), none)
        return len(parts)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue = [(ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
    heapq.heapify(queue)
    left = len(parts)
    while queue:
        _, i, pair = heapq.heappop(queue)
        j = after[i]
        if j >= len(parts) or (parts[i], parts[j]) != pair:
            continue
        parts[i], parts[j] = pair[0] + pair[1], None
        left -= 1
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(parts) and (rank := ranks.get((parts[a], parts[b]))) is not None:
                heapq.heappush(queue, (rank, a, (parts[a], parts[b])))
    return left


def _unsettled(path: str) -> str:
    """Code points whose class differs between the tokenizer and the pattern.

    A stretch of one class behind a character of that class must be one piece; where it is not, each is tried by itself.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    own = regex.compile(SPLIT)
    every = "".join([chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000])
    odd: set[int] = set()
    for stretch in regex.finditer(r"(\p{L}+)|(\p{N}+)|\p{White_Space}+|([^\p{L}\p{N}\p{White_Space}]+)", every):
        if stretch.lastindex and len(split("a1-"[stretch.lastindex - 1] + stretch[0])) == 1:
            continue
        text = "".join([f"a{c}1-{c}\n" for c in stretch[0]])  # 6 characters for each
        theirs, ours = {a for _, (a, _) in split(text)}, {m.start() for m in own.finditer(text)}
        odd.update([ord(stretch[0][at // 6]) for at in theirs ^ ours])
    ranges: list[list[int]] = []
    for c in sorted(odd):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join([f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges])


def prove(path: str) -> Proof:
    """What a vocabulary file settles before any text is read."""
    held = json.loads(Path(path).read_text(encoding="utf-8"))
    model, before = held["model"], held["pre_tokenizer"]
    plain = before["type"] == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"] and not held["normalizer"]
    strips = any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in held["added_tokens"])
    if not plain or strips or model.get("ignore_merges"):
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
    ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): r for r, m in enumerate(model["merges"])}
    byte = {c: b for b, c in enumerate(byte_alphabet())}
    whole = set()
    for token in model["vocab"]:
        try:
            text = bytes([byte[c] for c in token]).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if merged_length(token, ranks) == 1:
            whole.add(text)
    return Proof(frozenset(whole), ranks, tuple(t["content"] for t in held["added_tokens"]), _unsettled(path))


class Counter:
    """Counts the tokens of texts; lives as long as a task."""

    def __init__(self, proof: Proof, path: str):
        self.whole, self.ranks, self.path = proof.whole, proof.ranks, path
        self.split = regex.compile(SPLIT)
        self.blank = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
        self.specials = proof.specials
        self.special = regex.compile("|".join([regex.escape(s) for s in proof.specials])) if proof.specials else None
        self.unsettled = re.compile(f"[{proof.unsettled}]") if proof.unsettled else None
        self.alphabet = byte_alphabet()
        self.kept: dict[str, int] = {}
        self.library = None

    def merged(self, pre_token: str) -> int:
        n = self.kept.get(pre_token)
        if n is None:
            n = merged_length("".join([self.alphabet[b] for b in pre_token.encode()]), self.ranks)
            if len(pre_token) <= KEPT_LENGTH:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[pre_token] = n
        return n

    def _slices(self, text: str):
        at = 0
        while len(text) - at > SLICE:
            cut = self.blank.search(text, at + SLICE)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _by_tokenizer(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def plain(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        n, whole = 0, self.whole
        for piece in self._slices(text):
            if self.unsettled is not None and not piece.isascii() and self.unsettled.search(piece):
                found = self._by_tokenizer(piece)
            else:
                found = self.split.findall(piece)
            rest = [p for p in found if p not in whole]
            n += len(found) - len(rest) + sum([self.merged(p) for p in rest])
        return n

    def count(self, text: str) -> int:
        if self.special is None or not any([s in text for s in self.specials]):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum([self.plain(p) for p in parts if p])


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of the id, n_bytes (long, of the UTF-8 text), n_tokens (long) and over_limit (more than ``limit`` tokens)."""
    proof = docs.sparkSession.sparkContext.broadcast(prove(path))

    def run(batches):
        counter = Counter(proof.value, path)
        for batch in pieces(batches, 1 << 20):
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            n = pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())
            size = pc.binary_length(texts.cast(pa.large_binary())).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, n, pc.greater(n, limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {dict(picked.dtypes)['id']}, n_bytes long, n_tokens long, over_limit boolean"
    return picked.mapInArrow(run, schema)
