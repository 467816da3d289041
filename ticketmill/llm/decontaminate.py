"""Benchmark decontamination by templates.

A text becomes a sequence of template tokens: numbers, units after a number and names (capitalised words inside a sentence) are
typed placeholders, other words stay as they are in lower case. A capitalised word that opens a sentence may be a name or not: windows
over one that is no usual opener come in both readings, and a passage is judged in either. Windows of ``WINDOW`` template tokens of documents and
benchmark items are joined by hash. Windows that line up (same distance of the positions) belong to one passage; what fills
the placeholders must be consistent there: the same value in the item always meets the same value in the document.
So a question with other numbers and names is found, and texts that merely share a pattern are not.

A passage is a leak if it has at least ``COVERAGE`` of the item's windows. Windows with fewer than ``LITERALS`` plain
words say too little and are not used. An item without a usable window is looked for word by word: all its windows of
``WINDOW`` words (or its only one, if it is shorter) must be there side by side. Items of fewer than ``SHORTEST`` words say too little.

Documents send only windows that pass a bitmap of fixed size made from the items' windows, so that the join moves next
to nothing; the join itself is an ordinary equi-join and Spark picks its kind by size.

Null texts and ids take no part. Equal items
match side by side; repeated rows of one id count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.hashing import LOWER, flat_bytes, hash_spans, pieces, runs, word_bounds

WINDOW = 8
LITERALS = 4
SHORTEST = 4
COVERAGE = 0.5
BITMAP_BITS = 22

# Unit words that are placeholders after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre"
    " kilometres mg g kg t oz lb lbs gram grams kilogram kilograms ounce ounces pound pounds ton tons ml cl l liter liters litre litres"
    " gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years"
    " percent dollar dollars euro euros cent cents mph kmh kph hz khz mhz ghz w kw mw v a j kj cal kcal degree degrees c f k b kb mb gb tb"
).split()

# Words that open sentences without being names.
OPENERS = [
    "a", "after", "all", "an", "and", "another", "any", "are", "as", "at", "because", "before", "but", "by", "can", "could", "did", "do", "does", "during",
    "each", "every", "find", "for", "from", "given", "had", "has", "have", "he", "her", "his", "how", "i", "if", "in", "is", "it", "its", "let", "my", "no",
    "not", "now", "of", "on", "one", "or", "our", "she", "should", "since", "so", "some", "suppose", "that", "the", "their", "then", "there", "these", "they",
    "this", "those", "to", "was", "we", "were", "what", "when", "where", "which", "while", "who", "why", "will", "with", "would", "you", "your",
]

DIGITS = np.zeros(256, bool)
DIGITS[48:58] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
ENDS = np.zeros(256, bool)
ENDS[[*b".!?:\n\r"]] = True
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0xA1, 0xB2, 0xC3))

# readings of a window: it has no doubtful opener; its openers are words; they are names; from WORDS on, plain words and their number
EITHER, OPENER_WORDS, OPENER_NAMES, WORDS = 0, 1, 2, 10
WINDOW_SCHEMA = "id long, window long, pos int, slots array<long>, reading int"


def template(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens of a column: hashes, hashes of the words themselves, kind (0 for a plain word), row offsets, doubtful openers."""
    data, rows = flat_bytes(texts)
    outside = PUNCTUATION[data]
    # . and , between digits belong to the number
    if len(data) > 2:
        digit = DIGITS[data]
        inner = np.flatnonzero(digit[:-2] & digit[2:] & ((data[1:-1] == 46) | (data[1:-1] == 44))) + 1
    else:
        inner = np.zeros(0, np.int64)
    marks = np.where(outside, np.uint8(1), np.uint8(0))
    marks[inner] = 0
    starts, ends = word_bounds(marks, rows, np.arange(256) == 1)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(np.int8), np.zeros(len(rows), np.int64), none.astype(bool)
    words = hash_spans(LOWER[data], starts, ends)[0]
    offsets = np.searchsorted(starts, rows)
    first = np.zeros(len(starts), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    stops = np.r_[0, np.cumsum(ENDS[data])]
    opens = first | (stops[starts] > stops[np.r_[0, ends[:-1]]])
    number = DIGITS[data[starts]]
    after_number = np.r_[False, number[:-1]] & ~first
    unit = after_number & ~number & _among(UNITS, words)
    second = data[np.minimum(starts + 1, len(data) - 1)]
    capital = UPPER[data[starts]] | ((data[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    name = capital & ~opens & ~number & ~unit
    kind = (number * 1 + unit * 2 + name * 3).astype(np.int8)
    held = np.select([number, unit, name], [NUMBER, UNIT, NAME], words)
    doubtful = capital & opens & ~number & ~unit & ~_among(OPENERS, words)
    return held, words, kind, offsets, doubtful


def _among(listed: list[str], words: np.ndarray) -> np.ndarray:
    known = np.sort(hash_spans(*_joined(listed))[0])
    return known[np.minimum(np.searchsorted(known, words), len(known) - 1)] == words


def _joined(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return data, np.r_[0, ends[:-1]], ends


def _windows(wanted):
    """(id, text) to windows; ``wanted`` is None for items, for documents a broadcast bitmap of windows and the sizes of word windows."""

    def run(batches):
        bits, sizes = (None, []) if wanted is None else wanted.value
        for batch in pieces(batches):
            held, words, kind, offsets, doubtful = template(batch.column("text"))
            counts = np.diff(offsets)
            row = np.repeat(np.arange(batch.num_rows), counts)
            found = []

            def take(hashes, size, good, kinds, reading):
                if bits is not None and len(hashes):
                    good = good & (np.unpackbits(bits, bitorder="little")[(hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)] == 1)
                at = np.flatnonzero(good)
                filled = np.flatnonzero(kinds)
                lo, hi = np.searchsorted(filled, at), np.searchsorted(filled, at + size)
                slots = [filled[x:y] for x, y in zip(lo.tolist(), hi.tolist())]
                flat = np.concatenate(slots) if slots else np.zeros(0, np.int64)
                found.append((at, hashes[at], hi - lo, words[flat], np.broadcast_to(reading, len(hashes))[at]))

            def windows(tokens, kinds):
                hashes = runs(tokens, WINDOW)
                at = np.arange(len(hashes))
                plain = np.r_[0, np.cumsum(kinds == 0)]
                return hashes, (row[at] == row[at + WINDOW - 1]) & (plain[at + WINDOW] - plain[at] >= LITERALS)

            def word_windows(size, chosen=None):
                hashes = runs(words + np.uint64(size), size)
                at = np.arange(len(hashes))
                good = row[at] == row[at + size - 1]
                take(hashes, size, good if chosen is None else good & chosen[row[at]], np.zeros(len(words), np.int8), WORDS + size)

            hashes, good = windows(held, kind)
            at = np.arange(len(hashes))
            openers = np.r_[0, np.cumsum(doubtful)]
            over = openers[at + WINDOW] > openers[at] if len(at) else np.zeros(0, bool)
            take(hashes, WINDOW, good, kind, np.where(over, OPENER_WORDS, EITHER))
            named = np.where(doubtful, np.int8(3), kind)
            hashes, as_names = windows(np.where(doubtful, NAME, held), named)
            take(hashes, WINDOW, as_names & over, named, OPENER_NAMES)
            if wanted is None:  # items without a usable window
                usable = np.zeros(batch.num_rows, bool)
                usable[row[at[good | (as_names & over)]]] = True
                for size in range(SHORTEST, WINDOW + 1):
                    word_windows(size, ~usable & (counts >= SHORTEST) & (np.minimum(counts, WINDOW) == size))
            for size in sizes:
                word_windows(size)
            at, hashes, lengths, slots, reading = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(row[at])),
                    pa.array(hashes.view(np.int64)),
                    pa.array((at - offsets[row[at]]).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(slots.view(np.int64))),
                    pa.array(reading.astype(np.int32)),
                ],
                names=["id", "window", "pos", "slots", "reading"],
            )

    return run


def _bitmap(windows: DataFrame) -> np.ndarray:
    """The windows' leading bits as a packed bitmap; at most 2^BITMAP_BITS / 32 rows come to the driver."""
    place = F.shiftrightunsigned("window", 64 - BITMAP_BITS)
    rows = (
        windows.select((place / 32).cast("int").alias("word"), (place % 32).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    )
    out = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for word, bits in rows:
        out[word] = bits
    return out.view(np.uint8)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and benchmark item it holds.

    Columns: the two ids (long), windows (of the item that the best aligned passage has), coverage (share of the item's
    windows), slots and changed_slots (placeholder values of the passage, and those filled differently), kind
    (``verbatim`` or ``reparameterised``).
    """
    pick = lambda df, i, t: df.select(F.col(i).cast("long").alias("id"), F.col(t).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    asked = pick(items, item_id_col, item_text_col).mapInArrow(_windows(None), WINDOW_SCHEMA)
    asked = asked.groupBy("id", "window", "pos", "reading").agg(F.first("slots").alias("item_slots"))  # repeated items have equal slots there
    sizes = asked.groupBy("id").agg(F.count_distinct("pos").alias("of"))
    sizes_of_words = [r[0] - WORDS for r in asked.where(F.col("reading") >= WORDS).select("reading").distinct().collect()]  # at most WINDOW rows
    wanted = docs.sparkSession.sparkContext.broadcast((_bitmap(asked), sizes_of_words))
    found = pick(docs, id_col, text_col).mapInArrow(_windows(wanted), WINDOW_SCHEMA)
    asked = asked.select(F.col("id").alias("item"), "window", F.col("pos").alias("item_pos"), "item_slots", F.col("reading").alias("item_reading"))
    # a window without doubtful openers belongs to both readings of its passage
    own = F.greatest("reading", "item_reading")
    readings = F.when(own == EITHER, F.array(F.lit(OPENER_WORDS), F.lit(OPENER_NAMES))).otherwise(F.array(own))
    hits = found.join(asked, "window").select(
        F.col("id").alias("doc"), "item", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "slots", "item_slots", F.explode(readings).alias("reading"),
    )
    hits = hits.select("doc", "item", "item_pos", "shift", "reading", F.explode_outer(F.arrays_zip("item_slots", "slots")).alias("slot"))
    passage = ["doc", "item", "shift", "reading"]
    hits = hits.groupBy(*passage, "item_pos", "slot").agg(F.lit(1).alias("one"))  # each once, also for repeated rows
    lined = hits.groupBy(*passage).agg(
        F.count_distinct("item_pos").alias("windows"),
        F.count_distinct("slot").alias("pairs"),
        F.count_distinct("slot.item_slots").alias("slots"),
        F.count_distinct(F.when(F.col("slot.item_slots") != F.col("slot.slots"), F.col("slot.item_slots"))).alias("changed_slots"),
    )
    best = (
        lined.where(F.col("pairs") == F.col("slots"))
        .groupBy("doc", "item")
        .agg(F.max(F.struct("windows", -F.col("changed_slots"), -F.col("shift"), "slots", "changed_slots", "reading")).alias("b"))
        .join(sizes.select(F.col("id").alias("item"), "of"), "item")
    )
    share = F.round(F.col("b.windows") / F.col("of"), 4)
    least = F.when(F.col("b.reading") >= WORDS, F.lit(1.0)).otherwise(F.lit(coverage))
    return best.where(F.col("b.windows") >= least * F.col("of")).select(
        F.col("doc").alias(id_col),
        F.col("item").alias(item_id_col),
        F.col("b.windows").alias("windows"),
        share.alias("coverage"),
        F.col("b.slots").alias("slots"),
        F.col("b.changed_slots").alias("changed_slots"),
        F.when(F.col("b.changed_slots") == 0, "verbatim").otherwise("reparameterised").alias("kind"),
    )
