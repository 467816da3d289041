"""Decontamination: names that open sentences, short items, and random texts against a plain statement of the rules."""

import random
import re
from collections import defaultdict

from ticketmill.llm import decontaminate as dc

QUESTION = "Tom buys 5 apples at the market. Anna gives him 3 more apples. Tom then sells half of the apples to Anna."


def told(spark, texts, items):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.windows, r.kind) for r in dc.leaks(docs, asked).collect()}


def plain_tokens(text):
    """(word, kind, doubtful) of each word of an ASCII text."""
    out, end = [], 0
    for m in re.finditer(r"(?:[A-Za-z0-9]|(?<=[0-9])[.,](?=[0-9]))+", text):
        opens = not out or bool(re.search(r"[.!?:\n\r]", text[end : m.start()]))
        word = m[0]
        number = word[0].isdigit()
        unit = bool(out) and out[-1][1] == 1 and not number and word.lower() in dc.UNITS
        capital = word[0].isupper() and not number and not unit
        out.append((word.lower(), 1 if number else 2 if unit else 3 if capital and not opens else 0, capital and opens and word.lower() not in dc.OPENERS))
        end = m.end()
    return out


def plain_windows(tokens, names):
    """Position to (window, slots) in one reading."""
    out = {}
    for i in range(len(tokens) - dc.WINDOW + 1):
        kinds = [(w, 3 if d and names else k) for w, k, d in tokens[i : i + dc.WINDOW]]
        if sum(k == 0 for _, k in kinds) >= dc.LITERALS:
            out[i] = (tuple(k or w for w, k in kinds), tuple((i + j, w) for j, (w, k) in enumerate(kinds) if k))
    return out


def plain_leaks(texts, items):
    found = set()
    for item, asked in items:
        a = plain_tokens(asked)
        both = [plain_windows(a, names) for names in (False, True)]
        of = len(both[0].keys() | both[1].keys())
        for doc, text in texts:
            d = plain_tokens(text)
            if not of:
                words, held = [w for w, _, _ in a], [w for w, _, _ in d]
                if len(words) >= dc.SHORTEST and any(held[i : i + len(words)] == words for i in range(len(held) - len(words) + 1)):
                    found.add((doc, item))
                continue
            for names in (False, True):
                at = defaultdict(list)
                for j, (window, slots) in plain_windows(d, names).items():
                    at[window].append((j, slots))
                lined = defaultdict(lambda: (set(), set()))
                for i, (window, slots) in both[names].items():
                    for j, other in at[window]:
                        lined[j - i][0].add(i)
                        lined[j - i][1].update((x[1], y[1]) for x, y in zip(slots, other))
                for count, pairs in lined.values():
                    if len(count) >= dc.COVERAGE * of and len(pairs) == len({x for x, _ in pairs}):
                        found.add((doc, item))
    return found


def test_names_at_sentence_starts(spark):
    luke = QUESTION.replace("Tom", "Luke").replace("Anna", "Mary").replace("5", "9")
    mixed = luke.replace("Luke then", "Mary then")  # who sells is somebody else
    texts = [(1, "So here it is. " + luke), (2, mixed), (3, QUESTION), (4, "The market is closed. Nobody sells apples there any more, and that is sad.")]
    assert {k: v[1] for k, v in told(spark, texts, [(1, QUESTION)]).items()} == {(1, 1): "reparameterised", (3, 1): "verbatim"}


def test_short_items_are_found_word_by_word(spark):
    items = [(1, "What is the capital city of France?"), (2, "Name three noble gases"), (3, "too short now"), (4, "5 6 7 8 9 10 11 12 13 14")]
    texts = [
        (1, "Quiz. what is the capital city of FRANCE? Paris."), (2, "What is the capital city of Spain?"), (3, "Please name three noble gases, now. too short now"),
        (4, "count 5 6 7 8 9 10 11 12 13 14 15"), (5, "count 5 6 7 8 9 10 11 12 13 15"), (6, None), (7, ""),
    ]
    assert set(told(spark, texts, items)) == {(1, 1), (3, 2), (4, 4)} == plain_leaks([(i, t or "") for i, t in texts], items)


def test_random_texts_equal_the_plain_statement(spark):
    r = random.Random(11)
    people, plain = ["Tom", "Anna", "Luke", "Mary"], "gives takes and then sells some red apples to from with near old market bread".split()

    def sentence():
        words = [r.choice(people + ["The", "Every", "Market"])] + [r.choice(plain + plain + people + ["3", "40", "km"]) for _ in range(r.randrange(3, 12))]
        return " ".join(words) + r.choice(". . ? !".split())

    items = [(i, " ".join(sentence() for _ in range(r.randrange(1, 4)))) for i in range(25)]
    texts = []
    for n in range(120):
        text = r.choice(items)[1]
        for _ in range(r.randrange(0, 4)):
            a, b = r.choice(people + ["3", "market"]), r.choice(people + ["40", "Bread"])
            text = text.replace(a, b, r.choice([-1, -1, 1]))
        texts.append((n, sentence() + " " + text + " " + sentence()))
    want = plain_leaks(texts, items)
    assert set(told(spark, texts, items)) == want and len(want) > 60
