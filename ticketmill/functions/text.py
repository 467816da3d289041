"""Text functions as column expressions.

Python's ``\\w`` and ``\\s`` are spelled out, since Java's are narrower (or, with ``(?U)``, wider).
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character classes and patterns the results depend on.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
MAIL_PART = r"[\p{L}\p{N}_.\-]"
# The look-behind starts a match only at the head of a run: a long run without "@" is scanned once.
EMAIL = rf"(?<!{MAIL_PART}){MAIL_PART}++@{MAIL_PART}+"
URL = rf"https?://{NOT_SPACE}+"
WWW_URL = rf"https?://{NOT_SPACE}+|www\.{NOT_SPACE}+"
TICKET_KEY = rf"(?<!{WORD})[A-Z]{{2,}}-\p{{Nd}}+(?!{WORD})"
LOWER_TICKET_KEY = rf"(?<!{WORD})[a-z]{{2,}}-\p{{Nd}}+(?!{WORD})"
HEX_ID = rf"(?<!{WORD})0x[0-9a-f]+(?!{WORD})"
TOKEN = rf"{WORD}{{2,}}"
CRUX_TOKEN = r"[a-z0-9\-]+"

# Words that say nothing in a crux, and its sentinel texts.
CRUX_STOP_WORDS = (
    "you can please should could would may might we our let's "
    "ensure make fix address issue issues problem problems error errors "
    "need needs needed note notes thanks thank info information"
).split()
NO_CRUX = "concise crux not available"
NO_CRUX_TITLE = "Concise crux not available"
CRUX_WORDS = 10

# Spark's English stop words, those that can be a token (two or more word characters).
ENGLISH_STOP_WORDS = (
    "me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is "
    "are was were be been being have has had having do does did doing an the and but if or because as until "
    "while of at by for with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very can will just don should now "
    "cannot could ought would"
).split()


def stripped(column: str | Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.col(column) if isinstance(column, str) else column, rf"^{SPACE}+|{SPACE}+$", "")


def blank_if_null(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def combined_text(summary: str = "summary", description: str = "description") -> Column:
    """Summary, line break, description; missing parts count as empty."""
    return F.concat(blank_if_null(summary), F.lit("\n"), blank_if_null(description))


def combined_text_with_labels() -> Column:
    """Summary, description, feature and error type, joined by blanks that stay if a part is missing."""
    parts = [blank_if_null(c) for c in ("summary", "description", "feature", "error_type")]
    return F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2], F.lit(" "), parts[3])


def without_addresses(text: str | Column, strip_ticket_keys: bool = False) -> Column:
    """Lower case without mail addresses and URLs; texts without the signs that these hold are not searched for them."""
    t = whole = blank_if_null(text)
    if strip_ticket_keys:
        t = F.regexp_replace(t, TICKET_KEY, " ")
    t = F.lower(t)
    t = F.when(F.contains(whole, F.lit("@")), F.regexp_replace(t, EMAIL, " ")).otherwise(t)
    return F.when(F.contains(whole, F.lit("://")), F.regexp_replace(t, URL, " ")).otherwise(t)


def normalize_text(text: str | Column, strip_ticket_keys: bool = False) -> Column:
    """Lower case without mail addresses and URLs, white space collapsed.

    Ticket keys stay by default: the rule for them looks for capitals after lower-casing.
    """
    return F.trim(F.regexp_replace(without_addresses(text, strip_ticket_keys), f"{SPACE}+", " "))


def crux_of(text: str | Column) -> Column:
    """The first ten informative words of a text, or the sentinel."""
    t = F.lower(blank_if_null(text))
    for pattern in (HEX_ID, LOWER_TICKET_KEY, WWW_URL, EMAIL):
        t = F.regexp_replace(t, pattern, " ")
    stop = F.array(*[F.lit(w) for w in CRUX_STOP_WORDS])
    words = F.filter(F.regexp_extract_all(t, F.lit(CRUX_TOKEN), F.lit(0)), lambda w: ~F.array_contains(stop, w))
    joined = F.array_join(F.slice(words, 1, CRUX_WORDS), " ")
    return F.when(joined == "", F.lit(NO_CRUX)).otherwise(joined)


def tokens(text: str | Column) -> Column:
    """Lower-case words of two or more word characters."""
    return F.regexp_extract_all(F.lower(blank_if_null(text)), F.lit(TOKEN), F.lit(0))


def cut(text: str | Column, length: int) -> Column:
    return F.substring(text, 1, length)


def json_object_in(text: str | Column) -> Column:
    """From the first ``{`` to the last ``}``, over line breaks; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def _only_object(text: Column) -> Column:
    """The object a text consists of; null if anything follows it (the JSON parser alone would not mind)."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


# JSON forms Python counts as false.
FALSY_JSON = ["", "null", "false", "0", "0.0", "-0", "-0.0", "[]", "{}"]


def label_from_reply(reply: str | Column, field: str, default: str = "General") -> Column:
    """A label from a model's JSON reply; the default if the reply does not parse or the label is blank."""
    parsed = _only_object(json_object_in(reply))
    raw = F.try_variant_get(parsed, f"$.{field}", "string")
    kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
    truthy = (kind == "STRING") | ~raw.isin(FALSY_JSON)
    text = F.when(kind == "BOOLEAN", F.initcap(raw)).otherwise(raw)
    return F.coalesce(F.nullif(stripped(F.when(truthy, text)), F.lit("")), F.lit(default))


def pattern_field(reply: str | Column, field: str) -> Column:
    """A text field of a model's pattern reply, null if absent or blank."""
    parsed = _only_object(json_object_in(reply))
    return F.nullif(stripped(F.try_variant_get(parsed, f"$.{field}", "string")), F.lit(""))


def vocabulary_of(labels: str | Column) -> Column:
    """A comma-separated list as an array, trimmed, without blanks."""
    column = F.col(labels) if isinstance(labels, str) else labels
    return F.filter(F.transform(F.split(column, ","), stripped), lambda x: x != "")


def label_in_vocabulary(label: Column, vocabulary: Column, default: str = "General") -> Column:
    return F.when(F.array_contains(vocabulary, label), label).otherwise(F.lit(default))


def integer_or(text: str | Column, default: int) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.try_cast("bigint"), F.lit(default).cast("bigint"))


def number_or(text: str | Column, default: float) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.try_cast("double"), F.lit(default).cast("double"))


# The keys below which a rich-text node keeps its parts, in reading order.
RICH_TEXT_KEYS = ("content", "paragraphs", "items", "children")


def _texts_of(document: dict) -> str:
    found, waiting = [], [document]
    while waiting:
        node = waiting.pop()
        if isinstance(node, list):
            waiting.extend(reversed(node))
        elif isinstance(node, dict):
            if isinstance(node.get("text"), str):
                found.append(node["text"])
            waiting.extend(node[k] for k in reversed(RICH_TEXT_KEYS) if k in node)
    return " ".join(t for t in found if t)


@F.pandas_udf(T.StringType())
def _flatten_document(documents: pd.Series) -> pd.Series:
    def flatten(raw):
        if raw is None:
            return None
        value = json.loads(raw)
        return (_texts_of(value) if isinstance(value, dict) else "") or str(value)

    return documents.map(flatten)


def rich_text(raw_json: str | Column) -> Column:
    """Plain text of a JSON value: strings as they are, documents flattened in reading order.

    Depth is unbounded, so documents go through an Arrow batch function; plain strings do not.
    """
    column = F.col(raw_json) if isinstance(raw_json, str) else raw_json
    value = F.try_parse_json(column)
    is_text = F.schema_of_variant(value) == "STRING"
    document = F.when(value.isNotNull() & ~F.is_variant_null(value) & ~is_text, column)
    return F.coalesce(F.when(is_text, F.try_variant_get(value, "$", "string")), _flatten_document(document), F.lit(""))
