"""Edge rows for the column functions."""

import pytest
from pyspark.sql import functions as F

from ticketmill.functions import dates as dt
from ticketmill.functions import options as op
from ticketmill.functions import prompts as pr
from ticketmill.functions import text as tx


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalized_text(spark):
    given = {
        None: "",
        "": "",
        "  \t\n ": "",
        "MiXed Case": "mixed case",
        "to é.b@x.com now": "to now",
        "a@b@c d": "@c d",
        "see https://a.b/c?d=1": "see",
        "HTTP://X y": "y",
        "key ABC-123 stays": "key abc-123 stays",
        "tab\tand\nline\x1cbreak": "tab and line break",
        "x" * 50_000 + " end": "x" * 50_000 + " end",
    }
    assert apply(spark, tx.normalize_text, list(given)) == list(given.values())
    assert apply(spark, lambda v: tx.normalize_text(v, strip_ticket_keys=True), ["key ABC-123 xABC-1 A-1"]) == ["key xabc-1 a-1"]


def test_crux(spark):
    given = {
        None: tx.NO_CRUX,
        "Please fix the issue": "the",
        "please should issue": tx.NO_CRUX,
        "code 0xDEAD in abc-12 at www.x.y or https://q.r by m@n.o fails": "code in at or by fails",
        "let's go": "let s go",
        "a b c d e f g h i j k l": "a b c d e f g h i j",
        "no-hex x0x1 time-out": "no-hex x0x1 time-out",
    }
    assert apply(spark, tx.crux_of, list(given)) == list(given.values())


def test_option_values(spark):
    given = {
        None: "Unknown",
        "null": "Unknown",
        '"X"': "X",
        '""': "",
        '{"value":"X"}': "X",
        '{"name":"Y"}': "Y",
        '{"value":"","name":"Y"}': "Y",
        '{"id":1,"on":true,"x":null}': "{'id': 1, 'on': True, 'x': None}",
        '[{"value":"X"},{"name":"Y"}]': "X, Y",
        "[]": "Unknown",
        '["a","","b"]': "a, b",
        '[{"id":1},"z"]': "{'id': 1}, z",
        "7": "7",
        "true": "True",
        "1.50": "1.5",
    }
    assert apply(spark, op.option_text, list(given)) == list(given.values())


def test_named_objects(spark):
    given = {None: "Unknown", "null": "Unknown", '{"name":"Open"}': "Open", '{"name":""}': "", '"Done"': "Done", '""': "Unknown", "{}": "Unknown"}
    assert apply(spark, op.named_object_text, list(given)) == list(given.values())


def test_rich_text(spark):
    given = {
        None: "",
        "null": "",
        '"plain {text}"': "plain {text}",
        '{"content":[{"content":[{"content":[{"text":"deep"}]},{"text":"next"}]}]}': "deep next",
        '{"text":"a","children":[{"text":"b"}],"content":[{"text":"c"}]}': "a c b",
        '{"type":"doc"}': "{'type': 'doc'}",
        "[1]": "[1]",
    }
    assert apply(spark, tx.rich_text, list(given)) == list(given.values())


def test_rich_text_of_great_depth(spark):
    deep = '{"content":[' * 300 + '{"text":"x"}' + "]}" * 300
    assert apply(spark, tx.rich_text, [deep]) == ["x"]


@pytest.mark.parametrize(
    "reply,feature,error_type",
    [
        ('Here: {"feature": "Billing", "error_type": " Auth "} ok', "Billing", "Auth"),
        ('{"feature": "a"}\nand {"error_type": "b"}', "General", "General"),
        ('{"feature": "a"},{"error_type": "b"}', "General", "General"),
        ('{"feature": ""}', "General", "General"),
        ('{"feature": 3, "error_type": false}', "3", "General"),
        ('{"feature": true, "error_type": 0}', "True", "General"),
        ('{"feature": "0", "error_type": "null"}', "0", "null"),
        ("nothing", "General", "General"),
        (None, "General", "General"),
        ("{not json}", "General", "General"),
    ],
)
def test_label_replies(spark, reply, feature, error_type):
    assert apply(spark, lambda v: tx.label_from_reply(v, "feature"), [reply]) == [feature]
    assert apply(spark, lambda v: tx.label_from_reply(v, "error_type"), [reply]) == [error_type]


def test_lists_numbers_and_cuts(spark):
    assert apply(spark, lambda v: F.array_join(tx.vocabulary_of(v), "|"), [" a , ,b,", ""]) == ["a|b", ""]
    assert apply(spark, lambda v: tx.integer_or(v, 5), ["7", "x", "", None, "1.5"]) == [7, 5, 5, 5, 5]
    assert apply(spark, lambda v: tx.number_or(v, 0.85), ["0.5", "x", None]) == [0.5, 0.85, 0.85]
    assert apply(spark, lambda v: tx.cut(v, 2), ["äöü", "a", None]) == ["äö", "a", None]
    assert apply(spark, tx.tokens, ["Ä1 x yz_ 日本 a-bc"]) == [["ä1", "yz_", "日本", "bc"]]


def test_times(spark):
    text = lambda v: F.date_format(dt.utc_time(v), "yyyy-MM-dd HH:mm:ss")
    given = {
        "2025-11-03T10:00:00.000+0530": "2025-11-03 04:30:00",
        "2025-11-03T10:00:00Z": "2025-11-03 10:00:00",
        "2025-11-03": "2025-11-03 00:00:00",
        "junk": None,
        "": None,
        None: None,
    }
    assert apply(spark, text, list(given)) == list(given.values())
    assert apply(spark, lambda v: dt.month_tag(dt.utc_time(v)), ["2025-11-03"]) == ["Nov-2025"]


def test_month_edges(spark):
    december = F.lit("2024-12-10").cast("timestamp")
    inside = lambda v: dt.in_month(dt.utc_time(v), december)
    given = {"2024-11-30T23:59:59.999Z": False, "2024-12-01T00:00:00Z": True, "2024-12-31T23:59:59.999Z": True, "2025-01-01T00:00:00Z": False, None: None}
    assert apply(spark, inside, list(given)) == list(given.values())
    months = spark.range(1).select(F.transform(dt.last_months(F.lit("2025-01-31").cast("timestamp")), lambda m: m.cast("string")).alias("m"))
    assert months.first()["m"] == ["2024-11-01", "2024-12-01", "2025-01-01"]


def test_prompts(spark):
    choices = F.array(F.lit("a"), F.lit("b"))
    prompt = apply(spark, lambda v: pr.label_prompt(v, choices, F.array().cast("array<string>"), task="T"), ["x" * 5000])[0]
    assert prompt == "T\nFeature choices: a, b\n\nText:\n" + "x" * 4000
    assert apply(spark, pr.note_fallback, ["s" * 300])[0] == "Grouped similar incidents. Representative notes: " + "s" * 240 + "..."
