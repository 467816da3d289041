"""Text handed to a model, and the texts used when there is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_PROMPT = (
    "Label this incident ticket. Answer with a JSON object with the keys 'feature' (module or integration) "
    "and 'error_type' (class of failure), each of three words at most."
)
SUMMARY_PROMPT = (
    "Summarise these related incident tickets in a few neutral sentences: what failed and where, symptoms and "
    "scope, likely root cause, one next action.\n\nContext:\n"
)
CRUX_PROMPT = "Give the core failure of this summary as a noun phrase of 5 to 10 words, nothing else.\n\n"
PATTERN_PROMPT = (
    "Describe the pattern behind these related tickets as a JSON object with the text keys pattern_summary, "
    "detailed_summary, root_cause and recommendation.\n\nTickets:\n"
)

# Texts of the report when no model answers, and the lengths texts are cut to.
DETAILED_FALLBACK = "Related issues show similar failures across multiple tickets over the tracked period."
CAUSE_FALLBACK = "Cause not confidently inferred."
ADVICE_FALLBACK = "Investigate logs and add validation and error handling in the affected module."
SEE_SUMMARY = "See summary"
LABEL_TEXT_LENGTH = 4000
CLUSTER_TEXT_LENGTH = 8000
NOTE_LENGTH = 240
SAMPLE_LENGTH = 120


def label_prompt(
    text: Column, features: Column | None = None, error_types: Column | None = None, task: str = LABEL_PROMPT
) -> Column:
    """Prompt for the two labels of a ticket; vocabularies (arrays) are added as choices if not empty."""
    parts = [F.lit(task)]
    for title, choices in (("Feature choices", features), ("Error type choices", error_types)):
        if choices is not None:
            listed = F.concat(F.lit(f"\n{title}: "), F.array_join(choices, ", "))
            parts.append(F.when(F.size(choices) > 0, listed).otherwise(F.lit("")))
    return F.concat(*parts, F.lit("\n\nText:\n"), F.substring(text, 1, LABEL_TEXT_LENGTH))


def summary_prompt(cluster_text: Column, task: str = SUMMARY_PROMPT) -> Column:
    return F.concat(F.lit(task), cluster_text)


def crux_prompt(summary: Column, task: str = CRUX_PROMPT) -> Column:
    return F.concat(F.lit(task), summary)


def pattern_prompt(cluster_text: Column, task: str = PATTERN_PROMPT) -> Column:
    return F.concat(F.lit(task), cluster_text, F.lit("\n"))


def note_fallback(sample: Column) -> Column:
    """Stand-in for a cluster's summary, from its first three ticket summaries."""
    return F.concat(
        F.lit("Grouped similar incidents. Representative notes: "), F.substring(sample, 1, NOTE_LENGTH), F.lit("...")
    )


def pattern_fallback(first_text: Column) -> Column:
    return F.concat(F.lit("Repeated issue pattern: "), F.substring(first_text, 1, SAMPLE_LENGTH), F.lit("..."))
