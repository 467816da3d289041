"""Preference pairs for training: a shared prompt, and a chosen and a rejected completion with loss masks.

The prompt is the longest common turn prefix of the two conversations, rendered once. The turns after it are rendered
as two completions, each cut into segments with a flag that says whether the loss counts them: what an assistant
says does, headers and other roles do not.

One shuffle by conversation brings the turns together; a conversation is one training example and so one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
HEAD, TAIL = ("<|", "|>\n"), "<|end|>\n"


def gather(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: the id and ``turns``, sorted by turn, then role, then text (nulls first).

    A null role or text counts as empty. Rows without a conversation id take no part. Repeated rows stay repeated turns.
    """
    turn = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    return (
        turns.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("pair_id"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )


def shared_turns(chosen: Column, rejected: Column) -> Column:
    """Length of the longest common prefix; turns are equal if role and text are."""
    alike = F.zip_with(
        F.slice(chosen, 1, F.least(F.size(chosen), F.size(rejected))),
        F.slice(rejected, 1, F.least(F.size(chosen), F.size(rejected))),
        lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]),
    )
    first_other = F.array_position(alike, False)
    return F.when(first_other > 0, first_other - 1).otherwise(F.size(alike)).cast("int")


def segments(turns: Column) -> Column:
    """Rendered turns as (text, trained) segments: a header that is never trained, then the body."""
    of_turn = lambda t: F.array(
        F.struct(F.concat(F.lit(HEAD[0]), t["role"], F.lit(HEAD[1])).alias("text"), F.lit(False).alias("trained")),
        F.struct(F.concat(t["text"], F.lit(TAIL)).alias("text"), (t["role"] == TRAINED_ROLE).alias("trained")),
    )
    return F.flatten(F.transform(turns, of_turn))


def rendered(segs: Column) -> Column:
    return F.array_join(F.transform(segs, lambda s: s["text"]), "")


def mask_of(segs: Column) -> Column:
    """Run lengths in characters with 1 where the loss counts: ``13:0,250:1``."""
    return F.array_join(
        F.transform(segs, lambda s: F.concat(F.length(s["text"]).cast("string"), F.when(s["trained"], ":1").otherwise(":0"))), ","
    )


def preference_rows(pairs: DataFrame) -> DataFrame:
    """Rows (pair_id, chosen, rejected as sorted turns) to training rows.

    ``status`` is ``identical`` if nothing differs, ``extension`` if one conversation continues the other, ``no_reply``
    if a completion has no trained segment, else ``pair``. Only ``pair`` rows are usable for training; all rows are
    returned. Null turn lists count as empty.
    """
    empty = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    df = pairs.select("pair_id", F.coalesce("chosen", empty).alias("c"), F.coalesce("rejected", empty).alias("r"))
    df = df.withColumn("n", shared_turns(F.col("c"), F.col("r")))
    after = lambda x: F.slice(x, F.col("n") + 1, F.size(x))
    df = df.select(
        "pair_id",
        F.col("n").alias("prompt_turns"),
        rendered(segments(F.slice("c", F.lit(1), F.col("n")))).alias("prompt"),
        segments(after(F.col("c"))).alias("cs"),
        segments(after(F.col("r"))).alias("rs"),
    )
    trained = lambda x: F.exists(x, lambda s: s["trained"])
    status = (
        F.when((F.size("cs") == 0) & (F.size("rs") == 0), "identical")
        .when((F.size("cs") == 0) | (F.size("rs") == 0), "extension")
        .when(~trained(F.col("cs")) | ~trained(F.col("rs")), "no_reply")
        .otherwise("pair")
    )
    return df.select(
        "pair_id",
        status.alias("status"),
        "prompt_turns",
        "prompt",
        rendered(F.col("cs")).alias("chosen"),
        mask_of(F.col("cs")).alias("chosen_mask"),
        rendered(F.col("rs")).alias("rejected"),
        mask_of(F.col("rs")).alias("rejected_mask"),
    )


def cut_last_reply(turns: Column) -> Column:
    """The same conversation with its last assistant turn cut to its first line: a worse answer to the same prompt."""
    last = F.array_max(F.transform(turns, lambda t, i: F.when(t["role"] == TRAINED_ROLE, i)))
    return F.transform(
        turns,
        lambda t, i: F.when(
            i == last,
            F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.substring_index(t["text"], "\n", 1).alias("text")),
        ).otherwise(t),
    )


def preference_sql() -> str:
    """Preference rows of conversations against their copies with a cut last reply, in DuckDB's SQL."""
    render = lambda x: f"coalesce(list_aggregate([('<|' || t.role || '|>' || chr(10)) || (t.text || '<|end|>' || chr(10)) for t in {x}], 'string_agg', ''), '')"
    mask = lambda x: f"coalesce(list_aggregate([(length(t.role) + 5) || ':0,' || (length(t.text) + 8) || CASE WHEN t.role = 'assistant' THEN ':1' ELSE ':0' END for t in {x}], 'string_agg', ','), '')"
    return f"""WITH g AS (SELECT conv_id, list(struct_pack(turn := turn, role := coalesce(role, ''), "text" := coalesce("text", '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS c
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
      l AS (SELECT *, list_max([CASE WHEN c[i].role = 'assistant' THEN i END for i in range(1, len(c) + 1)]) AS last FROM g),
      p AS (SELECT conv_id, c, [CASE WHEN i = last THEN struct_pack(turn := c[i].turn, role := c[i].role, "text" := string_split(c[i]."text", chr(10))[1]) ELSE c[i] END for i in range(1, len(c) + 1)] AS r FROM l),
      n AS (SELECT *, coalesce(list_min([CASE WHEN c[i].role <> r[i].role OR c[i]."text" <> r[i]."text" THEN i - 1 END for i in range(1, len(c) + 1)]), len(c)) AS n FROM p),
      s AS (SELECT *, c[n + 1:] AS cs, r[n + 1:] AS rs FROM n)
      SELECT conv_id AS pair_id, CASE WHEN len(cs) = 0 THEN 'identical' WHEN len(list_filter(cs, lambda t: t.role = 'assistant')) = 0 THEN 'no_reply' ELSE 'pair' END AS status,
        n::INT AS prompt_turns, {render('c[1:n]')} AS prompt, {render('cs')} AS chosen, {mask('cs')} AS chosen_mask, {render('rs')} AS rejected, {mask('rs')} AS rejected_mask FROM s"""
