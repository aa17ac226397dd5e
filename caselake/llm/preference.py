"""Preference formatting of chosen and rejected conversations (DataFrame functions only).

The longest common prefix of turns becomes the prompt, rendered once.  What
follows on either side becomes a completion, cut into segments that carry a
loss flag: headers and turns of others are 0, what the assistant says is 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Turn number of a replaced final answer: after every other turn.
_LAST = (1 << 63) - 1


def _header(role: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"))


def _body(text: Column) -> Column:
    return F.concat(text, F.lit("<|im_end|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t["role"]), _body(t["text"]))), "")


def _segments(turns: Column, trained_role: str) -> Column:
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.array(
                F.struct(_header(t["role"]).alias("text"), F.lit(0).alias("loss")),
                F.struct(_body(t["text"]).alias("text"), (t["role"] == trained_role).cast("int").alias("loss")),
            ),
        )
    )


def format_preferences(chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row for each ``pair_id`` of either side.

    ``chosen`` and ``rejected`` have the columns pair_id, turn, role, text, a
    row for each turn; further columns are ignored.  Returns pair_id,
    n_prompt_turns, prompt, chosen and rejected (strings), chosen_segments and
    rejected_segments (array of text and loss).

    Turns are taken in the order of turn (nulls first), role and text, so
    repeated turn numbers give a stable result.  A null role or text counts as
    empty.  Rows without pair_id belong to no conversation and give nothing.  A
    side that is missing has no turns: the prompt is then empty, and so is that
    completion.  Equal sides are all prompt.  Empty tables give an empty result.
    One conversation is one row, so a group is as large as the conversation.
    """

    def side(df: DataFrame, which: int) -> DataFrame:
        return df.select(
            F.col("pair_id"),
            F.lit(which).alias("side"),
            F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
        ).filter(F.col("pair_id").isNotNull())

    both = side(chosen, 0).unionByName(side(rejected, 1))
    turns = both.groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == 0, F.col("t")))).alias("a"),
        F.array_sort(F.collect_list(F.when(F.col("side") == 1, F.col("t")))).alias("b"),
    )
    shorter = F.least(F.size("a"), F.size("b"))
    same = lambda i: F.get("a", i)["role"].eqNullSafe(F.get("b", i)["role"]) & F.get("a", i)["text"].eqNullSafe(F.get("b", i)["text"])
    at = F.when(shorter > 0, F.filter(F.sequence(F.lit(0), shorter - 1), lambda i: ~same(i))).otherwise(F.array().cast("array<int>"))
    cut = turns.withColumn("n_prompt_turns", F.coalesce(F.get(at, F.lit(0)), shorter))
    n = F.col("n_prompt_turns")
    rest = lambda c: F.slice(c, n + 1, F.size(c))
    return cut.select(
        "pair_id",
        n,
        _render(F.slice("a", F.lit(1), n)).alias("prompt"),
        _render(rest("a")).alias("chosen"),
        _render(rest("b")).alias("rejected"),
        _segments(rest("a"), trained_role).alias("chosen_segments"),
        _segments(rest("b"), trained_role).alias("rejected_segments"),
    )


def swapped_answers(turns: DataFrame) -> DataFrame:
    """A rejected side for each conversation, whose final answer is another's.

    A conversation keeps the turns before its last assistant turn; then comes
    the last assistant turn of its partner, the conversation whose id differs in
    the lowest bit.  Without a partner or an answer of the partner's, nothing
    follows.  Takes conv_id, turn, role, text; returns pair_id, turn, role, text.
    """
    own = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    final = own.filter(F.col("role") == "assistant").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("final"))
    before = own.join(final, "conv_id", "left").filter(F.col("final").isNull() | F.col("turn").isNull() | (F.col("turn") < F.col("final.turn")))
    other = final.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("pair_id"), F.lit(_LAST).alias("turn"), F.lit("assistant").alias("role"), F.col("final.text").alias("text"))
    known = own.select(F.col("conv_id").alias("pair_id")).distinct()
    return before.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text").unionByName(other.join(known, "pair_id", "left_semi"))


def op1_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen, against the same one with another's final answer."""
    turns = table(spark, sf_dir, "conversations")
    out = format_preferences(turns.withColumnRenamed("conv_id", "pair_id"), swapped_answers(turns))
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["loss"].cast("string"), F.lit(":"), F.char_length(s["text"]).cast("string"))), ",")
    return out.select(
        F.col("pair_id").alias("conv_id"),
        F.col("n_prompt_turns").cast("int").alias("n_prompt_turns"),
        "prompt",
        "chosen",
        "rejected",
        mask(F.col("chosen_segments")).alias("chosen_mask"),
        mask(F.col("rejected_segments")).alias("rejected_mask"),
    )


OP1_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
final AS (
  SELECT conv_id, max({'turn': turn, 'text': text}).turn AS last_turn, max({'turn': turn, 'text': text}).text AS answer FROM t WHERE role = 'assistant' GROUP BY conv_id),
r AS (
  SELECT t.conv_id, turn, role, text FROM t LEFT JOIN final USING (conv_id) WHERE last_turn IS NULL OR turn IS NULL OR turn < last_turn
  UNION ALL
  SELECT k.conv_id, 9223372036854775807, 'assistant', f.answer
  FROM (SELECT DISTINCT conv_id FROM t) k JOIN final f ON f.conv_id = xor(k.conv_id, 1)),
a AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS a FROM t GROUP BY conv_id),
b AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS b FROM r GROUP BY conv_id),
ab AS (
  SELECT conv_id, a, coalesce(b, []) AS b FROM a LEFT JOIN b USING (conv_id)),
cut AS (
  SELECT conv_id, a, b, coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])) - 1, least(len(a), len(b))) AS n FROM ab)
SELECT conv_id, n::INT AS n_prompt_turns,
  array_to_string(list_transform(a[1:n], lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '') AS prompt,
  array_to_string(list_transform(a[n + 1:], lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '') AS chosen,
  array_to_string(list_transform(b[n + 1:], lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '') AS rejected,
  array_to_string(list_transform(a[n + 1:], lambda t: '0:' || (13 + length(t.role)) || ',' || (t.role = 'assistant')::INT || ':' || (11 + length(t.text))), ',') AS chosen_mask,
  array_to_string(list_transform(b[n + 1:], lambda t: '0:' || (13 + length(t.role)) || ',' || (t.role = 'assistant')::INT || ':' || (11 + length(t.text))), ',') AS rejected_mask
FROM cut
"""
