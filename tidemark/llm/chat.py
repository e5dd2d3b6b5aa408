"""Preference pairs from chosen and rejected conversations, with built-in expressions only.

The turns that both conversations begin with are rendered once, as the prompt. What follows in each is a completion;
its mask is the list of character ranges that the model is to learn: the texts of the assistant with their end marks.
A pair is one row of one aggregation, so a corpus of many pairs is shuffled once and no pair meets another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks around a turn.
BEGIN, AFTER_ROLE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def _turns(side: str) -> Column:
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return F.sort_array(F.collect_list(F.when(F.col("_side") == side, turn)))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), turn["role"], F.lit(AFTER_ROLE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Ranges of the learned characters of rendered turns, ends exclusive, in code points."""

    def step(held: Column, turn: Column) -> Column:
        start = held["at"] + F.length(_head(turn))
        end = start + F.length(turn["text"]) + len(END)
        span = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        spans = F.when(turn["role"] == LEARNED, F.array_append(held["spans"], span)).otherwise(held["spans"])
        return F.struct(end.cast("bigint").alias("at"), spans.alias("spans"))

    start = F.struct(
        F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    )
    return F.aggregate(turns, start, step, lambda held: held["spans"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask`` for every pair_id of either side.

    Both sides have ``pair_id``, ``turn``, ``role``, ``text``. Turns are ordered by turn, role and text, so ties have a
    fixed order; repeated rows are repeated turns. Turns are common while role and text are equal. Null roles and texts
    count as empty, a null turn comes first, and a null pair_id takes no part. A side without turns has an empty
    completion; so have both sides of equal conversations, whose turns are all prompt. Empty input gives no rows. Other
    columns are ignored.
    """
    columns = ["pair_id", "turn", "role", "text"]
    rows = chosen.select(*columns, F.lit("c").alias("_side")).union(rejected.select(*columns, F.lit("r").alias("_side")))
    pairs = rows.where("pair_id is not null").groupBy("pair_id").agg(_turns("c").alias("c"), _turns("r").alias("r"))
    same = F.zip_with("c", "r", lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    differs = F.array_position(same, F.lit(False))
    common = F.when(differs > 0, differs - 1).otherwise(F.least(F.size("c"), F.size("r"))).cast("int")
    pairs = pairs.withColumn("n_common", common)
    pairs = pairs.select(
        "pair_id",
        "n_common",
        F.slice("c", F.lit(1), F.col("n_common")).alias("p"),
        F.slice("c", F.col("n_common") + 1, F.size("c")).alias("c"),
        F.slice("r", F.col("n_common") + 1, F.size("r")).alias("r"),
    )
    return pairs.select(
        "pair_id",
        "n_common",
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("c")).alias("chosen_mask"),
        _mask(F.col("r")).alias("rejected_mask"),
    )


def with_other_answers(conversations: DataFrame) -> DataFrame:
    """Rejected counterparts: each conversation up to its last assistant turn, then the last answer of the next id.

    ``conversations``: ``conv_id``, ``turn``, ``role``, ``text``. Where the next id has no answer, or the conversation
    has none itself, there is no counterpart. Of several last answers the largest text counts.
    """
    answers = conversations.where(F.col("role") == LEARNED).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    answers = answers.select("conv_id", F.col("last.turn").alias("at"), F.col("last.text").alias("answer"))
    given = answers.select((F.col("conv_id") - 1).alias("conv_id"), F.col("answer").alias("other"))
    known = answers.join(given, "conv_id").select("conv_id", "at", "other")
    kept = conversations.join(known, "conv_id").where((F.col("turn") < F.col("at")) | F.col("turn").isNull())
    kept = kept.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = known.select(F.col("conv_id").alias("pair_id"), F.col("at").alias("turn"), F.lit(LEARNED).alias("role"), F.col("other").alias("text"))
    return kept.union(last)
