"""Preference formatting: a shared prompt, and two completions that part from it.

Chosen and rejected conversations of a pair are compared turn by turn; the turns
they have in common at the start are rendered once, as the prompt, and the rest
of each as a completion with a mask. Only built-in functions: the turns of a pair
are brought together by one grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template: a header, the text, and a closing mark for each turn.
HEADER, CLOSING = "<|{role}|>\n", "<|end|>\n"
LEARNT_ROLE = "assistant"


def _turns(side: bool) -> Column:
    wanted = F.when(F.col("chosen") == F.lit(side), F.struct("turn", "role", "text"))
    return F.transform(F.sort_array(F.collect_list(wanted)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _rendered(turns: Column) -> Column:
    before, after = HEADER.split("{role}")
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(before), t["role"], F.lit(after), t["text"], F.lit(CLOSING))), "")


def _mask(turns: Column) -> Column:
    """Run lengths in characters: ``0xN`` masked, ``1xN`` learnt. Of learnt turns all but the header is."""
    header = len(HEADER) - len("{role}")

    def runs(t: Column) -> Column:
        head, rest = F.length(t["role"]) + header, F.length(t["text"]) + len(CLOSING)
        learnt = F.concat(F.lit("0x"), head.cast("string"), F.lit(",1x"), rest.cast("string"))
        return F.when(t["role"] == LEARNT_ROLE, learnt).otherwise(F.concat(F.lit("0x"), (head + rest).cast("string")))

    return F.array_join(F.transform(turns, runs), ",")


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """From rows ``pair_id, turn, role, text`` of both sides, a row per pair.

    Returns ``pair_id, prefix_turns, chosen_turns, rejected_turns, prompt, chosen,
    rejected, chosen_mask, rejected_mask``. The counts of turns are those after
    the prefix.

    Defined cases: a null role is ``user``, a null text empty; turns are ordered by
    turn (null first), role and text, and repeated rows are repeated turns; a
    pair of which one side has no turns has an empty prompt and an empty
    completion there; two equal conversations have empty completions; rows
    without ``pair_id`` are one pair of a null id; further columns are ignored.
    """

    def side(rows: DataFrame, is_chosen: bool) -> DataFrame:
        return rows.select(
            "pair_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(is_chosen).alias("chosen")
        )

    both = side(chosen, True).unionByName(side(rejected, False)).groupBy("pair_id").agg(_turns(True).alias("c"), _turns(False).alias("r"))
    # The first place where the two differ (also by one being at its end), counted from 1; 0 if there is none.
    differs = F.array_position(F.zip_with("c", "r", lambda a, b: ~a.eqNullSafe(b)), F.lit(True))
    prefix = F.when(differs == 0, F.size("c")).otherwise(differs - 1).cast("int")
    cut = both.withColumn("n", prefix).select(
        "pair_id",
        F.col("n").alias("prefix_turns"),
        F.slice("c", F.lit(1), F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.size("c")).alias("c"),
        F.slice("r", F.col("n") + 1, F.size("r")).alias("r"),
    )
    return cut.select(
        "pair_id",
        F.col("prefix_turns").cast("bigint").alias("prefix_turns"),
        F.size("c").cast("bigint").alias("chosen_turns"),
        F.size("r").cast("bigint").alias("rejected_turns"),
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("c")).alias("chosen_mask"),
        _mask(F.col("r")).alias("rejected_mask"),
    )


def swapped_last_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A chosen and a rejected side for conversations that come without preferences.

    Chosen is every conversation as it is. Rejected is the same up to its last
    ``assistant`` turn, with the answer that its neighbour (the conversation whose
    id differs in the lowest bit) gives there instead; a conversation without an
    answer, or whose neighbour has none, has no rejected side.
    """
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = (
        rows.where((F.col("role") == LEARNT_ROLE) & F.col("pair_id").isNotNull() & F.col("turn").isNotNull())
        .groupBy("pair_id")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
    )
    here = last.select("pair_id", F.col("last.turn").alias("last_turn"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("bigint")).alias("pair_id"), F.col("last.text").alias("answer"))
    swap = here.join(other, "pair_id")
    text = F.when(F.col("turn") == F.col("last_turn"), F.col("answer")).otherwise(F.col("text"))
    rejected = rows.join(swap, "pair_id").where("turn <= last_turn").select("pair_id", "turn", "role", text.alias("text"))
    return rows, rejected
