from helpers import plan_of

from tickloom.llm.preferences import preference_pairs, swapped_last_answers

TURNS = "pair_id bigint, turn bigint, role string, text string, prompt string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x") for row in rows], TURNS)


def test_shared_prefix_and_masks(spark):
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "bye")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "bad")]
    row = preference_pairs(frame(spark, chosen), frame(spark, rejected)).first()
    assert (row.prefix_turns, row.chosen_turns, row.rejected_turns) == (1, 2, 1)
    assert row.prompt == "<|user|>\nhi<|end|>\n"
    assert row.chosen == "<|assistant|>\ngood<|end|>\n<|user|>\nbye<|end|>\n" and row.rejected == "<|assistant|>\nbad<|end|>\n"
    assert (row.chosen_mask, row.rejected_mask) == ("0x14,1x12,0x20", "0x14,1x11")
    parts = [part.split("x") for part in row.chosen_mask.split(",")]
    assert sum(int(n) for _, n in parts) == len(row.chosen)


def test_defined_cases(spark):
    same = [(2, 0, "user", "a"), (2, 1, "assistant", "b")]
    chosen = same + [(3, 0, None, None), (3, None, "system", "s"), (4, 0, "user", "x"), (4, 0, "user", "x"), (None, 0, "user", "n")]
    rejected = same + [(3, 0, "user", ""), (4, 0, "user", "x"), (5, 0, "user", "only")]
    got = {r.pair_id: r for r in preference_pairs(frame(spark, chosen), frame(spark, rejected)).collect()}
    assert (got[2].prefix_turns, got[2].chosen, got[2].rejected, got[2].chosen_mask) == (2, "", "", "")
    assert got[3].prefix_turns == 0 and got[3].chosen.startswith("<|system|>")
    assert (got[4].prefix_turns, got[4].chosen_turns, got[4].rejected_turns) == (1, 1, 0)
    assert (got[5].prompt, got[5].chosen, got[5].rejected_turns) == ("", "", 1) and got[None].chosen_turns == 1
    assert preference_pairs(frame(spark, []), frame(spark, [])).count() == 0


def test_rejected_side(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a0"), (0, 2, "user", "thanks"), (1, 0, "assistant", "a1"), (2, 0, "assistant", "alone"), (3, 0, "user", "no answer")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    chosen, rejected = swapped_last_answers(table)
    assert chosen.count() == 6
    assert sorted(map(tuple, rejected.collect())) == [(0, 0, "user", "q"), (0, 1, "assistant", "a1"), (1, 0, "assistant", "a0")]
    assert "Python" not in plan_of(preference_pairs(chosen, rejected)) and "Arrow" not in plan_of(preference_pairs(chosen, rejected))
