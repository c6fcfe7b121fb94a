from voxlens.llm.chat import assemble, format_pairs
from voxlens.llm.q_chat import preference_turns


def turn(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def pairs(spark, rows):
    return spark.createDataFrame([(*r, 1, 1) for r in rows],
                                 "pair_id int, side string, turn int, role string, text string, part int, first int")


def test_parts(spark):
    both = [(1, s, 0, "user", "hi") for s in ("chosen", "rejected")]
    rows = [*both, *both, (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 1, "assistant", "no"),
            (1, "chosen", 2, "user", "x"), (1, "rejected", 2, "user", "x"), (1, "chosen", 3, "assistant", "z"),
            (2, "chosen", 0, None, None), (2, "rejected", 0, "", ""), (3, "chosen", 0, "assistant", "q"),
            (None, "chosen", 0, "a", "b"), (4, None, 0, "a", "b"), (5, "chosen", None, "a", "b"), (6, "other", 0, "a", "b")]
    parts = format_pairs(pairs(spark, rows))
    made = {r.pair_id: r for r in assemble(parts).collect()}
    assert sorted(made) == [1, 2, 3]
    one = made[1]
    assert one.prompt == turn("user", "hi")
    assert one.chosen == turn("assistant", "yes") + turn("user", "x") + turn("assistant", "z")
    assert one.rejected == turn("assistant", "no") + turn("user", "x")
    assert [one.chosen[a:b] for a, b in one.chosen_loss] == ["yes<|im_end|>\n", "z<|im_end|>\n"]
    assert [one.rejected[a:b] for a, b in one.rejected_loss] == ["no<|im_end|>\n"]
    assert (made[2].prompt, made[2].chosen, made[2].rejected) == (turn("", ""), "", "")
    assert (made[3].prompt, made[3].chosen, made[3].rejected) == ("", turn("assistant", "q"), "")
    assert {(r.part, r.loss_start, r.loss_end) for r in parts.where("part = 'prompt'").collect()} == {("prompt", 0, 0)}


def test_a_longer_side_and_repeated_turns(spark):
    rows = [(1, "chosen", 0, "user", "b"), (1, "chosen", 0, "user", "a"), (1, "rejected", 0, "user", "a"),
            (1, "chosen", 1, "assistant", "c")]
    got = {(r.part, r.turn, r.rendered) for r in format_pairs(pairs(spark, rows)).collect()}
    assert got == {("prompt", 0, turn("user", "a")), ("chosen", 1, turn("assistant", "c"))}
    assert format_pairs(pairs(spark, rows).limit(0)).count() == 0


def test_long_conversations_stay_rows(spark):
    rows = [(1, s, t, "user", f"{t}") for s in ("chosen", "rejected") for t in range(3000)]
    rows += [(1, "chosen", 3000, "assistant", "x" * 100000)]
    parts = format_pairs(pairs(spark, rows))
    assert parts.where("part = 'prompt'").count() == 3000 and parts.where("part = 'chosen'").count() == 1


def test_sparse_ids(spark):
    """Conversations far apart have neighbours too; one without a reply, or alone, has no pair."""
    rows = [(c, t, r, f"{r} {c}") for c in (-5, 0, 1000, 10**12, 7) for t, r in enumerate(("user", "assistant")) if c != 7 or r == "user"]
    talks = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    said = {(r.pair_id, r.side): r.text for r in preference_turns(talks).where("role = 'assistant'").collect()}
    ring = [-5, 0, 1000, 10**12]
    assert said == {(c, "chosen"): f"assistant {c}" for c in ring} | {(c, "rejected"): f"assistant {ring[(i + 1) % 4]}" for i, c in enumerate(ring)}
    assert preference_turns(talks.where("conv_id in (7, 1000)")).count() == 0
    assert preference_turns(talks.limit(0)).count() == 0
