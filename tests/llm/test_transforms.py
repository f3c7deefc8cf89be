"""Fill-in-the-middle and conversation repair against plain versions."""

import hashlib
import random

import brute
import numpy as np
import pytest

from listloom.llm import conversation_repair, fill_in_middle
from listloom.llm.common import prepare

TURNS = "conv_id bigint, turn bigint, role string, text string, copies int, part int, block int, stays int"


def texts():
    draw = random.Random("texts")
    made = [None, "", " ", "\n\t ", "x", " x", "x ", "a<P>b c", "<M>", "<P", "S> <", "𝄞 é ç  d", "w " * 100_000, "y" * 300_000]
    made += ["".join(draw.choice("ab ç\n\t<PSM>𝄞  ") for _ in range(draw.randrange(150))) for _ in range(300)]
    return [(i, t) for i, t in enumerate(made)] + [(None, "null key here"), (None, None), (5, "x"), (5, "another text")]


def test_skip_list_reaches_every_rank():
    draw = random.Random(1)
    for n in (0, 1, 2, 3, 17, 1000):
        chars = np.array([draw.randrange(1, 9) for _ in range(n)], dtype=np.int64)
        lanes = fill_in_middle.SkipList(chars, chars * 2)
        for rank in range(n + 1):
            assert lanes.at(rank) == (chars[:rank].sum(), 2 * chars[:rank].sum())
        with pytest.raises(IndexError):
            lanes.at(n + 1)


def test_skip_list_has_express_lanes():
    lanes = fill_in_middle.SkipList(np.ones(100_000, dtype=np.int64), np.ones(100_000, dtype=np.int64)).lanes
    assert len(lanes) >= 6 and sum(len(widths) for widths, _ in lanes) < 150_000
    for widths, _ in lanes:
        assert widths[:, 0].sum() <= 100_000 and (widths[:, 0] >= 1).all()


def test_fill_in_middle_of_odd_rows(spark):
    rows = texts()
    frame = prepare(spark).createDataFrame([(k, t, "x", 1, "f") for k, t in rows], "doc_id bigint, text string, _text string, n int, form string").repartition(3)
    got = sorted((tuple(r) for r in fill_in_middle.transform_documents(frame).collect()), key=repr)
    assert got == sorted(((k, *brute.fill_in_middle(k, t)) for k, t in rows), key=repr)


def test_fill_in_middle_outputs_and_rates(spark):
    frame = spark.createDataFrame(texts(), "doc_id bigint, text string")
    made = fill_in_middle.transform_documents(frame, rates=fill_in_middle.Rates(cut=100, spm=0), seed=7, outputs=True).collect()
    assert {r["form"] for r in made} == {"plain", "psm"}
    by_key = {k: t for k, t in texts() if k != 5 and k is not None}
    for r in made:
        if r["doc_id"] in by_key:
            assert fill_in_middle.restore(r["output"].encode(), r["form"]).decode() == (by_key[r["doc_id"]] or "")
            assert hashlib.sha256(r["output"].encode()).hexdigest() == r["output_sha256"]


def test_fill_in_middle_of_no_rows(spark):
    assert fill_in_middle.transform_documents(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def talks():
    draw = random.Random("talks")
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(draw.randrange(14)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, draw.choice([turn, turn, turn, None, 5]), role, draw.choice(["a.", "b?", "c", " \t", "d!", "x", "y ", "z.\n", None, "é."])))
    rows += [(99, i % 7 if i % 3 else i, "user" if i % 2 or i % 11 == 0 else "assistant", f"t{i % 50}.") for i in range(700)]
    rows += [(100, 3, "user", "the same.")] * 500 + [(101, i, ("user", "assistant")[i % 2], "w " * 50_000 + ".") for i in range(4)]
    return rows


@pytest.mark.parametrize("steps", [3, 64])
def test_conversations_of_odd_rows(spark, steps):
    rows = talks()
    frame = prepare(spark).createDataFrame([(*r, 1, 2, 3, 4) for r in rows], TURNS).repartition(3)
    damaged = conversation_repair.damage(frame)
    got = {r[0]: tuple(r[1:]) for r in conversation_repair.repair_report(damaged, steps).collect()}
    assert got == {conv: brute.repair(kept) for conv, kept in brute.damaged(rows).items()}
    turns = {}
    for r in sorted(conversation_repair.repaired_turns(damaged, steps).collect(), key=lambda r: (r["part"], r["block"])):
        turns.setdefault(r["conv_id"], []).extend(f"{t['role']}:{t['text']}" for t in r["repaired"])
    for conv, report in got.items():
        assert hashlib.sha256("\n".join(turns.get(conv, [])).encode()).hexdigest() == report[-1]


def test_alignment_of_every_short_conversation():
    steps = [("u", 0, False), ("a", 0, False), ("s", 0, False), ("t", 0, True), ("u", 2, False)]
    follows, places = {"0": "u", "s": "u", "a": "u", "u": "a"}, conversation_repair.STATES

    def plain(rest, state, after):
        """Least cost and audit by trying all edits, no two insertions in a row."""
        if not rest:
            return after[state], "", state
        (initial, reps, late), *more = rest
        found = []
        for state, cost, letters in ((state, 0, ""), (follows[state], 3, "I"), (follows[follows[state]], 6, "II")):
            edits = [(4 * max(1, reps), "D" * max(1, reps), state)]
            if not reps:
                edits.append((3 + 3 * late, "R", follows[state]))
                edits += [(3 * late, "K", initial)] * (initial == follows[state] or state == "0" and initial == "s")
            for paid, letter, then in edits:
                c, a, end = plain(more, then, after)
                found.append((cost + paid + c, letters + letter + a, end))
        return min(found)

    draw = random.Random(2)
    for _ in range(400):
        picked = [draw.choice(steps) for _ in range(draw.randrange(1, 5))]
        block = conversation_repair.Block(*[list(c) for c in zip(*picked)])
        after = {x: draw.randrange(8) for x in places}
        aligned = conversation_repair.Alignment(block)
        costs = aligned.costs()
        for i, state in enumerate(places):
            cost, end, audit = aligned.best(state, after)
            assert (cost + after[end], audit, end) == plain(picked, state, after)
            assert min(costs[4 * i + j] + after[x] for j, x in enumerate(places)) == cost + after[end]


def test_conversations_of_no_rows(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversation_repair.repair_conversations(none).collect() == []
    assert conversation_repair.repaired_turns(conversation_repair.damage(none)).collect() == []
