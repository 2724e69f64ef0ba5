import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from snapgrid.llm import queries, turn_repair
from snapgrid.llm.turn_repair import NO_ROW, START, Conversation, _Steps, repaired_turns, repairs, step

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile("[\x20\x09-\x0d]*")


def cheapest(rows):
    """(cost, audit, repaired turns) by trying, for every end of the text so far, all edits; whole strings compared."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def better(held, way, option):
        if way not in held or option[:2] < held[way][:2]:
            held[way] = option

    def inserted(held):
        for _ in range(4):
            for way, (cost, audit, out) in list(held.items()):
                for c in after[way].replace("s", ""):
                    better(held, c, (cost + 5, audit + "I", [*out, (names[c], "")]))
        return held

    ways = inserted({"": (0, "", [])})
    for role, text, gone, cut in rows:
        ahead = {}
        for way, (cost, audit, out) in ways.items():
            better(ahead, way, (cost + 2, audit + "D", out))
            for c in "" if gone else after[way]:
                if role[:1] == c:
                    better(ahead, c, (cost + 5 * cut, audit + "K", [*out, (role, text)]))
                if c in names:
                    better(ahead, c, (cost + 1 + 5 * cut, audit + "R", [*out, (names[c], text)]))
        ways = inserted(ahead)
    return min((ways[w] for w in ("", "a") if w in ways), key=lambda o: o[:2])


def brute(rows):
    """Counts, cost, audit and repaired turns of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, told = set(), []
    for _, role, text in rows:
        blank = BLANK.fullmatch(text) is not None
        again = not blank and (role, text) in seen
        cut = not blank and not again and text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] not in ".!?"
        seen.add((role, text))
        told.append((blank, again, cut))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] or " " for _, r, _ in rows]
    cost, audit, out = cheapest([(r, x, b or d, c) for (_, r, x), (b, d, c) in zip(rows, told)])
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": sum(b for b, _, _ in told), "duplicate": sum(d for _, d, _ in told), "truncated": sum(c for _, _, c in told),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    }, out


def conversations(n=400, longest=14):
    rng = random.Random(8)
    texts = ["Yes.", "No?", "cut", "", " \n", " ", "Done!\t\n", "x.\u0085", None, "Ünï.", "a\nb."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "umpire"]
    rows = []
    for conv in range(n):
        size = rng.randint(1, longest)
        turn = 0
        for i in range(size):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            fit = ["user", "assistant"][i % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv if conv else None, turn if rng.random() < 0.95 else None, fit, rng.choice(texts) if rng.random() < 0.4 else f"t{i}."))
    return rows


def by_conversation(rows):
    held = {}
    for conv, *row in rows:
        held.setdefault(conv, []).append(tuple(row))
    return held


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_repairs_equal_brute_force(spark, batch):
    """State travels across batches: with three rows a batch, every conversation spans several."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = conversations()
        frame = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("present"), F.lit("x").alias("audit"))
        found = repairs(frame)
        got = {r["conv_id"]: r.asDict() for r in found.collect()}
        turns = {}
        for r in repaired_turns(frame, found).collect():
            turns.setdefault(r["conv_id"], []).append(r)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = by_conversation(rows)
    assert got.keys() == want.keys()
    for conv, own in want.items():
        expected, out = brute(own)
        assert got[conv] == {"conv_id": conv, **expected}, own
        made = sorted(turns.get(conv, []), key=lambda r: r["place"])
        assert [(r["role"], r["text"]) for r in made] == out
        assert [r["place"] for r in made] == list(range(len(out)))
        assert [r["edit"] for r in made] == [e for e in expected["audit"] if e != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in made))


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x in conversations(300)] + [(10**6 + i, None if i % 2 else i, "user", "Hi.") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r.asDict() for r in queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    held = {}
    for conv, turn, role, text in rows:
        mine = held.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2 and text is not None:
            text = re.sub("[.!?]", "", text)
        mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert got == {conv: {"conv_id": conv, **brute(own)[0]} for conv, own in held.items()}
    assert any(not own for own in held.values())


def test_long_conversations_spill(spark, monkeypatch):
    """Back references beyond the limit go to the task's scratch space; the audit is read back in blocks."""
    monkeypatch.setattr(turn_repair, "HELD", 1 << 12)
    rng = random.Random(3)
    rows = [(rng.choice(["user", "assistant", "system", "tool"]), f"t{i}", rng.random() < 0.1, rng.random() < 0.2) for i in range(70_000)]
    one = Conversation(_Steps())
    for i, (role, text, gone, cut) in enumerate(rows):
        one.add(i, role, text, role[0], gone, False, cut and not gone)
    assert one.back._rolled
    found = one.result()
    short = rows[:3_000]
    whole = Conversation(_Steps())
    for i, (role, text, gone, cut) in enumerate(short):
        whole.add(i, role, text, role[0], gone, False, cut and not gone)
    cost, audit, _ = cheapest([(r, x, g, c and not g) for r, x, g, c in short])
    assert (whole.result()["cost"], whole.state is not None) == (cost, True)
    assert len(found["audit"].replace("I", "")) == 70_000 and found["gaps"] == 0


def test_the_program_has_few_states():
    """All states that rows of any kind can lead to: the numbers of their steps fit two bytes."""
    kinds = [(i, g, c) for i in "suax" for g, c in ((False, False), (False, True), (True, False))]
    seen, ahead = set(), [step(START, NO_ROW)[0]]
    while ahead:
        state = ahead.pop()
        if state not in seen:
            seen.add(state)
            ahead += [step(state, kind)[0] for kind in kinds]
    assert len(seen) * len(kinds) < 1 << 16


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = repairs(empty)
    assert found.count() == 0 and repaired_turns(empty, found).count() == 0
