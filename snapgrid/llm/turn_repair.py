"""Conversation repair: the cheapest edits that turn a conversation's roles into an optional system turn and then
user and assistant in turn, found in one pass over its rows.

Rows are brought together by conversation, sorted by turn, and streamed. What is carried from row to row, and from
batch to batch, is the state of a dynamic program over the four ways the repaired part can end: nothing yet, a
system turn, a user turn, an assistant turn. For each of them it knows the least cost, which of two ways' edits
come first in ASCII order where they differ, and the running digest of the repaired text; never the rows
themselves. For each row two bytes go to the back: the number of the step taken, from which the edits are read in reverse
when the conversation ends. Beyond ``HELD`` bytes they spill.

Costs differ by little between the four ways, so few different steps occur and each is computed once.

A second stream, ``repaired_turns``, applies the edits and writes the repaired rows. The order of turns is one
conversation's own, so a conversation is one task's work; its memory does not grow with it but for the audit,
a byte for each edit, which is one cell of the result.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.llm.frames import tidy

WORDLESS = r"\A[\x20\x09-\x0D]*\z"
UNFINISHED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"

#: What an edit costs, by its initial; a truncated row that stays costs ``TRUNCATED`` more.
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
#: How the repaired part may end. A whole one ends with nothing or with an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (EMPTY, ASSISTANT)
#: The way after a user or assistant turn is put behind each way.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: A way that costs this much more than another is never part of a cheapest repair: from any way the edits that
#: follow another one can be followed for 10 more (two insertions) at most. This keeps the states finite.
BEYOND = 12
#: Bytes of back references of one conversation in memory; what is beyond spills to the task's scratch space.
HELD = 8 << 20
LEGAL = ("su", "ua", "au")


def kept_way(way: int, initial: str) -> int | None:
    """The way after a row of this role stays, or none if it may not stand there."""
    if initial == "s":
        return SYSTEM if way == EMPTY else None
    if initial == "u":
        return USER if way in (EMPTY, SYSTEM, ASSISTANT) else None
    return ASSISTANT if initial == "a" and way == USER else None


# A state of the program: for each way its cost above the least (None: not reachable), and the order of the edits
# so far for each pair of ways. Order of (a, b): -1 or 1 where a's edits come first or last, 0 where equal, and
# ("in", n) or ("out", n) where b's are a's and n insertions more, or a's are b's and n more.


def _compare(order, a_next: str, b_next: str):
    """The order of two ways' edits after further edits of each, a short text of them."""
    if order in (-1, 1):
        return order
    if order != 0:
        kind, n = order
        a_next, b_next = ("I" * n if kind == "out" else "") + a_next, ("I" * n if kind == "in" else "") + b_next
    if a_next == b_next:
        return 0
    if b_next.startswith(a_next):
        return ("in", len(b_next) - len(a_next))
    if a_next.startswith(b_next):
        return ("out", len(a_next) - len(b_next))
    return -1 if a_next < b_next else 1


def _first(order) -> bool:
    """Whether the first way's edits come before the second's."""
    return order == -1 or (order != 0 and order != 1 and order[0] == "in")


START = ((0, None, None, None), ())


def _orders(pairs) -> dict:
    found = {}
    for a, b, order in pairs:
        found[a, b] = order
        if order in (-1, 0, 1):
            found[b, a] = -order
        else:
            found[b, a] = ("out" if order[0] == "in" else "in", order[1])
    for w in range(4):
        found[w, w] = 0
    return found


@lru_cache(maxsize=None)
def step(state, kind: tuple[str, bool, bool]):
    """One row further. ``kind``: the role's initial, whether the row must go, whether it is truncated.

    Returns the state behind the row, what the least cost rose by, and for each way (the way before, the edits).
    Insertions come behind the row; ``start`` makes those before the first.
    """
    costs, order = state[0], _orders(state[1])
    initial, gone, cut = kind
    options: dict[int, tuple[int, int, str]] = {}

    def offer(way: int, cost: int, origin: int, edits: str) -> None:
        held = options.get(way)
        if held is None or cost < held[0] or (cost == held[0] and _first(_compare(order[origin, held[1]], edits, held[2]))):
            options[way] = (cost, origin, edits)

    if initial == "":  # no row, insertions alone
        for way, cost in enumerate(costs):
            if cost is not None:
                offer(way, cost, way, "")
    else:
        stay = TRUNCATED if cut else 0
        for way, cost in enumerate(costs):
            if cost is None:
                continue
            offer(way, cost + COSTS["D"], way, "D")
            if not gone:
                offer(NEXT[way], cost + COSTS["R"] + stay, way, "R")
                to = kept_way(way, initial)
                if to is not None:
                    offer(to, cost + COSTS["K"] + stay, way, "K")
    for _ in range(2):  # more than two insertions in one place never pay
        for way, (cost, origin, edits) in sorted(options.items()):
            offer(NEXT[way], cost + COSTS["I"], origin, edits + "I")
    least = min(cost for cost, _, _ in options.values())
    options = {way: option for way, option in options.items() if option[0] - least <= BEYOND}
    after = tuple(options[w][0] - least if w in options else None for w in range(4))
    ways = sorted(options)
    pairs = tuple(
        (a, b, _compare(order[options[a][1], options[b][1]], options[a][2], options[b][2])) for i, a in enumerate(ways) for b in ways[i + 1 :]
    )
    return (after, pairs), least, tuple(options[w][1:] if w in options else None for w in range(4))


NO_ROW = ("", False, False)


class _Steps:
    """Numbers for the steps that occur, two bytes each."""

    def __init__(self) -> None:
        self.number: dict = {}
        self.step: list = []

    def of(self, state, kind) -> int:
        key = (state, kind)
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.step)
            self.step.append(step(state, kind))
        return found


def _entry(way: int, role: str, text: str) -> bytes:
    """A repaired turn behind what ends in ``way``."""
    return (b"" if way == EMPTY else b"\n") + f"{role}:{text}".encode("utf-8", "surrogatepass")


class Conversation:
    """The program's state within one conversation."""

    def __init__(self, steps: _Steps) -> None:
        self.steps = steps
        self.back = tempfile.SpooledTemporaryFile(max_size=HELD)
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = self.low = self.high = None
        self.distinct = 0
        self.last = ""
        self.state, self.cost = START, 0
        self.digests = [hashlib.sha256(), None, None, None]
        self._take(NO_ROW, "", "")

    def _take(self, kind, role: str, text: str) -> None:
        number = self.steps.of(self.state, kind)
        self.state, rise, origins = self.steps.step[number]
        self.cost += rise
        self.back.write(struct.pack("<H", number))
        digests = [None] * 4
        for way, found in enumerate(origins):
            if found is None:
                continue
            at, edits = found
            digest = self.digests[at]
            if edits not in ("", "D"):
                digest = digest.copy()
                for edit in edits:
                    if edit == "D":
                        continue
                    to = SYSTEM if edit == "K" and kind[0] == "s" else NEXT[at]
                    digest.update(_entry(at, role, text) if edit == "K" else _entry(at, NAMES[to], text if edit == "R" else ""))
                    at = to
            digests[way] = digest
        self.digests = digests

    def add(self, turn, role: str, text: str, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        """The next row; its faults are exclusive."""
        if self.rows and self.last + initial not in LEGAL:
            self.illegal += 1
        self.rows, self.last = self.rows + 1, initial
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if turn is not None:
            self.distinct += self.high is None or turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self._take((initial, blank or duplicate, truncated), role, text)

    def audit(self) -> str:
        """The edits, read backwards from the better of the whole ends."""
        order = _orders(self.state[1])
        costs = self.state[0]
        whole = [w for w in FINAL if costs[w] is not None]
        way = min(whole, key=lambda w: costs[w])
        if len(whole) == 2 and costs[whole[0]] == costs[whole[1]] and _first(order[whole[1], whole[0]]):
            way = whole[1]
        self.cost += costs[way]
        self.way = way
        backwards, size = bytearray(), self.back.tell()
        block = 1 << 16
        for start in range((size - 1) // block * block, -1, -block):
            self.back.seek(start)
            held = self.back.read(min(block, size - start))
            for (number,) in reversed(list(struct.iter_unpack("<H", held))):
                way, edits = self.steps.step[number][2][way]
                backwards += edits[::-1].encode()
        self.back.close()
        backwards.reverse()
        return backwards.decode()

    def result(self) -> dict:
        audit = self.audit()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {
            "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": self.cost, "audit": audit, "repaired_sha256": self.digests[self.way].hexdigest(),
        }


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _initial(role: Column) -> Column:
    """The role's first character; an empty one has none that may stand, like any unknown role."""
    return F.when(F.length(role) > 0, F.substring(role, 1, 1)).otherwise(F.lit(" "))


def ordered(rows: DataFrame) -> DataFrame:
    """The rows by conversation, each with its faults, sorted by turn (nulls first), then role and text.

    A duplicate is told by a sort within the conversation's partition, so no set of seen texts is held.
    """
    blank = F.col("text").rlike(WORDLESS)
    place = rows.repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "present", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first())
    told = place.withColumn("_again", F.row_number().over(earlier) > 1)
    duplicate = ~blank & F.col("_again")
    faults = told.select(
        "conv_id", "turn", "role", "text", "present", _initial(F.col("role")).alias("initial"), blank.alias("blank"),
        duplicate.alias("duplicate"), (~blank & ~duplicate & F.col("text").rlike(UNFINISHED)).alias("truncated"),
    )
    return faults.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _plain(conversations: DataFrame, absent: Column | None) -> DataFrame:
    def full(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(" ")).alias(c)

    present = F.lit(True) if absent is None else ~absent
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), full("role"), full("text"), present.alias("present"))


def _values(frame: pd.DataFrame, column: str) -> list:
    """Python values of a column, with None for missing ones; integers stay exact."""
    return [None if missing else value for value, missing in zip(frame[column].tolist(), frame[column].isna().tolist())]


_ROW = ["conv_id", "turn", "role", "text", "present", "initial", "blank", "duplicate", "truncated"]


def _exact(rows: DataFrame) -> DataFrame:
    """Numbers as text, so that nulls among them do not turn them into floating point on the way to pandas."""
    return rows.withColumns({"conv_id": F.col("conv_id").cast("string"), "turn": F.col("turn").cast("string")})


def repairs(conversations: DataFrame, absent: Column | None = None) -> DataFrame:
    """One row for each ``conv_id``: counts of faults, the cost, ``audit`` and the digest of the repaired text.

    ``audit`` has the edits' initials in order: Keep, Rerole, Delete, Insert. Of several cheapest ones it is the
    first in ASCII order. The repaired text is ``role:text`` of the repaired turns, joined by newlines. Blank and
    repeated rows (same role and text as an earlier one) must go; rows that do not end in a full stop, ``!`` or
    ``?`` cost more if they stay. Rows for which ``absent`` holds only name their conversation; one without other
    rows has zeros, an empty audit and the digest of nothing.

    Null ids are one conversation, null turns come first, null roles and texts are one space. Rows of one turn
    stand by role and text. A role is told by its first character; unknown ones are never kept as they are. Texts of any
    length; an empty table gives no rows; further columns are not read.
    """
    kind = conversations.schema["conv_id"].dataType

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, running, current = _Steps(), None, None
        for frame in frames:
            done: list[tuple] = []
            for conv, turn, role, text, present, *faults in zip(*[_values(frame, c) for c in _ROW]):
                if running is None or conv != current:
                    if running is not None:
                        done.append((current, running.result()))
                    running, current = Conversation(steps), conv
                if present:
                    running.add(None if turn is None else int(turn), role, text, *faults)
            if done:
                yield pd.DataFrame([{"conv_id": c, **found} for c, found in done])
        if running is not None:
            yield pd.DataFrame([{"conv_id": current, **running.result()}])

    found = _exact(ordered(_plain(conversations, absent))).mapInPandas(stream, f"conv_id string, {COUNTS}")
    return found.withColumn("conv_id", F.col("conv_id").cast(kind))


def repaired_turns(conversations: DataFrame, found: DataFrame, absent: Column | None = None) -> DataFrame:
    """The repaired conversations, one row for each turn: ``conv_id``, ``place`` from 0, ``turn`` (null if inserted),
    ``role``, ``text`` and the ``edit`` that made it: K, R or I.

    ``found`` is what ``repairs`` returned for the same rows. Each conversation's audit travels before its rows.
    """
    kind = conversations.schema["conv_id"].dataType
    rows = _plain(conversations, absent).filter("present").select("conv_id", F.lit(1).alias("part"), "turn", "role", "text")
    audits = found.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = _exact(rows.unionByName(audits).repartition("conv_id").sortWithinPartitions("conv_id", "part", F.col("turn").asc_nulls_first(), "role", "text"))

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        audit, at, way, place = "", 0, EMPTY, 0
        for frame in frames:
            out: list[tuple] = []

            def put(conv, turn, role, text, edit, to) -> None:
                nonlocal way, place
                out.append((conv, place, turn, role, text, edit))
                way, place = to, place + 1

            def insertions(conv) -> None:
                nonlocal at
                while at < len(audit) and audit[at] == "I":
                    put(conv, None, NAMES[NEXT[way]], "", "I", NEXT[way])
                    at += 1

            for conv, part, turn, role, text in zip(*[_values(frame, c) for c in ("conv_id", "part", "turn", "role", "text")]):
                if part == 0:
                    audit, at, way, place = text, 0, EMPTY, 0
                    insertions(conv)
                    continue
                edit, at = audit[at], at + 1
                if edit == "K":
                    put(conv, turn, role, text, "K", SYSTEM if role.startswith("s") else NEXT[way])
                elif edit == "R":
                    put(conv, turn, NAMES[NEXT[way]], text, "R", NEXT[way])
                insertions(conv)
            yield pd.DataFrame(out, columns=["conv_id", "place", "turn", "role", "text", "edit"])

    made = both.mapInPandas(stream, "conv_id string, place long, turn string, role string, text string, edit string")
    return made.withColumns({"conv_id": F.col("conv_id").cast(kind), "turn": F.col("turn").cast("long")})
