"""Repair of damaged conversations: the cheapest edits that give them a proper order of roles.

Rows are dealt by conversation and sorted by turn, last turn first.  A dynamic
program over four states (nothing yet, after system, after user, after assistant)
runs down the stream and carries its four costs from one Arrow batch to the next.
For each row it keeps one byte, the choice in each state, next to the row's role and
text; once the first turn is reached, these are walked the other way.  What a giant
conversation keeps goes to a scratch file of its task in pieces, so memory does not
follow the length of a conversation.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.tables import text_key

#: Costs of edits; a truncated row that stays adds TRUNCATED.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Edits by their initials in ASCII order, which settles ties.
EDITS = "DIKR"
DROP, ADD, KEEP, CHANGE = range(4)

#: States: nothing yet, after system, after user, after assistant.  A conversation may end in the first and the last.
N_STATES = 4
#: State after a user or assistant turn that is put in, or made of the row, in each state.
NEXT_STATE = (2, 2, 3, 2)
ROLE_OF_STATE = {2: "user", 3: "assistant"}
#: State after a kept row, by state and initial; none elsewhere.
KEPT_STATE = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Costs after the last row: assistant after user; user and assistant after system.
END_COSTS = (0, 2 * INSERT, INSERT, 0)
#: Adjacent initials that are in order.
IN_ORDER = {("s", "u"), ("u", "a"), ("a", "u")}

FAULTS = ("blank", "duplicate", "truncated")
OUT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Spool:
    """Records kept in memory up to about ``limit`` bytes and then in a scratch file; read last first."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.size = limit, 0
        self.piece: list[tuple[int, str, str]] = []
        self.file, self.starts = None, []

    def add(self, choice: int, role: str, text: str) -> None:
        self.piece.append((choice, role, text))
        self.size += len(role) + len(text) + 64
        if self.size > self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()  # noqa: SIM115  closed in backwards()
            self.starts.append(self.file.tell())
            pickle.dump(self.piece, self.file)
            self.piece, self.size = [], 0

    def backwards(self) -> Iterator[tuple[int, str, str]]:
        yield from reversed(self.piece)
        for start in reversed(self.starts):
            self.file.seek(start)
            yield from reversed(pickle.load(self.file))
        if self.file is not None:
            self.file.close()


def step(after: tuple[int, ...], initial: str, must_go: bool, cut: bool) -> tuple[tuple[int, ...], int]:
    """(costs from this row on, in each state; the first edit in each state, two bits each) from the costs after the row.

    ``must_go``: blank or duplicate, so it can only be deleted.  ``cut``: truncated.
    """
    extra = TRUNCATED if cut else 0
    options = []
    for state in range(N_STATES):
        mine = {DROP: DELETE + after[state]}
        if not must_go:
            if initial in KEPT_STATE[state]:
                mine[KEEP] = extra + after[KEPT_STATE[state][initial]]
            mine[CHANGE] = REROLE + extra + after[NEXT_STATE[state]]
        options.append(mine)
    costs = [min(mine.values()) for mine in options]
    # A turn is put in before the row: user and assistant by turns, so twice at most.
    for _ in range(2):
        for state in range(N_STATES):
            added = INSERT + costs[NEXT_STATE[state]]
            if added < options[state].get(ADD, added + 1):
                options[state][ADD] = added
                costs[state] = min(costs[state], added)
    choice = 0
    for state, mine in enumerate(options):
        choice |= min(edit for edit, cost in mine.items() if cost == costs[state]) << (2 * state)
    return tuple(costs), choice


class Conversation:
    """One conversation as its rows come, the last one first."""

    def __init__(self, name: str | None, steps: dict):
        self.name, self.steps = name, steps
        self.costs, self.spool = END_COSTS, Spool()
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal, self.later = 0, None
        self.last = self.first = None
        self.n_turns = 0

    def add(self, turn: int, no_turn: bool, role: str, text: str, fault: str) -> None:
        if not no_turn:
            self.n_turns += self.first != turn
            self.first = turn
            self.last = turn if self.last is None else self.last
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.later is not None:
            self.illegal += (initial, self.later) not in IN_ORDER
        self.later = initial
        # Few different rows and costs relative to their least one occur, so steps are remembered.
        least = min(self.costs)
        relative = tuple(c - least for c in self.costs)
        known = (relative, initial if initial in ("s", "u", "a") else "", fault)
        if known not in self.steps:
            self.steps[known] = step(relative, known[1], fault in ("blank", "duplicate"), fault == "truncated")
        costs, choice = self.steps[known]
        self.costs = tuple(c + least for c in costs)
        self.spool.add(choice, role, text)

    def finish(self) -> tuple:
        audit, digest, state, first = [], hashlib.sha256(), 0, True

        def out(role: str, text: str) -> None:
            nonlocal first
            digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False

        def put_in() -> None:
            nonlocal state
            state = NEXT_STATE[state]
            out(ROLE_OF_STATE[state], "")
            audit.append(EDITS[ADD])

        for choice, role, text in self.spool.backwards():
            while (edit := choice >> (2 * state) & 3) == ADD:
                put_in()
            audit.append(EDITS[edit])
            if edit == KEEP:
                state = KEPT_STATE[state][role[:1]]
                out(role, text)
            elif edit == CHANGE:
                state = NEXT_STATE[state]
                out(ROLE_OF_STATE[state], text)
        while state in (1, 2):
            put_in()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.n_turns
        return (self.name, gaps, *(self.counts[f] for f in FAULTS), self.illegal, self.costs[0], "".join(audit), digest.hexdigest())


def repair_stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Conversations from rows sorted by conversation and, within it, last row first."""
    steps: dict = {}
    now: Conversation | None = None
    columns = [c.split()[0] for c in OUT.split(", ")]
    for frame in frames:
        done = []
        for conv, gone, no_turn, turn, role, text, fault in frame.itertuples(index=False, name=None):
            if now is None or conv != now.name:
                if now is not None:
                    done.append(now.finish())
                now = Conversation(conv, steps)
            if not gone:
                now.add(turn, no_turn, role, text, fault)
        if done:
            yield pd.DataFrame(done, columns=columns)
    if now is not None:
        yield pd.DataFrame([now.finish()], columns=columns)


def repair(turns: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation of ``turns`` (conv_id, turn, role, text, gone).

    Rows count by turn (null first), then role and text; rows equal in all four are copies.
    Null roles and texts count as one space.  ``gone`` rows only name their conversation.
    A row's first fault counts: blank, duplicate (role and text seen earlier in the
    conversation), truncated (ends in none of ``.!?``).  Edits are Keep 0, Rerole 3, Delete 4
    (the only one for blank and duplicate rows) and Insert of an empty turn 3; a truncated row
    that stays costs 3 more.  Role initials must end up as ``(s?(ua)+)?``; of equally cheap ways
    the one whose initials come first in ASCII counts.  Null is a conversation of its own; one
    without rows has zeros, no edits and the digest of nothing.  Other columns may have any name.
    """
    space = F.lit(" ")
    # No id is a blank, so a blank stands for null: pandas would turn ids with nulls into floats.
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), space).alias("conv"), F.coalesce("gone", F.lit(False)).alias("gone"),
        F.col("turn").isNull().alias("no_turn"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
    ).repartition("conv")
    # Rows of a conversation are together already, so this window needs no exchange.
    seen = Window.partitionBy("conv", "gone", "role", "key").orderBy(F.desc("no_turn"), "turn")
    numbered = rows.withColumn("key", text_key(F.col("text"))).withColumn("nth", F.row_number().over(seen))
    end = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    fault = F.when(end == "", "blank").when(F.col("nth") > 1, "duplicate").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    # Of copies within a turn the first one is no duplicate.
    backwards = numbered.withColumn("fault", fault).sortWithinPartitions("conv", "no_turn", *map(F.desc, ("turn", "role", "text", "nth")))
    repaired = backwards.select("conv", "gone", "no_turn", "turn", "role", "text", "fault").mapInPandas(repair_stream, OUT)
    named = F.when(F.col("conv") != " ", F.col("conv")).cast("long")
    return repaired.select(named.alias("conv_id"), *[c.split()[0] for c in OUT.split(", ")[1:]])


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20, nulls read as one space, as (conv_id, turn, role, text, gone).

    0 drops the row (kept as ``gone``), 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role user.
    """
    space = F.lit(" ")
    read = lambda c: F.coalesce(F.col(c).cast("string"), space)
    code = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", read("role").alias("role"), read("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("code") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")

