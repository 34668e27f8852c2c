"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pandas as pd
import pytest

from mercato.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, gone string, `key` string, nth string, fault string, code string, copy string"
CLASHING = ("conv", "gone", "key", "nth", "fault", "code", "copy")
BLANKS = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def cheapest(rows, faults):
    """Least (cost, audit) and the repaired rows, by a best-first search over whole edit sequences."""
    heap, done = [(0, "", 0, "", [])], set()
    while heap:
        cost, audit, at, roles, made = heapq.heappop(heap)
        last = roles[-1:]
        if at == len(rows) and last in ("", "a"):
            return cost, audit, made
        if (at, roles) in done or len(roles) > 2 * len(rows) + 3:
            continue
        done.add((at, roles))

        def put(more, edit, role, text, step, at=at, audit=audit, cost=cost, roles=roles, made=made):
            # s?(ua)+ so far: s only first, then u and a by turns.
            ok = role[:1] == "s" and not roles or role[:1] == "u" and roles[-1:] in ("", "s", "a") or role[:1] == "a" and roles[-1:] == "u"
            if ok:
                heapq.heappush(heap, (cost + more, audit + edit, at + step, roles + role[:1], [*made, f"{role}:{text}"]))

        for role in ("user", "assistant"):
            put(3, "I", role, "", 0)
        if at < len(rows):
            role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, made))
            if faults[at] not in ("blank", "duplicate"):
                extra = 3 * (faults[at] == "truncated")
                put(extra, "K", role, text, 1)
                for new in ("user", "assistant"):
                    put(3 + extra, "R", new, text, 1)


def plain_repair(all_ids, rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role, text))
    out = {}
    for conv in all_ids:
        mine = sorted(groups[conv])
        turns = [t for there, t, _, _ in mine if there]
        faults, seen = [], set()
        for _, _, role, text in mine:
            end = text.rstrip(BLANKS)[-1:]
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] for _, _, role, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") or len(a + b) < 2 for a, b in zip(initials[:-1], initials[1:], strict=True))
        cost, audit, made = cheapest([r[2:] for r in mine], faults)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in repair.FAULTS), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def repaired(llm, rows):
    frame = llm.createDataFrame([(*r, *CLASHING) for r in rows], SCHEMA)
    got = repair.repair(repair.damage(frame)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def chatter(seed, n_conversations, longest):
    draw = random.Random(seed)
    rows = []
    for conv in range(n_conversations):
        for turn in range(draw.randrange(1, longest)):
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = draw.choice(["Yes.", "No!", "Why", "So?\n", "", " \t", None, "Yes.", "é. ", "a\x1f"])
            rows.append((conv, turn if draw.random() < 0.8 else draw.choice([None, 0, 9]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_search_over_all_edits(llm, seed):
    rows = chatter(seed, 150, 9)
    assert repaired(llm, rows) == plain_repair({r[0] for r in rows}, plain_damage(rows))


def test_odd_conversations(llm):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (5, None, "user", "Hi."), (5, None, "assistant", "Hi."), (6, 3, "user", "x" * 3_000_000 + "."),
        (7, -5, "system", "Be."), (7, 900, "user", "Hi."), (7, 901, "assistant", "Ho."), (7, 901, "assistant", "Ho."), (8, 1, "System", "no"), (-9, 2, "usher", "Hi!"),
    ] + [(c, 0, "user", "Hi.") for c in range(100, 160)]
    got = repaired(llm, rows)
    assert got == plain_repair({r[0] for r in rows}, plain_damage(rows))
    gone = [c for c in range(100, 160) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)


def test_nothing(llm):
    assert repaired(llm, []) == {}


def test_giant_conversation_goes_through_the_scratch_file(llm):
    rows = [(1, t, draw, f"{t % 997}" + "." * (t % 3)) for t, draw in enumerate(random.Random(3).choices(["user", "assistant"], k=30_000))]
    got = repaired(llm, rows)[1]
    # The same conversation by the same steps, all in memory and row by row.
    damaged = sorted((t, r, x) for _, t, r, x in plain_damage(rows))
    seen, faced = set(), []
    for t, r, x in damaged:
        fault = "blank" if not x else "duplicate" if (r, x) in seen else "" if x[-1] in ".!?" else "truncated"
        seen.add((r, x))
        faced.append(("1", False, False, t, r, x, fault))
    costs, choices = repair.END_COSTS, []
    for *_, r, _, fault in reversed(faced):
        costs, choice = repair.step(costs, r[:1], fault in ("blank", "duplicate"), fault == "truncated")
        choices.append(choice)
    assert got[5] == costs[0] and set(got[6]) <= set(repair.EDITS) and len(got[6]) >= len(damaged)


def test_spool_reads_backwards(tmp_path):
    for limit in (1, 300, 1 << 20):
        spool = repair.Spool(limit)
        for k in range(50):
            spool.add(k, "user", "x" * k)
        assert list(spool.backwards()) == [(k, "user", "x" * k) for k in reversed(range(50))]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_batches_do_not_matter(size):
    rows = []
    for conv in ("1", "2", " "):
        rows += [(conv, False, False, t, "user" if t % 2 else "assistant", f"{t}.", "truncated" if t % 3 else "") for t in range(7, 0, -1)]
    columns = ["conv", "gone", "no_turn", "turn", "role", "text", "fault"]
    whole = pd.concat(repair.repair_stream([pd.DataFrame(rows, columns=columns)]))
    cut = pd.concat(repair.repair_stream(pd.DataFrame(rows[i : i + size], columns=columns) for i in range(0, len(rows), size)))
    assert whole.to_numpy().tolist() == cut.to_numpy().tolist()
