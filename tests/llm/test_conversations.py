"""Conversation repair against a search over whole edit sequences."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from ledgerloom.llm import conversations

TURNS = "conv_id long, turn long, role string, text string, cost int, audit string, kind int, conv long"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plan(rows):
    """(cost, audit, repaired) by dynamic programming over (cost, audit) of every state, row by row."""
    order = lambda x: x[:2]

    def inserts(states):
        for _ in range(2):
            for state, (cost, audit, kept) in list(states.items()):
                for role in NEXT[state].replace("s", ""):
                    offer = (cost + 3, audit + "I", kept + [({"u": "user", "a": "assistant"}[role], "")])
                    if role not in states or order(offer) < order(states[role]):
                        states[role] = offer
        return states

    states, seen = inserts({"": (0, "", [])}), set()
    for role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        must = blank or (role, text) in seen
        seen.add((role, text))
        late = 0 if blank or re.sub(r"[\x20\x09-\x0D]+$", "", text)[-1] in ".!?" else 3
        after: dict = {}
        for state, (cost, audit, kept) in states.items():
            offers = [(state, (cost + 4, audit + "D", kept))]
            if not must:
                if role[:1] and role[:1] in NEXT[state]:
                    offers.append((role[0], (cost + late, audit + "K", kept + [(role, text)])))
                for to in NEXT[state].replace("s", ""):
                    offers.append((to, (cost + 3 + late, audit + "R", kept + [({"u": "user", "a": "assistant"}[to], text)])))
            for to, offer in offers:
                if to not in after or order(offer) < order(after[to]):
                    after[to] = offer
        states = inserts(after)
    return min((states[s] for s in ("", "a") if s in states), key=order)


def summary(rows):
    """rows: (turn, role, text) in order."""
    said = [(r, t) for _, r, t in rows]
    count = {"blank": 0, "duplicate": 0, "truncated": 0}
    for k, (role, text) in enumerate(said):
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in said[:k] else "truncated" if body[-1] not in ".!?" else None
        if fault:
            count[fault] += 1
    turns = [t for t, *_ in rows if t is not None]
    cost, audit, kept = plan(said)
    return {**count, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "cost": cost, "audit": audit,
            "illegal": sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:])),
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()}


def brute(rows, harmed=True):
    found: dict = {}
    for conv, turn, role, text in rows:
        said = found.setdefault(conv, [])
        key = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harmed else 9
        role, text = (" " if x is None else x for x in (role, text))
        if key == 0:
            continue
        text = "" if key == 1 else re.sub(r"[.!?]", "", text) if key == 2 else text
        said += [(turn, "user" if key == 4 else role, text)] * (2 if key == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: summary(sorted(said, key=order)) for conv, said in found.items()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", 2, 3) for r in rows], TURNS)


def found(df, **more):
    rows = [r.asDict() for r in conversations.repair(df, **more).collect()]
    out = {r.pop("conv_id"): r for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(seed, convs, most):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n\t", None, "Ünd. \n", "日本語", "Long. " * 30]
    for c in range(convs):
        for k in range(rng.randrange(most + 1)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "useful"])
            turn = rng.choice([k, k, k, k, k + 3, None])
            rows.append((c if c else None, turn, role if rng.random() < 0.4 else ["user", "assistant"][k % 2], rng.choice(texts) if rng.random() < 0.5 else f"Turn {k}."))
    rows += [rows[0]] * 2
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("held", [conversations.HELD_BYTES, 40])
def test_random_conversations(llm, monkeypatch, held):
    """With a small limit on held text most conversations are read a second time."""
    monkeypatch.setattr(conversations, "HELD_BYTES", held)
    rows = random_rows(3, 120, 14)
    df = frame(llm, rows).repartition(5)
    assert found(df) == brute(rows, harmed=False)
    assert found(conversations.damaged(df), present=conversations.F.col("present")) == brute(rows)


def test_a_conversation_without_rows_and_an_empty_table(llm):
    gone = [(c, 0) for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, t, "user", "Hi.") for c, t in gone]
    got = found(conversations.damaged(frame(llm, rows)), present=conversations.F.col("present"))
    assert got == brute(rows) and len(got) == len(gone)
    one = next(iter(got.values()))
    assert one["audit"] == "" and one["cost"] == 0 and one["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found(frame(llm, [])) == {}


def test_every_short_conversation():
    """All sequences of up to four rows of every kind."""
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("ok.", "cut", "")]
    code = lambda r, t: conversations._code(r) | (conversations._GONE if not t else conversations._CUT if t == "cut" else 0)
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n) if n < 4 else random.Random(4).choices(list(itertools.product(kinds, repeat=4)), k=3000):
            distinct = [(r, f"{k} {t}" if t else "") for k, (r, t) in enumerate(rows)]
            cost, audit = conversations.cheapest_audit(bytes(code(r, t) for r, t in rows))
            assert (cost, audit) == plan(distinct)[:2]


def test_a_long_conversation():
    rng = random.Random(8)
    rows = [(rng.choice(["user", "assistant", "system"]), f"{k}{rng.choice(['.', '.', ''])}") for k in range(3000)]
    cost, audit = conversations.cheapest_audit(bytes(conversations._code(r) | (0 if t[-1] == "." else conversations._CUT) for r, t in rows))
    assert (cost, audit) == plan(rows)[:2]
