"""Conversation repair against an exhaustive search over prefixes, and its edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from riskframe.llm import conversation_repair as cr
from riskframe.llm.queries import QUERIES

CHAR = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        case = zlib.crc32(name.encode()) % 20
        if case:
            text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
            out += [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return out


def brute(rows):
    """Edits of one conversation's rows (turn, role, text): all prefixes' (cost, audit, initials), pruned by nothing but equality."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        chars = CHAR.findall(text)
        faults.append("blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else None)
        seen.add((role, text))
    pattern = re.compile(r"(s?(ua)+)?\Z")
    possible = re.compile(r"(s?((ua)*u?)?)\Z")
    front = {("", ""): (0, "", ())}  # (audit, initials) -> the whole past

    def inserted(states):
        done, new = dict(states), states
        while new:
            new = {(a + "I", w + r): (c + 3, a + "I", kept + ((("user" if r == "u" else "assistant"), ""),))
                   for (a, w), (c, _, kept) in new.items() for r in "ua"
                   if possible.match(w + r) and (a[-2:] != "II")}
            done |= new
        return done

    front = inserted(front)
    for (turn, role, text), fault in zip(rows, faults):
        more = 3 if fault == "truncated" else 0
        new = {}
        for (a, w), (c, _, kept) in front.items():
            moves = [("D", w, 4, kept)]
            if fault not in ("blank", "duplicate"):
                if role[:1] and possible.match(w + role[:1]):
                    moves.append(("K", w + role[:1], more, kept + ((role, text),)))
                moves += [("R", w + r, 3 + more, kept + ((name, text),)) for r, name in (("u", "user"), ("a", "assistant"))
                          if possible.match(w + r)]
            for e, to, cost, lines in moves:
                key = (a + e, to)
                if key not in new or new[key][0] > c + cost:
                    new[key] = (c + cost, a + e, lines)
        least = min(v[0] for v in new.values())
        front = inserted({k: v for k, v in new.items() if v[0] <= least + 12})
    cost, audit, lines = min((v for (a, w), v in front.items() if pattern.match(w)), key=lambda v: v[:2])
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def make(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def expected(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    return {conv: brute(own) for conv, own in groups.items()}


def checked(spark, rows):
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in cr.summaries(cr.repair(make(spark, rows))).collect()}
    assert got == expected([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for i in range(rng.randint(1, most)):
            turn = rng.choice([i, i, i, i + 3, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "agent"])
            rows.append((rng.choice([conv, conv, conv, None]) if conv < 1 else conv, turn, role,
                         rng.choice(["Yes.", "No!", "so", " ", "", None, "a b. \n", "tschüß", f"Line {i}?"])))
    return rows


@pytest.mark.parametrize("segment", [1, 3, 256])
def test_repair_matches_exhaustive_search(spark, monkeypatch, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows = random_rows(segment, 60, 7)
    rng = random.Random(5)
    rng.shuffle(rows)
    found = {}
    for conv, own in _groups(rows).items():
        found[conv] = _local(own)
    assert found == expected([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])


def _groups(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


def _local(own):
    """cr._Repair over one conversation, summed up as ``summaries`` does."""
    own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, machine, done = set(), cr._Repair(), []
    faults = []
    for turn, role, text in own:
        chars = CHAR.findall(text)
        fault = "blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        done += machine.add((role[:1], fault, turn, role, text))
    done += machine.close()
    cost, lines = 0, []
    for m, letter, r in done:
        cost += 3 if m is None else next(c for c, e, to in cr.edits(m[0], m[1]) if e == letter and to == r)
        if letter != "D":
            lines.append((cr.ROLES[r], "") if m is None else (cr.ROLES[r] if letter == "R" else m[3], m[4]))
    turns = {t for t, _, _ in own if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
    return ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, "".join(e for _, e, _ in done),
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


def test_whole_path_with_nulls_ties_and_repeats(spark):
    checked(spark, random_rows(11, 25, 6))


def test_one_long_conversation_is_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT", 16)
    machine, most, handed = cr._Repair(), 0, 0
    for i in range(5_000):
        handed += len(machine.add(("ua"[i % 2], None, i, "user", f"Text {i}.")))
        most = max(most, len(machine.held) + len(machine.fresh))
    assert handed + len(machine.close()) == 5_000 and most < 40


def test_long_texts_extra_columns_and_empty_table(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "Good."), (2, 0, "assistant", "x" * 300_000)]
    df = make(spark, rows)
    for c in ("place", "fault", "edit", "cost", "was_role", "again", "original"):
        df = df.withColumn(c, F.lit("clash"))
    got = {r["conv_id"]: (r["audit"], r["cost"]) for r in cr.summaries(cr.repair(df)).collect()}
    assert got == {1: ("KK", 0), 2: ("D", 4)}
    assert cr.repair(make(spark, [])).count() == 0
    assert cr.summaries(cr.repair(make(spark, []))).count() == 0


def test_query_equals_brute_force_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_conversation_repair"](spark, sf).collect()}
    want = expected(damaged(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}
