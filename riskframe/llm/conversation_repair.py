"""Repair of a conversation's structure as a lightest derivation (Knuth's generalisation of Dijkstra).

A legal conversation has the role initials ``(s?(ua)+)?``, no blank and no repeated message.  The
deductions are those of a weighted hypergraph:

    prefix(i, q)  +  edit(i, e)   ->  prefix(i + 1, q')     the i-th message is kept, reroled or deleted
    prefix(i, q)  +  insert(r)    ->  prefix(i, q')         an empty message of role r stands before it
    prefix(n, q)                  ->  goal                  q is a state in which the pattern may end

A weight is (cost, messages read, audit), the audit being the initials of the edits in order.  The
function of a deduction adds costs and messages and joins audits.  It is superior (no result is below one of
its arguments: where no cost is added, a message is) and monotone: two audits of one item at equal cost
have the same number of letters other than I, hence the same number of I, so neither begins the
other and what follows does not change their order.  So the first weight popped for an item is its least.

Messages of a conversation pass in order through one task, SEGMENT at a time: the items at a segment's end are
the axioms of the next one.  Rows are handed on as soon as all items that are left agree on them, so
what is held does not grow with the conversation.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Messages of one agenda.
SEGMENT = 256
#: Rows and characters of one batch of results.
OUT_ROWS, OUT_CHARS = 2_000, 1 << 22

# What edits cost, and the pattern's states: from which state which role leads where.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ENDS = ("", "a")
ROLES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
#: What any state can do, any other one can do for so much more at most (two inserted messages and a deleted one).
DETOUR = 2 * INSERT + DELETE

SPACE = r"\x20\x09-\x0D"


def lightest(axioms, deduce, goals: set):
    """Chart {item: (weight, back)} of the items popped until all ``goals`` are, or none is left.

    ``axioms`` are (weight, item, back); ``deduce(item, weight, chart)`` gives (weight, item, back) of all
    deductions that ``item`` completes with items of the chart.
    """
    agenda = [(w, n, item, back) for n, (w, item, back) in enumerate(axioms)]
    heapq.heapify(agenda)
    chart, wanted, n = {}, set(goals), len(agenda)
    while agenda and wanted:
        weight, _, item, back = heapq.heappop(agenda)
        if item in chart:
            continue
        chart[item] = (weight, back)
        wanted.discard(item)
        for w, head, tail in deduce(item, weight, chart):
            if head not in chart:
                n += 1
                heapq.heappush(agenda, (w, n, head, tail))
    return chart


def edits(initial: str, fault: str | None) -> list[tuple[int, str, str]]:
    """(cost, letter, role initial in the result) of what may be done with a message ('' if deleted)."""
    if fault in ("blank", "duplicate"):
        return [(DELETE, "D", "")]
    more = TRUNCATED if fault == "truncated" else 0
    out = [(DELETE, "D", "")] + [(REROLE + more, "R", r) for r in "ua" if r != initial]
    return out + ([(KEEP + more, "K", initial)] if initial in ("s", "u", "a") else [])


def derive(messages: list[tuple[str, str | None]], entry: dict[str, tuple[int, str]], last: bool) -> dict:
    """{state: (cost, audit, state at the start, steps)} of the lightest derivations over a segment.

    ``messages`` are (role initial, fault), ``entry`` {state: (cost, audit)} before them.  With ``last``
    only the lightest state in which a conversation may end is returned.  Steps are (letter, role initial).
    """
    n = len(messages)
    axioms = [((c, 0, a), ("prefix", 0, q), None) for q, (c, a) in entry.items()]
    axioms += [((INSERT, 0, "I"), ("insert", r), None) for r in "ua"]
    for i, (initial, fault) in enumerate(messages):
        axioms += [((c, 1, e), ("edit", i, e, r), None) for c, e, r in edits(initial, fault)]
    at = [[] for _ in range(n + 1)]  # what is in the chart, by message
    ready = [[] for _ in range(n + 1)]

    def joined(prefix, edit, chart):
        _, i, q = prefix
        to = q if edit[-1] == "" else NEXT.get((q, edit[-1]))
        if to is None:
            return
        (c, k, a), (d, m, e) = chart[prefix][0], chart[edit][0]
        yield (c + d, k + m, a + e), ("prefix", i + (edit[0] == "edit"), to), (prefix, edit)

    def deduce(item, weight, chart):
        if item[0] == "prefix":
            i = item[1]
            at[i].append(item)
            for edit in ready[i]:
                yield from joined(item, edit, chart)
            for r in "ua":
                if ("insert", r) in chart:
                    yield from joined(item, ("insert", r), chart)
            if last and i == n and item[2] in ENDS:
                yield weight, ("goal",), (item, None)
        elif item[0] == "edit":
            ready[item[1]].append(item)
            for prefix in at[item[1]]:
                yield from joined(prefix, item, chart)
        elif item[0] == "insert":
            for prefixes in at:
                for prefix in prefixes:
                    yield from joined(prefix, item, chart)

    goals = {("goal",)} if last else {("prefix", n, q) for q in ("", "s", "u", "a")}
    chart = lightest(axioms, deduce, goals)
    out = {}
    for goal in goals & chart.keys():
        (cost, _, audit), back = chart[goal]
        item = back[0] if goal == ("goal",) else goal
        end, steps = item[2], []
        while (back := chart[item][1]) is not None:
            item, edit = back
            steps.append((edit[2] if edit[0] == "edit" else "I", edit[-1]))
        out[end] = (cost, audit, item[2], steps[::-1])
    least = min(v[0] for v in out.values())
    return {q: v for q, v in out.items() if v[0] <= least + DETOUR}


class _Repair:
    """One conversation: takes messages in order, gives rows (source message or None, letter, role initial)."""

    def __init__(self):
        self.entry = {"": (0, "")}
        self.paths = {"": []}  # steps of each state that are not handed on yet
        self.held = []  # messages of those steps that are not handed on yet
        self.fresh = []

    def add(self, message) -> list:
        self.fresh.append(message)
        return self._advance(False) if len(self.fresh) >= SEGMENT else []

    def close(self) -> list:
        return self._advance(True)

    def _advance(self, last: bool) -> list:
        found = derive([m[:2] for m in self.fresh], self.entry, last)
        self.held += self.fresh
        self.fresh = []
        self.paths = {q: self.paths[start] + steps for q, (_, _, start, steps) in found.items()}
        few = min(map(len, self.paths.values()))
        one = next(iter(self.paths.values()))
        same = next((i for i in range(few) if any(p[i] != one[i] for p in self.paths.values())), few)
        rows, used = [], 0
        for letter, r in one[:same]:
            if letter == "I":
                rows.append((None, "I", r))
            else:
                rows.append((self.held[used], letter, r))
                used += 1
        self.held = self.held[used:]
        self.paths = {q: p[same:] for q, p in self.paths.items()}
        # the letters that all share no longer count in comparisons
        cost = min(v[0] for v in found.values())
        self.entry = {q: (found[q][0] - cost, "".join(e for e, _ in p)) for q, p in self.paths.items()}
        return rows


def fault_of(text: Column, first: Column) -> Column:
    """blank, duplicate, truncated or null: a message's first fault."""
    ended = text.rlike(rf"[.!?][{SPACE}]*\z")
    return (F.when(~text.rlike(rf"[^{SPACE}]"), "blank").when(~first, "duplicate").when(~ended, "truncated"))


def repair(messages: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, turn, role, text, was_role, fault, edit, cost.

    ``messages`` has conv_id, turn, role, text (more columns are not carried).  One row per message and per
    inserted one, in order of ``place`` (from 0); deleted ones have the edit D and keep role and text.
    Messages of a conversation are taken by turn (nulls first), equal turns by role and text; rows that
    stand several times are messages of their own, all but the first duplicates.  Null role or text is one
    space; an empty role, as any initial but s, u and a, cannot be kept.  Null ids are one conversation.  An empty
    table gives an empty result.  Every conversation comes whole and in order in one partition.
    """
    own = messages.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    # one shuffle: both sorts and the window are inside a conversation's partition, and spill
    dealt = own.repartition("conv_id")
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn")))
    rows = (dealt.withColumn("fault", fault_of(F.col("text"), nth == 1))
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", F.col("fault") == "duplicate"))
    id_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    schema = (f"conv_id {id_type}, place bigint, turn {turn_type}, role string, text string, was_role string, fault string, "
              "edit string, cost bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, chars, kinds = [], 0, None
        now, place, repairing = None, 0, None

        def handed(done):
            nonlocal place, chars
            for message, letter, r in done:
                if message is None:
                    out.append((now, place, None, ROLES[r], "", None, None, "I", INSERT))
                else:
                    _, fault, turn, role, text = message
                    cost = next(c for c, e, to in edits(role[:1], fault) if e == letter and to == r)
                    out.append((now, place, turn, ROLES[r] if letter == "R" else role, text, role, fault, letter, cost))
                    chars += len(text)
                place += 1

        def flushed():
            nonlocal chars
            columns = zip(*out) if out else [()] * 9
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                               ["conv_id", "place", "turn", "role", "text", "was_role", "fault", "edit", "cost"])
            out.clear()
            chars = 0
            return batch

        for batch in batches:
            s = pa.string()
            kinds = [batch.schema.field(0).type, pa.int64(), batch.schema.field(1).type, s, s, s, s, s, pa.int64()]
            for conv, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if repairing is None or conv != now:
                    if repairing is not None:
                        handed(repairing.close())
                    now, place, repairing = conv, 0, _Repair()
                handed(repairing.add((role[:1], fault, turn, role, text)))
                if len(out) >= OUT_ROWS or chars >= OUT_CHARS:
                    yield flushed()
        if repairing is not None:
            handed(repairing.close())
            yield flushed()

    return rows.select("conv_id", "turn", "role", "text", "fault").mapInArrow(run, schema)


def summaries(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result, which must come straight from it (whole and in order).

    gaps, blank, duplicate, truncated and illegal describe the messages before the repair; cost, audit and
    repaired_sha256 the repair.  Texts pass by and are not held.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "n_messages", "n_repaired"]
    schema = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in counts) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, state, id_type = [], None, None

        def close():
            s = state
            gaps = s["top"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
            done.append((s["conv"], gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"], s["n"], s["kept"],
                         "".join(s["audit"]), s["sha"].hexdigest()))

        def batch_of():
            columns = zip(*done) if done else [()] * 11
            types = [id_type, *[pa.int64()] * 8, pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                               ["conv_id", *counts, "audit", "repaired_sha256"])
            done.clear()
            return batch

        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, place, turn, role, text, was, fault, edit, cost in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if state is not None:
                        close()
                    state = {"conv": conv, "low": None, "top": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0,
                             "illegal": 0, "cost": 0, "n": 0, "kept": 0, "audit": [], "sha": hashlib.sha256(), "was": None}
                state["audit"].append(edit)
                state["cost"] += cost
                if edit != "I":
                    if state["was"] is not None and state["was"] + was[:1] not in LEGAL:
                        state["illegal"] += 1
                    state["was"] = was[:1]
                    state["n"] += 1
                    if fault:
                        state[fault] += 1
                    if turn is not None and turn != state["top"]:
                        state["low"] = turn if state["low"] is None else state["low"]
                        state["top"] = turn
                        state["turns"] += 1
                if edit != "D":
                    state["sha"].update((b"\n" if state["kept"] else b"") + f"{role}:{text}".encode())
                    state["kept"] += 1
            if len(done) >= OUT_ROWS:
                yield batch_of()
        if state is not None:
            close()
            yield batch_of()

    return repaired.mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(case == 4, "user").otherwise(word("role"))
    times = F.when(case == 3, 2).otherwise(1)
    return (conversations.where(case != 0)
            .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("again"))
            .drop("again"))


def op11(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = summaries(repair(damage(rows)))
    ids = rows.select(F.col("conv_id").alias("original")).distinct()
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "n_messages", "n_repaired"]
    return (ids.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
            .select(F.col("original").alias("conv_id"),
                    *(F.coalesce(F.col(c), none.get(c, F.lit(0).cast("bigint"))).alias(c) for c in columns)))
