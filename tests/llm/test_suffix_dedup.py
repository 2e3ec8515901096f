from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskframe.llm import suffix_dedup as sd


def brute(texts: list[bytes], n: int = sd.LENGTH):
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = True
        gone = gone[:-1]
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def corpus() -> list[tuple]:
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghé") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other, line = prose(120), prose(90), prose(12) + "\n"
    rows = [prose(r.randint(1, 200)) for _ in range(30)]
    rows += [prose(r.randint(0, 40)) + passage[r.randint(0, 30):] + prose(r.randint(0, 40)) for _ in range(12)]
    rows += [prose(20) + passage[:380] + prose(20), prose(20) + passage[50:451] + prose(9), passage[100:500]]
    rows += [prose(30) + other + prose(40) + other + prose(5)]  # twice in one text
    rows += [line * 30, prose(10) + line * 9, "a" * 1500, "b" + "a" * 401 + "c", "ab" * 300, "x" * 400, "x" * 399]
    rows += ["\x00" * 500, prose(5) + "\x00" * 430 + prose(5), prose(60) + "\x00" * 100 + passage]
    base = prose(300).split(" ")
    for _ in range(8):  # near copies
        w = list(base)
        for _ in range(4):
            w[r.randrange(len(w))] = word()
        rows.append(" ".join(w))
    rows += [rows[0]] * 3 + ["short", "short", "", None, prose(3000), prose(100) * 2]
    return [(i, t) for i, t in enumerate(rows)] + [(None, passage), (5, prose(150)), (5, prose(150))]


@pytest.mark.parametrize("hot", [sd.HOT, 2])
def test_removed_bytes_match_brute_force(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT", hot)
    rows = corpus()
    want = Counter((i, *b) for (i, _), b in zip(rows, brute([(t or "").encode() for _, t in rows])))
    got = sd.removed_bytes(docs_of(rows, extra=True)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == want
    assert sum(r["n_removed"] for r in got) > 10_000


def test_empty_table(spark, docs_of):
    assert sd.removed_bytes(docs_of([])).count() == 0


def test_word_sort_orders_strings_that_begin_others():
    s = [b"ab", b"ab\0", b"", b"abc" * 9, b"abc" * 9 + b"d", b"b", b"ab"]
    rows = np.zeros((len(s), 30), np.uint8)
    for i, x in enumerate(s):
        rows[i, :len(x)] = list(x)
    order, common = sd.word_sort(rows, np.array([len(x) for x in s]), np.zeros(len(s), np.int64))
    assert [s[i] for i in order] == sorted(s)
    assert common.tolist() == [-1, 0, 2, 2, 2, 27, 0]


def test_long_texts_are_cut_with_overlap(monkeypatch):
    r = np.random.default_rng(1)
    data = r.integers(97, 110, 60_000).astype(np.uint8)
    parts = list(sd.pieces(data, np.array([0, 50_000, 60_000]), limit=8_000))
    seen = [(lo, at + i) for lo, part, off, at in parts for t in range(len(off) - 1)
            for i in range(max(0, off[t + 1] - off[t] - sd.LENGTH + 1)) if len(off) == 2]
    assert sorted(p for lo, p in seen if lo == 0) == list(range(50_000 - sd.LENGTH + 1))


def brute_words(texts: list[str], n: int = 51) -> list[str]:
    """Texts without repeated strings of LENGTH bytes or of n whole words (ASCII texts)."""
    windows = [[(m[i].start(), m[i + n - 1].end()) for i in range(len(m) - n + 1)]
               for m in (list(re.finditer(r"[^\x20\x09-\x0d]+", t)) for t in texts)]
    seen = Counter(t[a:b] for t, spans in zip(texts, windows) for a, b in spans)
    long = Counter(t[i:i + sd.LENGTH] for t in texts for i in range(len(t) - sd.LENGTH + 1))
    out = []
    for t, spans in zip(texts, windows):
        gone = bytearray(len(t))
        for a, b in spans + [(i, i + sd.LENGTH) for i in range(len(t) - sd.LENGTH + 1)]:
            if (long if (b - a == sd.LENGTH and (a, b) not in spans) else seen)[t[a:b]] > 1:
                gone[a:b] = b"\1" * (b - a)
        out.append("".join(c for c, g in zip(t, gone) if not g))
    return out


def test_repeats_of_bytes_or_words_are_counted(spark, docs_of):
    r = random.Random(4)
    prose = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 5))) for _ in range(n))
    short, long = prose(53), prose(150)
    assert len(short) < sd.LENGTH < len(long)
    rows = [prose(70), f"{prose(9)} {short} {prose(60)}", f"{prose(30)} {short}", f"{long} {prose(20)}", f"{prose(80)} {long}",
            f"{short} {prose(5)} {long}", prose(60), short[:200], "", None]
    got = {x["doc_id"]: x for x in sd.removed_bytes(docs_of(list(enumerate(rows)))).collect()}
    want = [len(t or "") - len(k) for t, k in zip(rows, brute_words([t or "" for t in rows]))]
    assert [got[i]["n_repeated"] for i in range(len(rows))] == want
    assert [got[i]["has_repeat"] for i in range(len(rows))] == [n > 0 for n in want]
    assert got[1]["n_removed"] == 0 < got[1]["n_repeated"]


def test_long_texts_are_cut_at_words_with_overlap():
    r = np.random.default_rng(2)
    data = r.choice(np.frombuffer(b"abcd ", np.uint8), 40_000)
    seen = []
    for lo, part, off, at in sd.word_pieces(data, np.array([0, 30_000, 40_000]), limit=8_000):
        text, first, last, _, _, start, end = sd.word_anchors(part, off)
        for t, a, b in zip(text, first, last):
            seen += [(lo + t, start[i] - off[t] + at, end[i] - off[t] + at) for i in range(a, b + 1)]
    want = []
    for t, (a, b) in enumerate([(0, 30_000), (30_000, 40_000)]):
        m = list(re.finditer(rb"[^ ]+", data[a:b].tobytes()))
        want += [(t, m[i].start(), m[i + 50].end()) for i in range(len(m) - 50)]
    assert sorted(seen) == want


def test_stage_takes_out_passages_of_51_short_words(spark, docs_of):
    r = random.Random(8)
    word = lambda n: "".join(r.choice("abcdefghij") for _ in range(r.randint(1, n)))
    prose = lambda n: " ".join(word(8) for _ in range(n))
    passages = {n: " ".join(word(4) for _ in range(n)) for n in (40, 50, 51, 52, 60, 300)}
    tiny = " ".join(r.choice("abcdefghij") for _ in range(51))  # 101 bytes
    rows = [prose(r.randint(20, 300)) for _ in range(20)]
    for p in [*passages.values(), tiny]:
        rows += [f"{prose(r.randint(1, 60))} {p}\n{prose(r.randint(1, 60))}" for _ in range(3)]
    rows += [f"{prose(9)} {tiny} {prose(400)} {tiny}", f"{prose(30)} x{passages[51]} {prose(9)}"]  # only 50 whole words
    rows += [f"  {passages[60][4:]} "] * 2 + [f"{prose(5)} {passages[60]} {passages[52]} {prose(5)}", tiny, prose(51)[:399], "", None]
    got = {x["doc_id"]: x["text"] for x in sd.remove_repeated(docs_of(list(enumerate(rows)))).collect()}
    want = brute_words([t or "" for t in rows])
    assert [got[i] or "" for i in range(len(rows))] == want
    assert not any(p in (t or "") for p in (passages[51], passages[52], passages[60], tiny) for t in got.values() if "x" + p not in (t or ""))
    assert sum(passages[50] in (t or "") for t in got.values()) == 3
