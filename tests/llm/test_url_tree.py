"""The template tree against a plain version of its definition, and hidden rules foretold by templates."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from itertools import groupby

from pyspark.sql import functions as F

from riskframe.llm import url_filter as U


def shape_of(path):
    path = re.sub("/+", "/", re.sub("[0-9]+", "#", path.lower()))
    segs = [s for s in path.split("/") if s]
    out = []
    for s, run in groupby(segs):
        out.append(s + "+" if len(list(run)) > 1 else s)
    return tuple(out)


def rate(b, l, p):
    return (b + p * U.PRIOR_N) / (l + U.PRIOR_N)


def sums(rows):
    n = sum(r["n"] for r in rows)
    return sum(r["b"] for r in rows), sum(r["l"] for r in rows), sum(r["n"] * r["prior"] for r in rows) / n, n


def rejects(rows):
    b, l, p, _ = sums(rows)
    return b > l * U.REJECT or rate(b, l, p) >= U.REJECT


def descend(rows, level, name):
    """Sets ``template`` of all shapes below one node."""
    if len(rows) == 1:
        rows[0]["template"] = name + "".join("/" + s for s in rows[0]["shape"][level:])
        return
    kids = defaultdict(list)
    for r in rows:
        if len(r["shape"]) <= level:
            r["template"] = name
        else:
            kids[r["shape"][level]].append(r)
    total, size = sum(r["n"] for r in rows), {k: sums(v)[3] for k, v in kids.items()}
    named = sum(size.values())
    if kids:
        entropy = -sum(n / named * math.log(n / named) for n in size.values())
        if entropy > U.VARIED * math.log(named) + 1e-9:
            for k in sorted(kids):
                if k != "*" and size[k] < total * U.RARE and not rejects(kids[k]):
                    kids["*"].extend(kids.pop(k))

    def following(rs):
        out = defaultdict(int)
        for r in rs:
            out[r["shape"][level + 1] if len(r["shape"]) > level + 1 else ""] += r["n"]
        return out

    everyone = [r for v in kids.values() for r in v]
    if everyone:
        pool, (pb, pl, _, pn) = following(everyone), sums(everyone)
        pooled = pb / pl if pl else U.PRIOR
        alike = defaultdict(list)
        for k, v in kids.items():
            b, l, p, n = sums(v)
            shared = sum(min(c / n, pool[x] / pn) for x, c in following(v).items())
            if shared >= 1 - U.SHAPE_GAP - 1e-9 and abs(rate(b, l, p) - pooled) <= U.RATE_GAP + 1e-9:
                alike["*!" if rejects(v) else "*"].append(k)
        for to, ks in alike.items():
            if len(ks) > 1:
                joined = [r for k in ks for r in kids.pop(k)]
                kids[to] = kids.get(to, []) + joined
    for k, v in kids.items():
        descend(v, level + 1, name + "/" + k)


def brute(pages):
    """(host, path, label) -> (template, rate) of each."""
    counts = defaultdict(lambda: [0, 0, 0])
    for h, p, v in pages:
        c = counts[h, shape_of(p)]
        c[0] += 1
        c[1] += v is not None
        c[2] += v == "block"
    domains = defaultdict(lambda: [0, 0])
    for (h, s), (_, l, b) in counts.items():
        labels = h.split(".")
        for i in range(1, len(labels) if l else 0):
            d = domains[".".join(labels[i:]), s]
            d[0] += 1
            d[1] += b / l
    hosts = defaultdict(list)
    for (h, s), (n, l, b) in counts.items():
        labels, prior = h.split("."), U.PRIOR
        for i in range(len(labels) - 1, 0, -1):
            dl, db = domains[".".join(labels[i:]), s]
            prior = rate(db, dl, prior)
        hosts[h].append({"host": h, "shape": s, "n": n, "l": l, "b": b, "prior": prior})
    found = {}
    for rows in hosts.values():
        descend(rows, 0, "")
        groups = defaultdict(list)
        for r in rows:
            groups[r["template"]].append(r)
        for t, rs in groups.items():
            for r in rs:
                found[r["host"], r["shape"]] = (t, rate(*sums(rs)[:3]))
    return [found[h, shape_of(p)] for h, p, _ in pages]


def test_tree_equals_plain_version(spark):
    r = random.Random(12)
    hosts = ["a.x.net", "b.x.net", "c.y.net", "x.net", "q.org", "", "deep.er.q.org"]
    words = ["en", "de", "es", "news", "ads", "tag", "v1", "v22", "p"]
    pages = []
    for i in range(2500):
        h = r.choice(hosts)
        path = "/" + "/".join(r.choice(words[:r.randint(2, 9)]) if r.random() < .8 else f"w{r.choice('abcdefgh')}{r.choice('xyz')}"
                              for _ in range(r.choice([0, 1, 2, 2, 3, 4, 7])))
        label = None if r.random() < .6 else ("block" if ("/ads" in path) != (r.random() < .1) else "allow")
        pages.append((i, h, path + r.choice(["", "/", "/9", "//1"]), label))
    pages += [(9000 + i, "trap.org", "/a" * i + "/b/c" * (i % 3), None) for i in range(1, 30)]
    pages += [(9500 + i, "mostly.org", f"/k{chr(97 + i % 8)}/{i}", "block" if i % 9 else "allow") for i in range(160)]
    df = spark.createDataFrame(pages, "page_id int, host string, path string, label string")
    got = {g["page_id"]: (g["template"], g["block_rate"]) for g in U.judge(df, "label").collect()}
    want = brute([p[1:] for p in pages])
    assert len(got) == len(pages)
    for p, (template, block_rate) in zip(pages, want):
        assert got[p[0]][0] == template and abs(got[p[0]][1] - block_rate) < 1e-9, p
    assert any(t.count("/") > 4 for t, _ in want) and any("*!" in t for t, _ in want) and any("/*" in t for t, _ in want)


def test_deep_paths_differ_below_the_fourth_segment(spark):
    rules = [("d.org", "/a/b/c/d/e/bad/", "block"), ("d.org", "/a/b/c/d/e/good/", "allow")]
    urls = [f"http://d.org/a/b/c/d/e/{k}/{i}" for k in ("bad", "good") for i in range(20)]
    urls += ["http://d.org/A/b/c/d/e/bad/7", "http://d.org/a/b/c/d/e/good", "http://d.org/" + "x/" * 200_000, "http://" + "h." * 3000 + "org/" + "".join(f"{chr(97 + i % 26)}/" for i in range(60_000))]
    got = {g["page_id"]: g for g in U.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), rules).collect()}
    assert (got[40]["verdict"], got[40]["rule"], got[40]["template"]) == ("block", None, "/a/b/c/d/e/bad/#")
    assert got[41]["verdict"] == got[42]["verdict"] == got[43]["verdict"] == "allow"
    assert got[42]["template"] == "/x+" and len(got) == len(urls)


def test_hidden_rules_are_foretold(spark):
    r = random.Random(5)
    urls = [f"https://{h}.{d}.net/{s}/{r.randint(1, 99999)}{e}" for d in ("one", "two") for h in "abcdefghijkl" for s in ("en", "de", "es", "fr")
            for e in ("", ".html", "?page=1") for _ in range(r.randint(1, 6))]
    rules = [(d, f"/{s}/", v) for d in ("net",) for s, v in (("es", "block"), ("fr", "block"), ("en", "allow"))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    for by in ("path", "host"):
        rows = U.holdout(pages, rules, by).collect()
        assert len(rows) > 50 and all(x["ruled"] == x["method"] for x in rows)
    assert U.filter_urls(pages, rules).where(F.col("rule").isNull() & (F.col("verdict") == "block")).count() == 0
