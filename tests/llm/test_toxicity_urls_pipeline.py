from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import toxicity, url_filter

from .test_near_dedup import brute as near_brute
from .test_suffix_dedup import brute as suffix_brute


def labelled(n=1500, seed=6):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(800)]
    bad = ["vile", "rotten", "stupid"]
    docs, labels, where = [], [], {}
    for i in range(n):
        sents = [[r.choice(vocab) for _ in range(r.randint(3, 12))] for _ in range(r.randint(1, 25))]
        toxic = r.random() < 0.12
        if toxic:
            k = r.randrange(len(sents))
            sents[k].insert(1, r.choice(bad))
            where[i] = " ".join(sents[k])
        docs.append((i, ". ".join(" ".join(s) for s in sents) + ".", "s"))
        if r.random() < 0.8:
            labels.append((i, int(toxic)))
    return docs, labels, where


def test_toxic_documents_and_sentences_are_found(spark, docs_of):
    docs, labels, where = labelled()
    df = docs_of(docs + [(None, "vile"), (9001, None), (9002, ""), (9003, "..."), (3, docs[3][1])], extra=True)
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (4, None)], "doc_id bigint, toxic int").withColumn("text", F.lit("x"))
    w, b = toxicity.train(df, lab)
    got = toxicity.score(df, w, b).collect()
    assert len(got) == len(docs) + 5
    held = [r for r in got if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["doc_id"] < 9000]
    tell = [((r["score"] >= toxicity.THRESHOLD) == (r["doc_id"] in where)) for r in held]
    assert np.mean(tell) > 0.97
    text = dict((i, t) for i, t, _ in docs)
    found = [text[r["doc_id"]].encode()[r["worst_start"]:r["worst_end"]].decode() == where[r["doc_id"]] for r in held if r["doc_id"] in where]
    assert np.mean(found) > 0.9
    empty = {r["doc_id"]: r for r in got}
    assert all(empty[i]["score"] == 0 and empty[i]["worst_start"] is None for i in (9001, 9002, 9003))
    clean = toxicity.keep_clean(df, w, b)
    assert clean.columns == df.columns and clean.where("doc_id = 9001").count() == 1
    assert clean.count() == sum(r["score"] < toxicity.THRESHOLD for r in got)


def test_few_labels_teach_every_frequent_word(spark, docs_of):
    """Words that a document does not need for its label keep the weight that they have alone."""
    docs, labels, where = labelled(500, seed=8)
    w, b = toxicity.train(docs_of(docs), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = toxicity.score(docs_of(docs), w, b).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    caught = [r["score"] >= toxicity.THRESHOLD for r in held if r["doc_id"] in where]
    assert len(caught) > 10 and np.mean(caught) >= 0.9
    assert np.mean([r["score"] >= toxicity.THRESHOLD for r in held if r["doc_id"] not in where]) < 0.03


def test_score_is_the_noisy_or_of_the_sentences(spark, docs_of):
    """Recomputed word by word and sentence by sentence, a text of a megabyte included."""
    r = random.Random(9)
    weights = np.random.default_rng(9).normal(0, 1.5, 1 << toxicity.FEATURE_BITS).astype("f4")
    texts = ["One two. three! Four", "", "...", "same SAME same", "a\nb\nc", " ".join(r.choice(["ab", "cde", "fghijk."]) for _ in range(250_000))]

    def feature(word):
        data = np.frombuffer(word.encode(), np.uint8)
        f = toxicity.sentences(data, np.array([0, len(data)]))[0]
        assert len(f) == len(toxicity.STEMS)
        return sum(float(weights[i]) for i in f)

    known = {}
    for text, got in zip(texts, sorted(toxicity.score(docs_of(list(enumerate(texts))), weights, -3.0).collect(), key=lambda x: x["doc_id"])):
        none = 1.0
        n = 0
        for sentence in re.split(r"[.!?\n]", text):
            words = [x for x in re.split(r"[\s!-/:-@\[-`{-~]+", sentence) if x]
            if words:
                n += 1
                z = -3.0 + sum(known.setdefault(x, feature(x)) if x not in known else known[x] for x in words)
                none *= 1 - 1 / (1 + np.exp(-z))
        assert got["n_sentences"] == n
        assert got["score"] == pytest.approx(1 - none, abs=1e-9)


def test_labels_of_one_kind_and_none(spark, docs_of):
    df = docs_of([(1, "a b"), (2, "c")])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {round(r["score"], 1) for r in toxicity.score(df, *toxicity.train(df, none)).collect()} == {0.0}
    assert toxicity.score(docs_of([]), *toxicity.train(df, none)).count() == 0


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), h + p) for h, p, _ in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


URLS = [None, "", "no scheme", "http://", "://x.com/a", "HTTP://WWW.Example.COM/en/1", "https://example.com/en/", "https://m.example.com/en/9?x=/es/",
        "https://example.com", "https://a.net/es/1#t", "https://net/fr/", "https://b.net/de/2", "https://xcom/y", "http://a://b.net/es/x",
        "https://ÄÖ.com/é", "https://a.net?/es/", "https://q.org/" + "s/" * 400, "https://q.org//a//", "http://h.org/new\nline/x"]


def test_rules_and_verdicts(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[5]), (3, URLS[9]), (3, URLS[9])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'clash' as host", "'clash' as shape", "1 as n")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == len(rows)
    verdicts = {h + p: v for h, p, v in url_filter.RULES}
    want = sorted((i is None, i or 0, *(x or "" for x in plain_rule(u))) for i, u in rows)
    assert sorted((r["page_id"] is None, r["page_id"] or 0, r["host"], r["path"], r["rule"] or "") for r in got) == want
    assert all(r["verdict"] == verdicts[r["rule"]] for r in got if r["rule"])
    assert {r["verdict"] for r in got} <= {"allow", "block"}
    assert url_filter.filter_urls(pages.where("page_id < 0")).count() == 0


def test_templates_generalise_and_reject(spark):
    rules = [("bad.org", "/ads/", "block"), ("bad.org", "/news/", "allow")]
    urls = [f"https://bad.org/ads/{i}" for i in range(40)] + [f"https://bad.org/news/{i}" for i in range(40)]
    urls += ["https://bad.org/ADS/7", "https://bad.org/NEWS/7", "https://other.org/ads/1"]
    urls += [f"https://wiki.org/{w}" for w in (f"title-{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, rules).collect()}
    assert [got[80]["verdict"], got[81]["verdict"], got[82]["verdict"]] == ["block", "allow", "allow"]
    assert got[80]["rule"] is None and got[80]["template"] == "/ads/#"
    assert {got[i]["template"] for i in range(83, 143)} == {"/*"}


def test_blocked_sections_do_not_take_unlabelled_ones_along(spark):
    sections = ["es", "fr"] + [f"part-{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(28)]
    urls = [f"https://h{n}.net/{s}/{i}" for n in (1, 2, 3, 20, 200) for s in sections for i in range(n)]
    urls += [f"https://few.net/{s}/{i}" for s in sections[:20] for i in range(20)]
    urls += [f"https://uneven.net/{s}/{chr(97 + i % 7)}/{i}" for s in sections for i in range(40 if s < "part-am" else 3)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for r in url_filter.filter_urls(pages).collect():
        assert r["verdict"] == ("block" if r["path"][:4] in ("/es/", "/fr/") else "allow"), (r["host"], r["path"], r["template"])


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs, labels, _ = labelled(400, 9)
    r = random.Random(3)
    passage = " ".join("".join(r.choice("klmnop") for _ in range(6)) for _ in range(90))
    rows = [(i, t + (" " + passage if i % 40 == 0 else ""), "en", f"s{i % 3}", len(t)) for i, t, _ in docs]
    rows += [(1000 + i, rows[i][1].replace("a", "a", 1), "en", "s1", 0) for i in range(20)] + [(2000, None, None, None, None), (None, "", "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline_stages_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        docs = docs.cache()
        rows = docs.collect()
        counts.append(len(rows))
        if name == "minhash_near_dedup":
            kept = near_brute([(r["doc_id"], r["text"]) for r in before])
            assert sorted((i is None, i or 0) for i, _, c in kept if i == c) == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
        if name == "suffix_dedup":
            want = {}
            for r, b in zip(before, suffix_brute([(r["text"] or "").encode() for r in before])):
                want[r["doc_id"]] = b[3]
            # the fixture is ASCII, so whole characters are whole bytes
            assert {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in rows} == want
            assert any(r["n_chars"] != b["n_chars"] for r, b in zip(sorted(rows, key=str), sorted(before, key=str)))
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=corpus_pipeline.pieces.default_model())
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(str((r["doc_id"], list(r["ids"]))) for r in out) == sorted(str((r["doc_id"], library.encode(r["text"] or ""))) for r in rows)
