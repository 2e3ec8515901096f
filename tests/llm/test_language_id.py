"""Language filters: against sets instead of Bloom filters, held-out accuracy, and edge cases."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import language_id as li
from riskframe.llm.queries import QUERIES

TEXTS = {"en": ["the cat and the dog are in the house", "this is what they think of that", "where there is water there is the sea"],
         "de": ["der Hund und die Katze sind im Haus", "das ist nicht was ich gedacht habe", "über die Straße gehen wir später"],
         "fr": ["le chat et le chien sont à la maison", "c'est ce que nous avons pensé", "où est la bibliothèque près d'ici"]}


def plain_grams(text):
    """n-grams of one text, without numpy."""
    raw = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in text.lower().encode())
    out = []
    for word in raw.split():
        padded = b" " + word + b" "
        for n in li.LENGTHS:
            out += [padded[i:i + n] for i in range(len(padded) - n + 1)]
    return Counter(out)


def test_grams_match_the_plain_ones():
    texts = ["", "a", "The cat, the CAT.", "  x  ", "1 2 3", "Straße über", "né-né", "tail "]
    raw = [t.lower().encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    data = np.frombuffer(b"".join(raw), np.uint8)
    got = [Counter() for _ in texts]
    for g, edges in li.grams(data, off):
        for d, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            got[d].update(int(v).to_bytes(8, "little").rstrip(b"\0") for v in g[a:b])
    assert got == [plain_grams(t) for t in texts]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, lang string, text string")


def corpus():
    rows = [(i, lang, TEXTS[lang][i % 3]) for i in range(30) for lang in TEXTS]
    return [(n, lang, text) for n, (_, lang, text) in enumerate(rows)]


def test_filters_hold_what_sets_hold(spark):
    rows = corpus()
    filters = li.train(frame(spark, rows), F.lit(True))
    assert filters.languages == ["de", "en", "fr"]
    counts = {v: Counter() for v in filters.languages}
    for _, lang, text in rows:
        counts[lang] += plain_grams(text)
    total = {(v, n): sum(c for g, c in counts[v].items() if len(g) == n) for v in counts for n in li.LENGTHS}
    rate = {v: {g: c / total[v, len(g)] for g, c in counts[v].items()} for v in counts}
    most = {g: max(r.get(g, 0) for r in rate.values()) for r in rate.values() for g in r}
    home = {v: {g for g, r in rate[v].items() if r >= li.MIN_RATE and r >= li.HOME * most[g]} for v in rate}
    for text in ["the dog is here", "die Katze", "le chat et", "zzz qqq"]:
        raw = text.lower().encode()
        size, hits = li.votes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), filters)
        own = plain_grams(text)
        assert size[0] == sum(own.values())
        want = [sum(c for g, c in own.items() if g in home[v]) for v in filters.languages]
        assert (hits[0] >= want).all() and (hits[0] - want).max() <= 1


def test_prediction_edges(spark):
    filters = li.train(frame(spark, corpus()), F.lit(True))
    rows = [(1, None, None), (2, None, ""), (3, None, "12 !?"), (4, None, "the house and the dog"), (5, None, "die Katze und der Hund"),
            (None, None, "le chien à la maison"), (7, None, "the house " * 100_000), (7, None, "the house"), (8, None, "жжж")]
    df = frame(spark, rows).withColumn("score", F.lit("clash")).withColumn("language", F.lit("clash")).withColumn("gram", F.lit("clash"))
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in li.predict(df, filters).collect()]
    assert [g[:2] for g in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (None, "fr"), (7, "en"), (7, "en"), (8, "de")]
    assert all(0 <= s <= 1 for _, _, s in got) and [s for _, _, s in got[:3]] == [0, 0, 0] and got[8][2] == 0
    assert li.predict(frame(spark, []), filters).count() == 0
    nothing = li.train(frame(spark, [(1, None, "x"), (None, "en", "x"), (2, "en", None)]), F.lit(True))
    assert nothing.languages == [] and {r["lang_pred"] for r in li.predict(df, nothing).collect()} == {"und"}


def test_more_languages_than_a_word_has_bits(spark):
    rows = [(i, f"l{i % 70:02d}", f"{chr(97 + i % 70 % 26)}{chr(97 + i % 70 // 26)}qz" * 3) for i in range(140)]
    filters = li.train(frame(spark, rows), F.lit(True))
    assert filters.table.shape[1] == 2
    got = li.predict(frame(spark, rows), filters).collect()
    assert all(r["lang_pred"] == rows[r["doc_id"]][1] for r in got)


@pytest.mark.parametrize("sf,least", [("sf0.001", 0.95), ("sf0.01", 0.99)])
def test_held_out_accuracy(spark, sf, least):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = QUERIES["op12_language_id"](spark, f"/root/testdata/{sf}")
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == docs.count()
    share = got.where("held_out").join(docs.where("n > 40"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0]
    assert share >= least
