"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import byte_slices, text_buffer
from riskframe.llm.shingles import span_hashes

#: Labelled documents that the classifier is fitted on, at most about (a hash sample of all of them).
MAX_TRAIN_DOCS = 4_000
FEATURE_BITS = 18
#: A word's features: the whole word (0) and its first so many bytes, for words that are inflected.
STEMS = (0, 4, 5)
#: A feature of fewer training documents, or with a share of toxic ones that differs from the share of
#: all by less than so many standard deviations, has no weight.
MIN_DOCS = 4
MIN_Z = 4.0
ROUNDS = 200
RATE = 0.15
DECAY = 2e-5
#: score >= THRESHOLD: predicted toxic.
THRESHOLD = 0.7

# Bytes that end a word (ASCII white space and punctuation) and those that end a sentence.
_stop = np.zeros(256, bool)
_stop[list(b" \t\n\v\f\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_end = np.zeros(256, bool)
_end[list(b".!?\n")] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """Words and sentences of many texts.

    Returns (features of the words, their sentences, text of each sentence, start, end of each
    sentence).  Sentences without words are left out; a text without words has none.
    """
    n, z = len(data), np.zeros(0, np.int64)
    if n == 0:
        return z, z, z, z, z
    solid = ~_stop[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], solid[:-1]))
    start = np.flatnonzero(solid & (~before | first[:n]))
    after = np.concatenate((solid[1:], [False]))
    end = np.flatnonzero(solid & (~after | first[1:])) + 1
    if len(start) == 0:
        return z, z, z, z, z
    opens = first[:n].copy()
    opens[1:] |= _end[data[:-1]]
    number = np.cumsum(opens)
    _, at, sentence = np.unique(number[start], return_index=True, return_inverse=True)
    last = np.concatenate((at[1:], [len(start)])) - 1
    feature = np.stack([span_hashes(data, start, np.minimum(end, start + n) if n else end) ^ np.uint64(n) for n in STEMS], axis=1)
    feature = (feature >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    return (feature.ravel(), np.repeat(sentence, len(STEMS)), np.searchsorted(offsets, start[at], side="right") - 1, start[at],
            end[last])


def fit(features: list[np.ndarray], owners: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the sentence score, by gradient descent (Adam) on the noisy-or likelihood.

    ``features[d]`` are the word features of document d, ``owners[d]`` their sentence numbers.
    """
    size = 1 << FEATURE_BITS
    w, b = np.zeros(size), -6.0
    y = labels.astype(bool)
    if not y.any() or y.all():
        return w, (-6.0 if not y.any() else 6.0)
    per = [int(o.max()) + 1 if len(o) else 0 for o in owners]
    base = np.concatenate(([0], np.cumsum(per)))
    doc_of = np.repeat(np.arange(len(per)), per)
    df, hits = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for f, toxic in zip(features, y):  # one document at a time: most features are dropped below
        own = np.unique(f)
        df[own] += 1
        hits[own] += toxic
    n_sent, n_doc, m1 = int(base[-1]), len(per), y.sum()
    share = m1 / n_doc
    use = (df >= MIN_DOCS) & (np.abs(hits - df * share) >= MIN_Z * np.sqrt(df * share * (1 - share)))
    kept = [use[f] for f in features]
    word = np.concatenate([f[k] for f, k in zip(features, kept)]).astype(np.int32)
    sent = np.concatenate([o[k] + base[i] for i, (o, k) in enumerate(zip(owners, kept))]).astype(np.int32)
    if not len(word):
        return w, float(np.log(share / (1 - share)))
    odds = np.log((hits + 0.5) / (m1 + 1)) - np.log((df - hits + 0.5) / (len(y) - m1 + 1))
    w[use] = np.clip(odds[use], -4, 4) * (np.abs(odds[use]) > 1)
    order = np.argsort(word, kind="stable")
    word, sent = word[order], sent[order]
    cols, at = np.unique(word, return_index=True)
    prior = w[cols]
    v, m, s = prior.copy(), np.zeros(len(cols) + 1), np.zeros(len(cols) + 1)
    col = np.repeat(np.arange(len(cols)), np.diff(np.concatenate((at, [len(word)]))))
    for step in range(1, ROUNDS + 1):
        z = np.bincount(sent, weights=v[col], minlength=n_sent) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(doc_of, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n_doc)
        pos = -np.expm1(none)
        g = np.where(y[doc_of], -np.exp(none[doc_of]) / np.maximum(pos[doc_of], 1e-9), 1.0) * p
        grad = np.append(np.bincount(col, weights=g[sent], minlength=len(cols)), g.sum()) / n_doc
        grad[:-1] += DECAY * (v - prior)
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
        v, b = v - move[:-1], b - move[-1]
    w[:] = 0
    w[cols] = v
    return w, float(b)


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> tuple[np.ndarray, float]:
    """Fit on labelled rows outside the held-out third (a hash sample of about ``max_docs`` documents).

    A document with several label rows is toxic if one says so; null labels and null ids teach
    nothing.  Without labels of both kinds every text gets one score (near 0, or near 1 if all
    labels are 1).
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, max_docs / max(1, known.count()))
    cut = int(share * (1 << 31))
    chosen = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1 << 31)) < cut)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for lo, hi in byte_slices(off):
                f, s, d, _, _ = sentences(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                cutw = np.searchsorted(d[s] if len(s) else s, np.arange(hi - lo + 1))
                first = np.searchsorted(d, np.arange(hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array([f[a:b].astype(np.int32).tobytes() for a, b in zip(cutw[:-1], cutw[1:])], pa.binary()),
                     pa.array([(s[a:b] - k).astype(np.int32).tobytes() for a, b, k in zip(cutw[:-1], cutw[1:], first)],
                              pa.binary())], ["doc_id", "toxic", "f", "s"])

    # The chosen labels are bounded by max_docs, so sending them to every task is safe at any size.
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("toxic").cast("int"))
            .mapInArrow(featurise, "doc_id bigint, toxic int, f binary, s binary"))

    def learn(key, frame):
        order = np.argsort(frame["doc_id"].to_numpy(), kind="stable")
        f, s, y = frame["f"].to_numpy()[order], frame["s"].to_numpy()[order], frame["toxic"].to_numpy()[order]
        w, b = fit([np.frombuffer(x, np.int32) for x in f], [np.frombuffer(x, np.int32) for x in s], y)
        import pandas as pd

        return pd.DataFrame({"w": [w.astype("<f4").tobytes()], "b": [b]})

    got = rows.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "w binary, b double").collect()
    if not got:
        return np.zeros(1 << FEATURE_BITS, np.float32), -6.0
    return np.frombuffer(got[0]["w"], "<f4"), got[0]["b"]


def document_scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float):
    """(score of each text; text, start, end and score of each sentence)."""
    f, s, d, a, e = sentences(data, offsets)
    z = np.bincount(s, weights=weights[f], minlength=len(d)) + bias if len(d) else np.zeros(0)
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    none = np.bincount(d, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(offsets) - 1)
    return -np.expm1(none), d, a, e, p


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """doc_id, score, n_sentences, and the worst sentence (byte span and its own score) of every row.

    A text without words has the score 0 and no worst sentence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for lo, hi in byte_slices(off):
                m = hi - lo
                total, d, a, e, p = document_scores(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], weights, bias)
                worst = np.full(m, -1)
                order = np.lexsort((-np.arange(len(d)), p, d))
                worst[d[order]] = order
                has = worst >= 0
                pick = np.maximum(worst, 0)
                take = lambda x: pa.array(x[pick] if len(x) else np.zeros(m, x.dtype), mask=~has)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, m), pa.array(total), pa.array(np.bincount(d, minlength=m)),
                     take(a - (off[lo:hi + 1] - off[lo])[d]), take(e - (off[lo:hi + 1] - off[lo])[d]), take(p)],
                    ["doc_id", "score", "n_sentences", "worst_start", "worst_end", "worst_score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, score double, n_sentences bigint, worst_start bigint, worst_end bigint, worst_score double")


def keep_clean(docs: DataFrame, weights: np.ndarray, bias: float, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores below ``threshold``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(at))
            for lo, hi in byte_slices(off):
                total = document_scores(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], weights, bias)[0]
                yield batch.slice(lo, hi - lo).filter(pa.array(total < threshold))

    return docs.mapInArrow(run, docs.schema)


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score(docs, *train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                         "n_sentences", "worst_start", "worst_end", "worst_score")
