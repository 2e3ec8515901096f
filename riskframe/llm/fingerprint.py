"""Document fingerprints: mergeable bottom-k sketches of 5-word shingle hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import byte_slices, cell_of, id_splits, partitions, text_buffer
from riskframe.llm.shingles import bottom_k, resemblance, shingle_sets

#: Values that a sketch keeps, and the bits of each.
SKETCH_K = 128
VALUE_BITS = 48


def sketches(texts: list[bytes], k: int = SKETCH_K) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of the texts' sketches: the k smallest shingle hashes, cut to 48 bits."""
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    o, v = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets)
    return bottom_k(o, v >> np.uint64(64 - VALUE_BITS), k)


def encode(offsets: np.ndarray, values: np.ndarray) -> list[str]:
    """A string per sketch: base64 of its values as 6-byte big-endian numbers."""
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return [base64.b64encode(raw[6 * a:6 * b]).decode() for a, b in zip(offsets[:-1], offsets[1:])]


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merge(a: str, b: str, k: int = SKETCH_K) -> str:
    """The sketch of two texts' shingles together."""
    v = np.union1d(decode(a), decode(b))[:k]
    return encode(np.array([0, len(v)]), v)[0]


def distinct_shingles(fingerprint: str, k: int = SKETCH_K) -> float:
    """Estimated number of distinct shingles: exact below k, else (k - 1) / k-th smallest value."""
    v = decode(fingerprint)
    return float(len(v)) if len(v) < k else (k - 1) / ((float(v[-1]) + 1) / 2.0 ** VALUE_BITS)


def likeness(a: str, b: str, k: int = SKETCH_K) -> float:
    """Estimated resemblance (Jaccard) of two texts; two texts without words are alike."""
    x, y = decode(a), decode(b)
    return float(resemblance(np.array([0, len(x)]), x, np.array([0, len(y)]), y, k)[0])


def containment(a: str, b: str, k: int = SKETCH_K) -> float:
    """Estimated part of a's shingles that b has: |A & B| from the resemblance and both counts."""
    r, na, nb = likeness(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return min(1.0, r / (1 + r) * (na + nb) / na) if na else 1.0


def fingerprints(docs: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """doc_id, fingerprint of every row (null text: as empty, fingerprint '')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            out: list[str] = []
            for lo, hi in byte_slices(off):
                o, v = shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                out += encode(*bottom_k(o, v >> np.uint64(64 - VALUE_BITS), k))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fingerprint string")


def edited_texts(docs: DataFrame, k: int = SKETCH_K, slice_bytes: int = 1 << 20) -> DataFrame:
    """Fingerprint every document, its edited text and the document that follows it.

    Order: doc_id descending, null ids last, repeated ids by text; after the last comes the first.
    The edited text has its last floor(n/2) code points replaced by as many (or all) first ones of
    the next document.  Texts are moved once, into ranges of ids; the first document of a range is
    also sent to the range before it, so neighbours meet without a global sort.
    """
    spark = docs.sparkSession
    splits = id_splits(docs, "doc_id", 4 * partitions(spark))
    cell = cell_of(F.col("doc_id"), splits)
    heads = {r["cell"]: r["top"] for r in
             docs.select("doc_id", cell.alias("cell")).groupBy("cell").agg(F.max("doc_id").alias("top")).collect()}
    filled = sorted(heads)
    above = {c: filled[(i + 1) % len(filled)] for i, c in enumerate(filled)}
    tops = {heads[c]: above[c] for c in filled}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, cells: pd.Series) -> pd.Series:
        return pd.Series([[2 * c] + ([2 * tops[k] + 1] if (k := None if c == -1 else i) in tops else [])
                          for i, c in zip(ids.tolist(), cells.tolist())])

    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), cell.alias("cell"))
    placed = placed.select("doc_id", "text", F.explode(places(F.coalesce("doc_id", F.lit(0)), "cell")).alias("place"))
    placed = placed.withColumn("cell", F.expr("place >> 1"))
    placed = (placed.repartition(partitions(spark), "cell")
              .sortWithinPartitions("cell", "place", F.desc_nulls_last("doc_id"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []  # (doc_id, text): each has its successor behind it
        held = 0
        at, wants = None, False

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal held
            if len(pending) < 2:
                return None
            texts = [t for _, t in pending]
            own = texts[:-1]
            edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(own, texts[1:])]
            raw = [t.encode() for t in texts]
            raw_edited = [t.encode() for t in edited]
            o, v = sketches(raw, k)
            eo, ev = sketches(raw_edited, k)
            fp = encode(o, v)
            n = len(own)
            out = pa.RecordBatch.from_arrays([
                pa.array([d for d, _ in pending[:-1]], pa.int64()),
                pa.array([len(t) for t in own], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in raw_edited]),
                pa.array(fp[:-1]), pa.array(encode(eo, ev)),
                pa.array(resemblance(o[:n + 1], v[:o[n]], eo, ev, k)),
                pa.array(resemblance(o[:n + 1], v[:o[n]], o[1:] - o[1], v[o[1]:], k)),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            del pending[:-1]
            held = len(pending[0][1])
            if last:
                pending.clear()
            return out

        for batch in batches:
            for doc_id, text, place in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if place >> 1 != at:
                    pending.clear()
                    at, wants, held = place >> 1, True, 0
                if place & 1:  # the first document of the next range
                    if wants:
                        pending.append((doc_id, text))
                        if (out := flush(True)) is not None:
                            yield out
                        wants = False
                    continue
                pending.append((doc_id, text))
                held += len(text)
                if held > slice_bytes and (out := flush(False)) is not None:
                    yield out

    return placed.select("doc_id", "text", "place").mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")


def op7(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return edited_texts(docs)
