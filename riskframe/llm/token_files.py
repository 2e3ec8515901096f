"""Token-id files: frequency-ranked ids, byte-aligned lengths with separate control bytes.

File format (Parquet container, one row per block of whole documents): ``cell`` and ``block`` give
the order; ``doc_ids`` and ``counts`` name the documents and their numbers of ids; ``control`` has
two bits per id (its number of data bytes less one, four ids per byte, the first in the low bits);
``data`` has the id's frequency rank in so many little-endian bytes.  ``ranks`` (a second table next
to it) maps rank to id.  The most frequent 256 ids take one byte each.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import (byte_slices, cell_of, delete_path, id_splits, partitions, running_totals, shared_path,
                                  text_buffer)
from riskframe.llm.span_cache import SpanCache

#: Appended to every document.
END_ID = 2
#: Distinct pieces whose ids a worker keeps.
CACHE_PIECES = 3_000_000
#: Ids of a block, about (a longer document is a block of its own).
BLOCK_IDS = 1 << 18


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of parts that byte-level BPE encodes independently (each text starts one).

    A space behind visible ASCII, or behind a letter of two bytes, always starts a new pre-token.
    """
    n = len(data)
    cut = data == 0x20
    b1 = np.concatenate(([0], data[:-1]))[:n]
    b2 = np.concatenate(([0, 0], data[:-2]))[:n]
    safe = (b1 > 0x20) & (b1 < 0x7F) | (b1 >= 0x80) & (b2 > 0xC2) & (b2 < 0xE0)
    cut &= safe
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """Byte-level BPE ids of many texts; each distinct piece goes to the library once per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added) or r"(?!)").search
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.wide = size > 1 << 16
        self.cache = SpanCache(self.learn, CACHE_PIECES)

    def encode(self, texts: list[str]) -> list[list[int]]:
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in run(texts, add_special_tokens=False)]

    def learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of one leading space and visible characters are encoded side by side: ids that begin with
        a space tell them apart.  All others go to the library one by one."""
        plain = np.array([p.isprintable() and p.rfind(" ") == 0 and not self.special(p) for p in new])
        sizes = np.zeros(len(new), np.int64)
        rows, parts = np.flatnonzero(plain), [np.zeros(0, np.int64)]
        for lo in range(0, len(rows), 512):
            some = rows[lo:lo + 512]
            ids = np.array(self.encode(["".join([new[i] for i in some])])[0])
            at = np.flatnonzero(self.opens[ids])
            if len(at) != len(some):
                raise ValueError("pieces can't be told apart in their ids")
            sizes[some] = np.diff(np.append(at, len(ids)))
            parts.append(ids)
        rest = np.flatnonzero(~plain)
        others = self.encode([new[i] for i in rest])
        sizes[rest] = [len(x) for x in others]
        ids = np.concatenate(parts + [np.array(x, np.int64) for x in others])
        order = np.concatenate((rows, rest))
        begin = np.cumsum(sizes) - sizes
        out = np.empty(len(ids), np.int64)
        size = sizes[order]
        out[np.arange(len(ids)) + np.repeat(begin[order] - (np.cumsum(size) - size), size)] = ids
        return sizes, out

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): all ids of each text and the end id."""
        start = piece_starts(data, offsets)
        ends, ids = self.cache(data, start, np.append(start[1:], len(data)))
        cut = ends[np.searchsorted(start, offsets)]  # where each text's ids begin
        m = len(offsets) - 1
        out = np.full(len(ids) + m, END_ID, np.int32)
        own = np.ones(len(out), bool)
        own[cut[1:] + np.arange(m)] = False
        out[own] = ids
        return cut + np.arange(m + 1), out


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of frequency ranks."""
    r = ranks.astype("<u4")
    size = 1 + (r > 0xFF) + (r > 0xFFFF) + (r > 0xFFFFFF)
    code = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    code[:len(r)] = size - 1
    q = code.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    return control.tobytes(), r.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes()


#: The four lengths that each control byte stands for.
_lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again, by table lookup of the control bytes."""
    size = _lengths[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size) - size
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)))
    out = raw[at].astype(np.uint32)
    for j in (1, 2, 3):
        more = np.flatnonzero(size > j)
        out[more] |= raw[at[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


def encode_docs(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and the document's ids with the end id, as little-endian binary.

    Ids take two bytes where the vocabulary allows it, else four; ``wide`` tells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for lo, hi in byte_slices(off, 4 << 20):
                o, ids = enc(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                width = 4 if enc.wide else 2
                raw = ids.astype(f"<u{width}").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, enc.wide)),
                     pa.array([raw[width * a:width * b] for a, b in zip(o[:-1], o[1:])], pa.binary())], ["doc_id", "wide", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, wide boolean, ids binary")


def rank_table(encoded: DataFrame) -> DataFrame:
    """rank, id, n: every id by falling count, ties by id.  One row per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for lo, hi in byte_slices(off, 4 << 20):
                wide = bool(batch.column(0)[lo].as_py())
                got = np.bincount(data[off[lo]:off[hi]].copy().view("<u4" if wide else "<u2"))
                if len(got) > len(total):
                    total = np.concatenate((total, np.zeros(len(got) - len(total), np.int64)))
                total[:len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    counts = encoded.select("wide", "ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).alias("rank"), "id", "n")


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Write ``path/blocks`` and ``path/ranks`` of all documents in ascending doc_id order.

    Null texts are empty (only the end id); null ids stand first; repeated ids by their ids' bytes.
    Texts are encoded once, into a table of the shared folder; counts and the ordered blocks come
    from that table.
    """
    spark = docs.sparkSession
    splits = id_splits(docs, "doc_id", 4 * partitions(spark))
    scratch = shared_path(spark, "ids")
    encode_docs(docs, tokenizer_path).write.parquet(scratch, compression="zstd")
    encoded = spark.read.parquet(scratch)
    rank_table(encoded).write.parquet(f"{path}/ranks")
    ids = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.int64)
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number = None, 0
        names: list = []
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal names, held, number
            control, data = pack(rank_of[np.concatenate(held)])
            row = {"cell": at, "block": number, "doc_ids": names, "counts": [len(x) for x in held],
                   "n_ids": sum(len(x) for x in held), "control": control, "data": data}
            names, held, number = [], [], number + 1
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("cell", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                            ("counts", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("control", pa.binary()),
                            ("data", pa.binary())])
        size = 0
        for batch in batches:
            for cell, doc_id, wide, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if cell != at or size > BLOCK_IDS:
                    if held:
                        yield flush()
                    size = 0
                    if cell != at:
                        at, number = cell, 0
                names.append(doc_id)
                held.append(np.frombuffer(raw, "<u4" if wide else "<u2"))
                size += len(held[-1])
        if held:
            yield flush()

    (encoded.withColumn("cell", cell_of(F.col("doc_id"), splits)).select("cell", "doc_id", "wide", "ids")
     .repartition(partitions(spark), "cell").sortWithinPartitions("cell", F.asc_nulls_first("doc_id"), "ids")
     .mapInArrow(blocks, "cell int, block int, doc_ids array<bigint>, counts array<bigint>, n_ids bigint, "
                         "control binary, data binary")
     .write.parquet(f"{path}/blocks", compression="none"))
    delete_path(spark, scratch)


def read_token_files(spark, path: str, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and the ids or a digest of them."""
    ids = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    stored = spark.read.parquet(f"{path}/blocks")
    base = running_totals(stored.select("cell", "block", "n_ids"), "cell", [F.col("block")], {"n_ids": "base"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = ids[unpack(row["control"], row["data"], row["n_ids"])]
                end = np.cumsum(row["counts"])
                parts = np.split(values, end[:-1])
                m = len(parts)
                made = (pa.array([digest(p) for p in parts], pa.int64()) if digest else
                        pa.array([p.tolist() for p in parts], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["cell"]] * m, pa.int32()), pa.array([row["block"]] * m, pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(end - row["counts"], pa.int64()),
                     pa.array(row["counts"], pa.int64()), made], ["cell", "block", "doc_id", "inner", "n_tokens", "ids"])

    kind = "bigint" if digest else "array<bigint>"
    docs = (stored.select("cell", "block", "doc_ids", "counts", "n_ids", "control", "data")
            .mapInArrow(run, f"cell int, block int, doc_id bigint, inner bigint, n_tokens bigint, ids {kind}"))
    return (docs.join(base.drop("n_ids"), ["cell", "block"])
            .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids"))


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def op4(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = shared_path(spark, "token-files")
    write_token_files(docs, tokenizer_path, path)
    return read_token_files(spark, path, crc32_of).withColumnRenamed("ids", "ids_crc32")
