"""Language identification with n-gram filters: one Bloom filter a language, sliced by bits.

Position p of the table holds one bit for every language.  An n-gram has HASHES positions; the
bitwise AND of their words is the set of all languages whose filter holds the n-gram, so one probe
asks all languages.  A text's n-grams are counted language by language; what a filter of that
fill returns by chance is taken off; the language with the largest share left decides.

N-grams are bytes of a lower-cased word with a space at both ends, so none spans two words.  "A
language holds an n-gram" means that it uses it at home: its rate there is MIN_RATE or more, and at
least HOME of its rate in the language that uses it most.  Rates do not grow with the corpus, hence
neither do the filters: a language has 1 / MIN_RATE n-grams of one length at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import byte_slices, cut, text_buffer
from riskframe.llm.shingles import mix

#: Lengths of the n-grams in bytes (7 at most: they are kept in 64 bits, above them the language).
LENGTHS = (2, 3, 4, 5)
#: Documents of a language that its filter is learnt from, at most about (a hash sample of them).
MAX_TRAIN_DOCS = 4_000
#: An n-gram is at home in a language from this rate on, and from this part of its highest rate on.
MIN_RATE = 2e-5
HOME = 0.5
#: Positions of the table, and those of an n-gram.
POSITIONS = 1 << 20
HASHES = 4
#: Positions that one group of the building job fills.
BLOCK = 1 << 12
#: Bytes of text that are worked on at once.
SLICE = 1 << 19
NONE = "und"

# ASCII letters; all bytes of characters beyond ASCII count as letters of a word too.
_letter = np.zeros(256, bool)
_letter[0x41:0x5B] = _letter[0x61:0x7B] = _letter[0x80:] = True
_folded = np.where(_letter, np.arange(256), 0x20).astype(np.uint8)


@dataclass
class Filters:
    """``table[p]`` has the languages' bits (in words of 64), ``fill`` each language's share of set bits."""

    languages: list[str]
    table: np.ndarray
    fill: np.ndarray

    def columns(self) -> list[np.ndarray]:
        """The table's words; up to eight languages in bytes, so that it stays in a processor's cache."""
        few = len(self.languages) <= 8
        return [self.table[:, w].astype(np.uint8) if few else self.table[:, w] for w in range(self.table.shape[1])]


def grams(data: np.ndarray, offsets: np.ndarray, lengths=LENGTHS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: (n-grams in 64 bits, as often as they stand there; edges of the texts in them)."""
    n_texts = len(offsets) - 1
    # a space before every text and at the end, none before another space
    wide = np.full(len(data) + n_texts + 1, 0x20, np.uint8)
    inside = np.ones(len(wide), bool)
    inside[offsets + np.arange(n_texts + 1)] = False
    wide[inside] = _folded[data]
    keep = np.ones(len(wide), bool)
    keep[:-1] = (wide[:-1] != 0x20) | (wide[1:] != 0x20)
    edges = np.concatenate(([0], np.cumsum(keep)))[offsets + np.arange(n_texts + 1)]
    b = wide[keep]
    # places where no space stands between the first and the last byte of an n-gram
    solid = b != 0x20
    value = b.astype(np.uint64)
    word, use = value, np.ones(len(b), bool)
    for n in range(2, max(lengths) + 1):
        if len(b) < n:
            return
        word = word[:-1] | (value[n - 1:] << np.uint64(8 * (n - 1)))
        use = use[:-1] & solid[n - 2:-1] if n > 2 else use[:-1]
        if n in lengths:
            before = np.concatenate(([0], np.cumsum(use)))
            yield word[use], before[np.minimum(edges, len(use))]


def positions(gram: np.ndarray, size: int = POSITIONS, hashes: int = HASHES) -> list[np.ndarray]:
    """The places of every n-gram (double hashing)."""
    h = mix(gram)
    step = (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64(size - 1)
    with np.errstate(over="ignore"):
        return [((h + np.uint64(j) * step) & mask).astype(np.int64) for j in range(hashes)]


def lower(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_buffer(pc.utf8_lower(texts.fill_null("")))


def train(docs: DataFrame, usable: Column, max_docs: int = MAX_TRAIN_DOCS) -> Filters:
    """Filters from text and lang of the rows where ``usable`` holds and text, lang and doc_id are not null.

    A hash sample of about ``max_docs`` documents a language is read; the counts are summed, compared
    and hashed on the executors, and the driver gets the table, whose size is fixed.
    """
    known = docs.where(usable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    words = max(1, -(-len(languages) // 64))
    table = np.zeros((POSITIONS, words), np.uint64)
    if not languages:
        return Filters([], table, np.zeros(0))
    code = {v: i for i, v in enumerate(languages)}
    span = 1 << 31
    share = F.element_at(F.create_map(*(F.lit(x) for v in languages for x in (v, int(min(1.0, max_docs / sizes[v]) * span)))), F.col("lang"))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(span)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.array([code[v] for v in batch.column(1).to_pylist()], np.int64)
            data, off = lower(batch.column(0))
            for lo, hi in byte_slices(off, SLICE):
                for g, edges in grams(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]):
                    v = np.repeat(of[lo:hi], np.diff(edges))
                    for i in np.unique(v).tolist():
                        u, n = np.unique(g[v == i], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(u), i), pa.int32()), pa.array(u.view(np.int64)), pa.array(n)], ["language", "gram", "n"])

    # bytes of a gram are never 0, so its length can be read from its value
    length = F.ceil(F.length(F.hex("gram")) / 2)
    counts = cut(chosen.select("text", "lang").mapInArrow(count, "language int, gram bigint, n bigint")
                 .groupBy("language", "gram").agg(F.sum("n").alias("n")).withColumn("length", length))
    # one row for each language and length
    rate = F.col("n") / F.col("total")
    rated = counts.join(F.broadcast(counts.groupBy("language", "length").agg(F.sum("n").alias("total"))), ["language", "length"])
    home = (rated.groupBy("gram").agg(F.collect_list(F.struct(rate.alias("rate"), "language")).alias("at"))
            .select("gram", F.explode("at").alias("l"), F.array_max(F.transform("at", lambda x: x["rate"])).alias("most"))
            .where((F.col("l.rate") >= MIN_RATE) & (F.col("l.rate") >= HOME * F.col("most")))
            .select("gram", F.col("l.language").alias("language")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            language = batch.column(1).to_numpy()
            for p in positions(batch.column(0).to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(p // BLOCK), pa.array(p % BLOCK), pa.array(language)],
                                                 ["block", "p", "language"])

    def fill(key, frame: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros((BLOCK, words), np.uint64)
        language = frame["language"].to_numpy()
        np.bitwise_or.at(part, (frame["p"].to_numpy(), language // 64), np.uint64(1) << (language % 64).astype(np.uint64))
        return pd.DataFrame({"block": [key[0]], "bits": [part.tobytes()]})

    for r in (home.mapInArrow(place, "block bigint, p bigint, language int").distinct()
              .groupBy("block").applyInPandas(fill, "block bigint, bits binary").collect()):
        table[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["bits"], np.uint64).reshape(-1, words)
    bit = [(table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(len(languages))]
    return Filters(languages, table, np.array([b.mean() for b in bit]))


def votes(data: np.ndarray, offsets: np.ndarray, filters: Filters) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams of each text, those that each language's filter returns): texts x languages."""
    size = np.zeros(len(offsets) - 1, np.int64)
    hits = np.zeros((len(size), len(filters.languages)), np.int64)
    for gram, edges in grams(data, offsets):
        size += np.diff(edges)
        places = positions(gram)
        for w, column in enumerate(filters.columns()):
            found = column[places[0]]
            for p in places[1:]:
                found &= column[p]
            for i in range(64 * w, min(64 * w + 64, len(filters.languages))):
                bit = found.dtype.type(1 << (i % 64))
                hits[:, i] += _ones(np.packbits((found & bit) != 0), edges)
    return size, hits


def _ones(bits: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Set bits between consecutive edges of a packed string of bits, by byte counts and masked ends."""
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
    rest = edges % 8
    last = np.append(bits, np.uint8(0))[edges // 8] & (0xFF00 >> rest).astype(np.uint8)
    upto = before[edges // 8] + np.bitwise_count(last)
    return np.diff(upto)


def shares(size: np.ndarray, hits: np.ndarray, filters: Filters, hashes: int = HASHES) -> np.ndarray:
    """Estimated share of a text's n-grams that a language holds: hits less those expected by chance."""
    chance = filters.fill ** hashes
    share = hits / np.maximum(size, 1)[:, None]
    return np.clip((share - chance) / (1 - np.minimum(chance, 0.999999)), 0, 1)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score and n_grams of every row.

    ``score`` is the language's part of the shares of all languages (1: no other one holds any of the
    text's n-grams).  A text that is null or has no letter is ``und`` with score 0; so is every
    text if nothing was learnt.  With letters, but no n-gram that any language holds, the first
    language in alphabetical order gets it with score 0; ties go the same way.
    """
    names = np.array([*filters.languages, NONE], object)
    last = len(names) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            letters = pc.match_substring_regex(texts, r"\pL").fill_null(False).to_numpy(zero_copy_only=False)
            _, raw = text_buffer(texts)
            for lo, hi in byte_slices(raw, SLICE):
                data, off = lower(texts.slice(lo, hi - lo))
                best, score = np.full(hi - lo, last), np.zeros(hi - lo)
                size = np.zeros(hi - lo, np.int64)
                if last:
                    size, hits = votes(data, off, filters)
                    share = shares(size, hits, filters)
                    best = share.argmax(axis=1)
                    total = share.sum(axis=1)
                    score = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1e-300), 0.0)
                    best, score = np.where(letters[lo:hi], best, last), np.where(letters[lo:hi], score, 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(names[best], pa.string()),
                                                  pa.array(score), pa.array(size)], ["doc_id", "lang_pred", "score", "n_grams"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double, n_grams bigint")


def held_out(doc_id: Column) -> Column:
    """Every fifth document by hash; a null id is not held out, but nothing is learnt from it either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op12(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    filters = train(docs, ~held_out(F.col("doc_id")))
    return predict(docs, filters).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_grams")
