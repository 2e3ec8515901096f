from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from riskframe.llm import token_files as tf
from riskframe.llm.common import shared_path

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

ODD = ["", " ", "   ", "a  b   c", " lead", "trail ", "tab\tand\nline\n\n", "x \n y", "x\n y", "日本語 テスト", "é à ü ß", "nbsp  next",
       "thin  space", "“quotes” – dash … end", "<|endoftext|> special <|endoftext|>", "we're don't I'll", "a\x85 b", "\x1c x\x1c y",
       "😀 😀😀 e", "12 345 6789", "... --- !!!", "x\x00 y", "a　 b", "line\r\n next"]


def noise(n: int) -> list[str]:
    r = random.Random(4)
    return ["".join(r.choice("etaoin   \n\t.,'é– 日ab12") for _ in range(r.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


def ids_of(path, texts):
    tok = tokenizers.Tokenizer.from_file(path)
    return [e.ids + [tf.END_ID] for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_library(path):
    texts = ODD + noise(500)
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    o, ids = tf.PieceEncoder(path)(np.frombuffer(b"".join(raw), np.uint8), off)
    for t, a, b, want in zip(texts, o[:-1], o[1:], ids_of(path, texts)):
        assert ids[a:b].tolist() == want, repr(t)


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], list(range(0, 70000, 7))])
def test_pack_round_trip(values):
    r = np.array(values, np.uint32)
    assert tf.unpack(*tf.pack(r), len(r)).tolist() == values


def test_files_give_back_all_documents_in_order(spark, docs_of, path):
    texts = ODD + noise(60)
    rows = list(enumerate(texts)) + [(None, "no id"), (500, None), (3, "again"), (3, "again"), (-7, "first")]
    random.Random(1).shuffle(rows)
    where = shared_path(spark, "test-token-files")
    tf.write_token_files(docs_of(rows, extra=True), path, where)
    got = tf.read_token_files(spark, where).collect()
    want = dict(zip([t or "" for _, t in rows], ids_of(path, [t or "" for _, t in rows])))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"]) for r in got) == sorted(
        (i is None, i or 0, want[t or ""]) for i, t in rows)
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [0, *np.cumsum([r["n_tokens"] for r in ordered])[:-1].tolist()]
    ids = [r["doc_id"] for r in ordered]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    crc = {(r["start"], r["ids"]) for r in tf.read_token_files(spark, where, tf.crc32_of).collect()}
    assert crc == {(r["start"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got}


def test_empty_table(spark, docs_of, path):
    where = shared_path(spark, "test-token-files")
    tf.write_token_files(docs_of([]), path, where)
    assert tf.read_token_files(spark, where).count() == 0
