from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from riskframe.llm import pieces

public_tokenizers = pytest.importorskip("public_tokenizers")
spm = pytest.importorskip("sentencepiece")

ODD = ["", " ", "   ", "a", "a  b   c", " lead", "trail ", "tab\tand\nline\n\n", "日本語 テスト", "é̀ zalgo", "▁x ▁", "😀😀 emoji",
       "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "-----------------====", "https://www.example.com/a?b=c&d=1234567890", "\x00\x01 nul", " " * 40 + "x",
       "x" * 300, "the" * 50, " nbsp em", "print('hello world');\n    return x"]


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(pieces.default_model())


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=pieces.default_model())


def noise(n: int, seed: int = 1) -> list[str]:
    r = random.Random(seed)
    chars = "etaoin shrdluETA  éüß日本\n\t.,-_'\"()0123456789" + "abcdefghijklmnopqrstuvwxyz" * 2
    return ["".join(r.choice(chars) for _ in range(r.randint(0, 120))) for _ in range(n)]


def test_ids_equal_the_library(model, library):
    texts = ODD + noise(400)
    o, ids = pieces.WordEncoder(model)(*buffer(texts))
    for t, a, b in zip(texts, o[:-1], o[1:]):
        assert ids[a:b].tolist() == library.encode(t), repr(t)


def test_decoding_gives_the_texts_back(model):
    texts = [t for t in ODD + noise(100, 2) if "▁" not in t]
    o, ids = pieces.WordEncoder(model)(*buffer(texts))
    assert [d.decode() for d in pieces.decode(model, o, ids)] == texts


def test_query_over_documents(spark, docs_of, library):
    rows = list(enumerate(ODD)) + [(None, None), (3, "again"), (3, "again")]
    got = pieces.with_digests(docs_of(rows, extra=True), pieces.default_model()).collect()
    want = sorted((i is None, i or 0, len(e := library.encode(t or "")), zlib.crc32(np.array(e, "<u4").tobytes())) for i, t in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_ids"], r["ids_crc32"]) for r in got) == want
    assert all(r["round_trip"] for r in got)
    assert pieces.with_digests(docs_of([]), pieces.default_model()).count() == 0
