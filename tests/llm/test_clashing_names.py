"""The pipeline's stages with extra columns called like every name that their code uses."""

from __future__ import annotations

import ast
import importlib
import random

import pytest
from pyspark.sql import functions as F

from riskframe.llm import mixing, near_dedup, pieces, suffix_dedup, toxicity

MODULES = ("common", "components", "shingles", "suffix_dedup", "near_dedup", "mixing", "toxicity", "pieces")
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def used_names() -> list[str]:
    names = {"_1", "_2", "_id", "_spans", "_text", "_kept", "_source", "_hash", "_copies"}
    for module in MODULES:
        with open(importlib.import_module(f"riskframe.llm.{module}").__file__) as f:
            for node in ast.walk(ast.parse(f.read())):
                if isinstance(node, ast.Constant) and isinstance(node.value, str):
                    names |= {w for w in node.value.replace(",", " ").replace(".", " ").split() if w.isidentifier() and len(w) < 20}
    return sorted({n.lower(): n for n in names if n.lower() not in OWN}.values())


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(2)
    prose = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))
    passage = prose(90)
    rows = [(i, prose(40) + (" " + passage if i % 5 == 0 else ""), "en", f"s{i % 3}", 0) for i in range(20)]
    rows += [(20, rows[1][1], "en", "s1", 0), (21, None, None, None, None), (22, "", "en", "s0", 0), (1, rows[1][1], "en", "s1", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages_keep_columns_of_any_name(docs):
    names = used_names()
    assert len(names) > 100
    wide = docs.select("*", *(F.lit("clash").alias(n) for n in names))
    stages = {
        "toxicity": lambda d: toxicity.keep_clean(d, toxicity.np.zeros(1 << toxicity.FEATURE_BITS, "f4"), -6.0),
        "minhash": near_dedup.keep_one,
        "suffix": suffix_dedup.remove_repeated,
        "mixing": mixing.apply_mix,
    }
    for name, stage in stages.items():
        got, plain = stage(wide), stage(docs)
        assert got.columns == wide.columns, name
        rows = got.collect()
        assert sorted(str(tuple(r[c] for c in OWN)) for r in rows) == sorted(str(tuple(r)) for r in plain.collect()), name
        assert {r[n] for r in rows for n in names} == {"clash"}, name
    assert pieces.with_ids(wide, pieces.default_model()).count() == docs.count()
