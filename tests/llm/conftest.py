from __future__ import annotations

import pytest

from riskframe.llm.common import prepare
from riskframe.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark(master="local[4]", shuffle_partitions=4)
    prepare(session)
    yield session


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra=False):
        """documents of (doc_id, text[, source]); with ``extra`` also columns whose names clash with inner ones."""
        rows = [tuple(r) + (None,) * (3 - len(r)) for r in rows]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
        if extra:
            from pyspark.sql import functions as F

            for c in ("size", "cell", "node", "value", "key", "t1", "spans", "rank", "h1", "cluster", "bucket"):
                df = df.withColumn(c, F.lit("clash"))
        return df

    return make
