from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark: SparkSession):
    """documents rows from (doc_id, text[, lang, source]), with columns whose names clash with those of results."""

    def make(rows: list[tuple], extra: bool = True) -> DataFrame:
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        docs = spark.createDataFrame(full, DOC_SCHEMA)
        if extra:
            for name in ("kept", "score", "h", "norm", "component_id", "key", "size", "bucket", "label", "ids", "block", "rejected"):
                docs = docs.selectExpr("*", f"'clash' as {name}")
        return docs

    return make
