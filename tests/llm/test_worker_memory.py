"""A Python worker, which Spark keeps for the next tasks, does not keep the memory of those it has done."""

from __future__ import annotations

import gc
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import language_id, minhash


def held_mb() -> int:
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read()).group(1)) // 1024


@pytest.fixture()
def captured(spark, monkeypatch):
    """The functions given to mapInArrow, to be called here."""
    got, kind = [], type(spark.range(0))
    put = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, run, *a, **k: got.append(run) or put(self, run, *a, **k))
    return got


def test_a_task_leaves_no_memory_behind(make_docs, captured):
    minhash.signatures(make_docs([(1, "a b")]), 5)
    rng = np.random.default_rng(3)
    ids = pa.array(range(1000), pa.int64())

    def batches(n):
        for _ in range(n):
            yield pa.RecordBatch.from_arrays([ids, pa.array([" ".join(map(str, rng.integers(0, 10**9, 250))).encode() for _ in ids], pa.binary())], names=["doc_id", "text"])

    sum(1 for _ in captured[0](batches(1)))  # what is loaded once
    gc.collect()
    before = held_mb()
    rows = sum(b.num_rows for b in captured[0](batches(12)))
    gc.collect()
    assert rows == 12_000
    assert held_mb() - before < 40


def test_orders_are_planned_one_by_one(spark, make_docs):
    """What is looked up, and the tables, are read from files: no plan spans the orders of the model."""
    docs = make_docs([(i, f"the cat sat {i} on the mat and the cat ate", "en") for i in range(8)] + [(9, "der hund und die katze", "de")])
    models = language_id.train(docs.select("lang", "text"))
    plan = language_id.probabilities(models, spark.createDataFrame([("  th",), (" cat",)], "gram string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 3
    counts = language_id.gram_counts(docs.select("lang", "text"))
    assert "Window" not in language_id.kneser_ney(counts)._jdf.queryExecution().optimizedPlan().toString()
