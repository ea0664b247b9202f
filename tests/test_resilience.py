"""Lost tasks and aborted jobs must not change or tear published tables."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap

import pytest

from ledgerflow.sources import tables

from .conftest import ROOT, SF_SMALL

# Runs in its own process: the master "local[4,4]" lets a failed task be
# retried (plain local mode never retries). A test-only pass-through fails the
# first attempt of one task in each job; the outputs must equal a clean run.
_SCRIPT = textwrap.dedent(
    """
    import json, os, sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from ledgerflow.operators import balances, quality
    from ledgerflow.sources import fixtures as fx, tables

    spark = (SparkSession.builder.master("local[4,4]")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    marks = tempfile.mkdtemp(prefix="ledgerflow-marks-")

    def flaky(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            open(os.path.join(marks, f"failed-stage{{ctx.stageId()}}"), "w").close()
            raise RuntimeError("injected task loss")
        yield from batches

    tx = fx.wallet_events(spark, {sf!r}).repartition(4)
    lossy = tx.mapInPandas(flaky, tx.schema)
    root = tempfile.mkdtemp(prefix="ledgerflow-resilience-")
    counts = tables.write_routed(lossy, os.path.join(root, "routed"))
    valid = spark.read.parquet(os.path.join(root, "routed", "route=valid"))
    store = tables.SnapshotTable(os.path.join(root, "silver"))
    silver = balances.silver_balances(valid.drop("reasons").mapInPandas(flaky, valid.drop("reasons").schema), fx.FIXTURE_CUTOFF)
    store.write(silver, 0)
    got = sorted(map(tuple, store.read(spark).collect()), key=str)
    want = sorted(map(tuple, balances.silver_balances(quality.valid_events(tx), fx.FIXTURE_CUTOFF).collect()), key=str)
    print(json.dumps({{"counts": counts, "valid_rows": valid.count(), "raw_rows": tx.count(),
                      "quarantine_rows": spark.read.parquet(os.path.join(root, "routed", "route=quarantine")).count(),
                      "silver_equal": got == want, "injected": len(os.listdir(marks))}}))
    spark.stop()
    """
)


def test_task_retry_gives_exactly_once_output(tmp_root):
    script = _SCRIPT.format(root=ROOT, sf=SF_SMALL)
    proc = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=600, cwd=tmp_root
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    out = json.loads(proc.stdout.strip().splitlines()[-1])
    assert out["valid_rows"] + out["quarantine_rows"] == out["raw_rows"] == 1000
    assert out["counts"]["valid"] == out["valid_rows"]
    assert out["silver_equal"]
    assert out["injected"] >= 2  # the routed write and the snapshot write each lost a task


def test_aborted_snapshot_write_leaves_previous_version(spark, tmp_root):
    from pyspark.sql import functions as F

    store = tables.SnapshotTable(os.path.join(tmp_root, "snap"))
    store.write(spark.range(10), 0)
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        store.write(bad, 1)
    assert store.latest(spark) == 0
    assert store.read(spark).count() == 10
