"""Silver in hash buckets and folded events in sorted runs: cost follows the batch, results stay."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import LedgerConfig
from ledgerflow.operators import balances, quality
from ledgerflow.plans import pipeline as pl
from ledgerflow.schema import EVENT
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import runs, tables

CUT = fx.FIXTURE_CUTOFF


def events(spark, rows):
    return spark.createDataFrame([(i, "u", a, "DEPOSIT", dt.datetime.fromisoformat(t), Decimal(x)) for i, a, t, x in rows], EVENT)


def totals(spark, spec):
    return {r.account_id: r.total_amount for r in spec.layers.snapshots("silver").read(spark).collect()}


def bucket_files(store, spark, version):
    """File names of every bucket of a version, by bucket."""
    return {b: sorted(f for f in os.listdir(store.bucket_path(v, b)) if f.startswith("part-")) for b, v in store.composition(spark, version).items()}


def written(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_a_fold_writes_only_its_buckets(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=CUT), state_buckets=32)
    store = spec.layers.snapshots("silver")
    many = spark.range(4000).select(
        F.col("id").alias("event_id"), F.lit("u").alias("user_id"), F.concat(F.lit("a"), F.col("id").cast("string")).alias("account_id"),
        F.lit("DEPOSIT").alias("transaction_type"), F.lit("2024-01-05").cast("timestamp").alias("event_time"), F.lit(1).cast("decimal(18,2)").alias("amount"),
    )
    pl.fold_batch(spark, many, 0, spec)
    first = bucket_files(store, spark, 0)
    assert len(first) == 32
    pl.fold_batch(spark, events(spark, [(9001, "a7", "2024-01-06", "5"), (9002, "new", "2024-01-06", "2")]), 1, spec)
    second = bucket_files(store, spark, 1)
    touched = {b for b in second if second[b] != first.get(b)}
    assert 1 <= len(touched) <= 2
    assert written(store.path(1)) < 0.15 * written(store.path(0))
    got = totals(spark, spec)
    assert len(got) == 4001 and got["a7"] == Decimal("6.00") and got["new"] == Decimal("2.00") and got["a8"] == Decimal("1.00")


def test_bucketed_replay_and_retention(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=CUT), state_buckets=8)
    store = spec.layers.snapshots("silver")
    pl.fold_batch(spark, events(spark, [(i, f"a{i}", "2024-01-05", "1") for i in range(40)]), 0, spec)
    for n in range(1, 7):
        batch = events(spark, [(100 + n, f"a{n}", "2024-01-06", "10")])
        for _ in range(2):  # the second is a replay
            pl.fold_batch(spark, batch, n, spec)
        assert store.latest(spark) == n
        want = {f"a{i}": Decimal("11.00") if 1 <= i <= n else Decimal("1.00") for i in range(40)}
        assert totals(spark, spec) == want
    assert store.versions(spark) == [4, 5, 6]  # older ones are not offered, though their untouched buckets are still used
    kept = {v for v in store.composition(spark, 6).values()}
    assert kept - {4, 5, 6}
    before = {f"a{i}": Decimal("11.00") if 1 <= i <= 4 else Decimal("1.00") for i in range(40)}
    assert {r.account_id: r.total_amount for r in store.read(spark, 4).collect()} == before
    pl.run_bronze  # a recompute makes a whole version; nothing below the offered ones is needed after two more
    for v in (7, 8, 9):
        store.write(store.read(spark, 6), v, "account_id", 8, kind="recompute", last_batch=6)
        store.drop_below(spark, v)
    assert sorted(os.listdir(os.path.join(spec.paths.silver))) and store._numbers(spark) == [7, 8, 9]


def test_fold_over_a_table_without_buckets_rewrites_it(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=CUT))
    store = spec.layers.snapshots("silver")
    plain = balances.silver_balances(events(spark, [(1, "a", "2024-01-05", "100"), (2, "b", "2024-01-05", "7")]), CUT)
    store.write(plain, 0, kind="recompute", grain="account", last_batch=-1)
    pl.fold_batch(spark, events(spark, [(3, "a", "2024-01-06", "1")]), 0, spec)
    assert totals(spark, spec) == {"a": Decimal("101.00"), "b": Decimal("7.00")}
    assert not store.is_partial(spark, 1)


def test_an_empty_batch_changes_nothing(spark, tmp_root):
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=CUT))
    pl.fold_batch(spark, events(spark, [(1, "a", "2024-01-05", "100")]), 0, spec)
    pl.fold_batch(spark, events(spark, []), 1, spec)
    assert totals(spark, spec) == {"a": Decimal("100.00")}
    empty = pl.PipelineSpec(root=os.path.join(tmp_root, "e"), cfg=LedgerConfig(cutoff=CUT))
    pl.fold_batch(spark, events(spark, []), 0, empty)
    pl.fold_batch(spark, events(spark, [(1, "a", "2024-01-05", "100")]), 1, empty)
    assert totals(spark, empty) == {"a": Decimal("100.00")}


def scanned(df):
    """Rows that the file scans of a frame gave out, from the metrics of its executed plan."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        metrics = node.metrics()
        if "FileSourceScan" in node.getClass().getSimpleName():
            total += metrics.apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_batch_reads_a_share_of_the_folded_events(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(runs, "ROW_GROUP", 1 << 16)
    store = runs.EventRuns(os.path.join(tmp_root, "seen"), "event_id", ("event_time", "amount"))
    many = spark.range(200_000).select(
        F.col("id").alias("event_id"), F.lit("a").alias("account_id"), F.lit("2024-01-05").cast("timestamp").alias("event_time"), F.col("id").cast("decimal(18,2)").alias("amount")
    )
    store.write(many.orderBy(F.xxhash64("event_id")), 0)
    batch = many.filter("event_id between 90000 and 90500 or event_id = 17")
    found = store.candidates(spark, batch, 1)
    assert scanned(found) < 0.3 * 200_000
    assert sorted(r.event_id for r in store.lookup(spark, batch, 1).collect()) == [17, *range(90_000, 90_501)]
    assert "PushedFilters: [" in found._jdf.queryExecution().executedPlan().toString()
    assert store.lookup(spark, batch, 0) is None


def test_runs_are_merged_by_size_and_keep_the_latest(spark, tmp_root):
    store = runs.EventRuns(os.path.join(tmp_root, "seen"), "event_id", ("event_time", "amount"))
    last = {}
    for n in range(20):
        rows = [(i, "a", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n), Decimal(n)) for i in range(n, n + 5)]
        last.update({r[0]: r[3] for r in rows})
        store.write(spark.createDataFrame(rows, "event_id long, account_id string, event_time timestamp, amount decimal(18,2)"), n)
        store.compact(spark, below=n)
    found = store.runs(spark)
    assert found[0] == (0, 7) and found[1] == (8, 15) and len(found) == 6
    assert sorted(os.listdir(store.root)) == sorted(f"run={a}-{b}" for a, b in found)
    ids = spark.range(40).select(F.col("id").alias("event_id"))
    assert {r.event_id: r.amount for r in store.lookup(spark, ids, 20).collect()} == last
    # a merge that ended before its parts went: the wider run counts
    store._write(spark.read.parquet(store.path((16, 16))).unionByName(spark.read.parquet(store.path((17, 17)))), (16, 17))
    assert (16, 17) in store.runs(spark) and (16, 16) not in store.runs(spark)
    assert store.runs(spark, below=17)[-1] == (16, 16)  # a replay of batch 17 does not see itself


@pytest.mark.parametrize("as_text", [False, True])
def test_corrections_over_many_batches(spark, tmp_root, monkeypatch, as_text):
    """Every batch corrects events of all batches before; the runs are merged meanwhile."""
    monkeypatch.setattr(runs, "FANOUT", 3)
    spec = pl.PipelineSpec(root=tmp_root, cfg=LedgerConfig(cutoff=CUT), state_buckets=4)
    every = []
    for n in range(6):
        rows = [(i, f"a{i % 5}", f"2024-01-05T00:{n:02d}:00", str(n + i)) for i in range(0, 4 * n + 4, 1 + n % 2)]
        every += rows
        batch = events(spark, rows)
        pl.fold_batch(spark, batch.withColumn("event_id", F.concat(F.lit("id-"), F.col("event_id").cast("string"))) if as_text else batch, n, spec)
    whole = quality.dedup_latest(events(spark, every), "event_id", ("event_time", "amount"))
    want = {r.account_id: r.total_amount for r in balances.silver_balances(whole, CUT).collect()}
    assert totals(spark, spec) == want
    assert any(hi > lo for lo, hi in pl._runs(spec).runs(spark))
