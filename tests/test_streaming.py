"""Streaming twins: stream = batch, replay and restart are no-ops."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import LedgerConfig
from ledgerflow.operators import balances, quality
from ledgerflow.plans.pipeline import PipelineSpec
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import tables
from ledgerflow.streaming import incremental as st

from .conftest import SF_SMALL


@pytest.fixture()
def landed(spark, tmp_root):
    """The fixture events written as one Parquet file per calendar week."""
    src = os.path.join(tmp_root, "incoming")
    tx = fx.wallet_events(spark, SF_SMALL)
    weeks = [(1, 8), (8, 15), (15, 22), (22, 32)]
    for a, b in weeks:
        part = tx.filter((F.dayofmonth("event_time") >= a) & (F.dayofmonth("event_time") < b))
        part.coalesce(1).write.mode("append").parquet(src)
    return src, tx


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_fold_stream_equals_batch_and_restart_is_noop(spark, tmp_root, landed):
    src, tx = landed
    spec = PipelineSpec(root=os.path.join(tmp_root, "tables"), cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    q = st.silver_fold_stream(spark, src, spec, fx.FIXTURE_CUTOFF, max_files_per_trigger=1)
    q.awaitTermination(300)
    store = tables.SnapshotTable(spec.paths.silver)
    assert store.latest(spark) == 3  # one version per file
    want = balances.silver_balances(quality.valid_events(tx), fx.FIXTURE_CUTOFF)
    assert _rows(store.read(spark)) == _rows(want)
    # restart on the same checkpoint: nothing new, no new version
    q2 = st.silver_fold_stream(spark, src, spec, fx.FIXTURE_CUTOFF, max_files_per_trigger=1)
    q2.awaitTermination(300)
    assert store.latest(spark) == 3
    # what the stream rejected is kept
    assert spark.read.parquet(spec.paths.fold_quarantine).count() + quality.valid_events(tx).count() == tx.count()


def test_update_mode_aggregate_equals_batch(spark, tmp_root, landed):
    src, tx = landed
    totals = st.account_totals(st.event_stream(spark, src), fx.FIXTURE_CUTOFF).writeStream.outputMode("update").format("memory")
    totals = totals.queryName("lf_totals").option("checkpointLocation", os.path.join(tmp_root, "ck_totals"))
    totals.trigger(availableNow=True).start().awaitTermination(300)
    got = spark.sql("select * from lf_totals")
    want = balances.silver_balances(quality.valid_events(tx), fx.FIXTURE_CUTOFF)
    assert _rows(got) == _rows(want)


def test_daily_flow_stream_emits_closed_days(spark, tmp_root, landed):
    src, tx = landed
    out = os.path.join(tmp_root, "flow")
    late = tx.filter(F.dayofmonth("event_time") == 2)  # delivered again after all else: too late
    late.coalesce(1).write.mode("append").parquet(src)
    q = st.daily_flow_stream(spark, src, out, os.path.join(tmp_root, "ck_flow"), max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    batch = balances.daily_net(quality.valid_events(tx))
    emitted_days = {r.d for r in got.select("d").distinct().collect()}
    assert max(emitted_days) < dt.date(2024, 1, 30)  # the last days stay open under the watermark
    closed = batch.filter(F.col("d").isin(list(emitted_days)))
    assert _rows(got) == _rows(closed)
    side = st.late_flow(spark.read.parquet(src), got)
    assert _rows(side) == _rows(balances.daily_net(quality.valid_events(late)).filter("net <> 0"))


def test_dedup_stream_drops_redelivery(spark, tmp_root):
    v = quality.valid_events(fx.wallet_events(spark, SF_SMALL))
    dup = v.unionByName(v.filter(F.dayofmonth("event_time") == 30))  # same events twice
    src = os.path.join(tmp_root, "dup")
    dup.write.parquet(src)
    out = os.path.join(tmp_root, "dedup_out")
    q = st.dedup_stream(spark, src, out, os.path.join(tmp_root, "ck_dedup"))
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == v.count()
    assert got.select("event_id").distinct().count() == v.count()


def test_bronze_stream_keeps_every_row(spark, tmp_root, landed):
    """Raw types (text time, double amount); rejected rows keep their raw values."""
    _, tx = landed
    src = os.path.join(tmp_root, "raw_types")
    raw = tx.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")).withColumn("amount", F.col("amount").cast("double"))
    broken = raw.limit(1).withColumn("event_time", F.lit("not-a-time"))
    raw.unionByName(broken).write.parquet(src)
    out = os.path.join(tmp_root, "bronze_out")
    st.bronze_stream(spark, src, out, os.path.join(tmp_root, "ck_bronze")).awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == tx.count() + 1
    assert got.filter("route = 'valid'").count() == quality.valid_events(tx).count()
    bad = got.filter("route = 'quarantine'")
    assert bad.filter("raw is null or reason is null").count() == 0
    assert bad.filter("raw.event_time = 'not-a-time' and event_time is null").count() == 1


def test_day_grain_stream_answers_any_midnight_cutoff(spark, tmp_root, landed):
    from ledgerflow.plans.pipeline import silver_view

    src, tx = landed
    spec = PipelineSpec(root=os.path.join(tmp_root, "tables_day"))
    q = st.silver_fold_stream(spark, src, spec, None, max_files_per_trigger=1, grain="day")
    q.awaitTermination(300)
    v = quality.valid_events(tx)
    for cutoff in (dt.datetime(2024, 1, 10), fx.FIXTURE_CUTOFF):
        assert _rows(silver_view(spark, spec, cutoff)) == _rows(balances.silver_balances(v, cutoff))


def test_fold_stream_skips_redelivered_file(spark, tmp_root, landed):
    src, tx = landed
    # the last week's events land a second time as a new file
    tx.filter(F.dayofmonth("event_time") >= 22).coalesce(1).write.mode("append").parquet(src)
    spec = PipelineSpec(root=os.path.join(tmp_root, "tables_dedup"), cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    q = st.silver_fold_stream(spark, src, spec, fx.FIXTURE_CUTOFF, max_files_per_trigger=1, cross_batch_dedup=True)
    q.awaitTermination(300)
    want = balances.silver_balances(quality.valid_events(tx), fx.FIXTURE_CUTOFF)
    assert _rows(tables.SnapshotTable(spec.paths.silver).read(spark)) == _rows(want)


def test_update_mode_aggregate_upserts_durable_table(spark, tmp_root, landed):
    src, tx = landed
    spec = PipelineSpec(root=os.path.join(tmp_root, "tables_upd"), cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    q = st.account_totals_table_stream(spark, src, spec, fx.FIXTURE_CUTOFF, max_files_per_trigger=1)
    q.awaitTermination(300)
    store = tables.SnapshotTable(spec.paths.silver)
    assert store.latest(spark) == 3
    want = balances.silver_balances(quality.valid_events(tx), fx.FIXTURE_CUTOFF)
    assert _rows(store.read(spark)) == _rows(want)


def test_retracting_state_serves_many_events_a_call(spark, tmp_root):
    """More events than groups: the state has one row per group, and every event keeps its own version."""
    src = os.path.join(tmp_root, "grouped")
    spec = PipelineSpec(root=os.path.join(tmp_root, "tables_grouped"), cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    n, base = 3 * st.EVENT_GROUPS, 1 << 60  # ids that a double cannot hold
    first = spark.range(base, base + n).select(
        F.col("id").alias("event_id"),
        (F.col("id") % 7).alias("user_id"),
        (F.col("id") % 11).alias("account_id"),
        F.lit("DEPOSIT").alias("transaction_type"),
        (F.lit(fx.FIXTURE_CUTOFF - dt.timedelta(days=2)).cast("timestamp") + F.expr("make_dt_interval(0, 0, 0, id % 1000)")).alias("event_time"),
        (F.col("id") % 997).cast("decimal(18,2)").alias("amount"),
    )
    hour = F.expr("INTERVAL 1 HOUR")
    later = first.filter("event_id % 3 = 0").withColumn("event_time", F.col("event_time") + hour).withColumn("account_id", (F.col("account_id") + F.col("event_id") % 2))
    older = first.filter("event_id % 4 = 0").withColumn("event_time", F.col("event_time") - hour).withColumn("amount", F.lit(5).cast("decimal(18,2)"))
    again = later.unionByName(older).unionByName(first.filter("event_id % 5 = 0"))
    for rows in (first, again):
        rows.write.mode("append").parquet(src)
        q = st.retracting_totals_stream(spark, src, spec, fx.FIXTURE_CUTOFF)
        q.awaitTermination(300)
        assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= st.EVENT_GROUPS
    valid = quality.valid_events(first.unionByName(again))
    want = balances.silver_balances(quality.dedup_latest(valid, "event_id", ("event_time", "amount")), fx.FIXTURE_CUTOFF)
    got = {str(r["account_id"]): tuple(r)[1:] for r in tables.SnapshotTable(spec.paths.silver).read(spark).select(*want.columns).collect()}
    assert got == {str(r["account_id"]): tuple(r)[1:] for r in want.collect()}


def test_retracting_stream_takes_corrections_back(spark, tmp_root):
    """Corrections change amount, account, side of the cutoff; older and repeated versions change nothing; a restart is a no-op."""
    src = os.path.join(tmp_root, "corrected")
    spec = PipelineSpec(root=os.path.join(tmp_root, "tables_retract"), cfg=LedgerConfig(cutoff=fx.FIXTURE_CUTOFF))
    early, late = fx.FIXTURE_CUTOFF - dt.timedelta(days=3), fx.FIXTURE_CUTOFF + dt.timedelta(hours=1)
    hour = dt.timedelta(hours=1)
    types = "event_id long, user_id long, account_id long, transaction_type string, event_time timestamp, amount decimal(18,2)"
    deliveries = [
        [(1, 1, 10, early, "5.00"), (2, 1, 10, early, "7.25"), (3, 1, 11, early, "-2.00"), (4, 1, 12, early, None), (4, 1, 12, early, "1.00")],
        [(1, 1, 10, early + hour, "6.00"), (2, 1, 11, early + hour, "7.25"), (3, 1, 11, late, "-2.00"), (5, 1, 13, late, "0.01")],
        [(1, 1, 10, early, "99.00"), (2, 1, 11, early + hour, "7.25"), (4, 1, 12, early + 2 * hour, None), (5, 1, None, late + hour, "8.00")],
    ]
    seen = []
    for rows in deliveries:
        made = [(e, u, a, "DEPOSIT", wall, None if m is None else Decimal(m)) for e, u, a, wall, m in rows]
        spark.createDataFrame(made, types).coalesce(1).write.mode("append").parquet(src)
        seen += made
        for _ in range(2):  # the second run finds nothing new
            st.retracting_totals_stream(spark, src, spec, fx.FIXTURE_CUTOFF).awaitTermination(300)
        valid = quality.valid_events(spark.createDataFrame(seen, types))
        want = balances.silver_balances(quality.dedup_latest(valid, "event_id", ("event_time", "amount")), fx.FIXTURE_CUTOFF)
        got = {str(r["account_id"]): tuple(r)[1:] for r in tables.SnapshotTable(spec.paths.silver).read(spark).select(*want.columns).collect()}
        assert got == {str(r["account_id"]): tuple(r)[1:] for r in want.collect()}
    assert tables.SnapshotTable(spec.paths.silver).latest(spark) == 2
    with pytest.raises(ValueError):
        st.account_changes(spark.createDataFrame(seen, types).drop("event_id"))
