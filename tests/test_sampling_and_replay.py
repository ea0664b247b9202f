"""Samples, the audit replay by digests and the outage check."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import Counter

from pyspark.sql import functions as F

from ledgerflow.operators import accrual, balances, quality, sampling
from ledgerflow.sources import fixtures as fx

from .conftest import SF_SMALL
from .test_state_and_runs import scanned


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("kind", F.when(F.col("id") % 10 == 0, "rare").otherwise("usual"))
    want = sorted(sorted(range(5000), key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())[:40])
    for n in (1, 7, 40):
        assert ids(sampling.exactly(df.repartition(n), "id", 40, seed=3)) == want
    assert set(want) <= set(ids(sampling.exactly(df, "id", 90, seed=3)))
    per = sampling.per_stratum(df.repartition(9), "id", ["kind"], 25, seed=3)
    assert Counter(r.kind for r in per.collect()) == {"rare": 25, "usual": 25}
    assert ids(per) == ids(sampling.per_stratum(df, "id", ["kind"], 25, seed=3))
    assert ids(sampling.exactly(df, "id", 40, seed=4)) != want


def test_samples_of_small_and_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, "a")], "id long, kind string")
    assert sampling.exactly(df, "id", 10).count() == 4
    assert sampling.exactly(df, "id", 0).count() == 0
    assert Counter(r.kind for r in sampling.per_stratum(df, "id", ["kind"], 1).collect()) == {None: 1, "a": 1}
    assert sampling.per_stratum(df.limit(0), "id", ["kind"], 3).count() == 0
    many = spark.range(4000)
    assert sampling.share(many, "id", 0).count() == 0 and sampling.share(many, "id", 1).count() == 4000
    some = ids(sampling.share(many, "id", 0.1))
    assert 330 < len(some) < 470 and set(some) <= set(ids(sampling.share(many, "id", 0.2)))


def test_a_stratum_is_cut_before_the_shuffle(spark):
    plan = sampling.per_stratum(spark.range(100).withColumn("k", F.col("id") % 3), "id", ["k"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.rfind("WindowGroupLimit") > plan.rfind("Exchange")


def _gold(spark, events):
    return accrual.with_accrual(balances.silver_balances(events, fx.FIXTURE_CUTOFF))


def test_digest_replay_finds_what_the_full_join_finds(spark, tmp_root):
    v = quality.valid_events(fx.wallet_events(spark, SF_SMALL))
    a, b = _gold(spark, v), _gold(spark, v.filter("account_id <> 'acc-3' and event_id <> 17"))
    want = sorted(map(tuple, accrual.audit_diff(a, b).collect()))
    assert want and sorted(map(tuple, accrual.audit_diff_by_digest(a, b, 8).collect())) == want
    assert sorted(map(tuple, accrual.audit_diff_by_digest(b, a, 4096).collect())) == sorted(map(tuple, accrual.audit_diff(b, a).collect()))
    nulls = a.withColumn("cdi_bonus", F.when(F.col("account_id") == "acc-5", None).otherwise(F.col("cdi_bonus")))
    assert [r.account_id for r in accrual.audit_diff_by_digest(a, nulls).collect()] == ["acc-5"]


def test_equal_buckets_are_not_joined(spark, tmp_root):
    a = _gold(spark, quality.valid_events(fx.wallet_events(spark, SF_SMALL)))
    a.write.parquet(f"{tmp_root}/a")
    a.withColumn("cdi_bonus", F.when(F.col("account_id") == "acc-5", F.col("cdi_bonus") + 1).otherwise(F.col("cdi_bonus")).cast("decimal(18,2)")).write.parquet(f"{tmp_root}/b")
    left, right = spark.read.parquet(f"{tmp_root}/a"), spark.read.parquet(f"{tmp_root}/b")
    diff = accrual.audit_diff_by_digest(left, right)
    assert [r.account_id for r in diff.collect()] == ["acc-5"]
    joined = _rows_into_full_outer(diff)
    assert joined and max(joined) <= 2  # of 15 accounts a side
    same = accrual.audit_diff_by_digest(left, left)
    assert same.collect() == [] and scanned(same) >= 0


def _rows_into_full_outer(df):
    """Shuffled rows below the row join of an executed plan."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
        text = node.simpleString(100)
        if name == "ShuffleExchangeExec" and "account_id" in text.split("ENSURE")[0] and "bucket" not in text.split("ENSURE")[0]:
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_outage_after_the_last_row_is_found(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d, minutes=m),) for d in range(28) for m in range(100 if d % 7 < 5 else 20)]
    df = spark.createDataFrame(rows, "event_time timestamp")
    assert quality.volume_outage(df, dt.date(2024, 1, 29)).count() == 0  # quiet weekends are usual
    found = quality.volume_outage(df, dt.date(2024, 1, 31)).collect()
    assert [(str(r.d), r.n, int(r.expected)) for r in found] == [("2024-01-29", 0, 100), ("2024-01-30", 0, 100)]
    half = df.filter("to_date(event_time) <> '2024-01-24' or minute(event_time) < 30")
    assert [str(r.d) for r in quality.volume_outage(half, dt.date(2024, 1, 29)).collect()] == ["2024-01-24"]
    assert quality.volume_outage(df.limit(0), dt.date(2024, 1, 29)).count() == 0
