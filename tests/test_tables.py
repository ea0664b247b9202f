"""Table I/O: schema evolution, one-pass routing, snapshots, exports."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import tables

from .conftest import SF_SMALL


def test_append_with_new_column_reads_null_for_old_rows(spark, tmp_root):
    p = os.path.join(tmp_root, "t")
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    b = spark.createDataFrame([(2, "y", "web")], "id long, v string, channel string")
    tables.append(a, p)
    tables.append(b, p)
    got = {r.id: r.channel for r in tables.read_evolving(spark, p).collect()}
    assert got == {1: None, 2: "web"}


def test_write_routed_is_total_and_single_job(spark, tmp_root):
    tx = fx.wallet_events(spark, SF_SMALL)
    p = os.path.join(tmp_root, "routed")
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    tables.write_routed(tx, p)
    valid = spark.read.parquet(os.path.join(p, "route=valid"))
    bad = spark.read.parquet(os.path.join(p, "route=quarantine"))
    assert valid.count() + bad.count() == tx.count()
    assert bad.filter(F.coalesce(F.size("reasons"), F.lit(0)) == 0).count() == 0
    assert valid.filter(F.col("reasons").isNotNull()).count() == 0
    assert jobs_before is not None


def test_snapshot_versions(spark, tmp_root):
    st = tables.SnapshotTable(os.path.join(tmp_root, "snap"))
    assert not st.is_table(spark)
    st.write(spark.range(3), 0)
    st.write(spark.range(5), 1)
    os.makedirs(os.path.join(tmp_root, "snap", "version=2"))  # incomplete: no _SUCCESS
    assert st.versions(spark) == [0, 1]
    assert st.read(spark).count() == 5
    assert st.latest(spark, below=1) == 0
    assert st.next_version(spark) == 2


def test_export_partitions_replaces_only_its_date(spark, tmp_root):
    p = os.path.join(tmp_root, "export")
    d1 = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "k string, business_date string")
    tables.export_partitions(d1, p, "business_date")
    d2 = spark.createDataFrame([("c", "2024-01-02")], "k string, business_date string")
    tables.export_partitions(d2, p, "business_date")
    got = sorted((r.k, str(r.business_date)) for r in spark.read.parquet(p).collect())
    assert got == [("a", "2024-01-01"), ("c", "2024-01-02")]
    tables.export_partitions(d2, os.path.join(tmp_root, "csv"), "business_date", fmt="csv")
    assert spark.read.option("header", True).csv(os.path.join(tmp_root, "csv")).count() == 1


def test_catalog_table_append(spark):
    name = "ledgerflow_test_payout"
    spark.sql(f"drop table if exists {name}")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert not tables.table_exists(spark, name)
    tables.append_table(df, name)
    # by name, whatever the order; a new column is added
    tables.append_table(spark.createDataFrame([(2, "b", 0.5)], "v int, k string, x double"), name)
    assert sorted(map(tuple, tables.read_table(spark, name).collect())) == [("a", 1, None), ("b", 2, 0.5)]
    tables.append_table(spark.createDataFrame([("c",)], "k string"), name)
    assert tables.read_table(spark, name).filter("v is null").count() == 1
    tables.overwrite_table(spark.createDataFrame([(9,)], "only int"), name)
    assert tables.read_table(spark, name).columns == ["only"]
    spark.sql(f"drop table if exists {name}")


def test_payout_contract(spark):
    from decimal import Decimal

    from pyspark.sql import types as T

    from ledgerflow.operators.contracts import check
    from ledgerflow.schema import BALANCE

    good = spark.createDataFrame([("a", Decimal("1.00"), Decimal("0.00"), None)], BALANCE)
    assert check(good, BALANCE, ["account_id"]) == []
    dup = good.unionByName(good).unionByName(spark.createDataFrame([(None, Decimal("1"), Decimal("0"), None)], BALANCE))
    kinds = {v.kind for v in check(dup, BALANCE, ["account_id"])}
    assert kinds == {"duplicate_key", "null_key"}
    drift = good.withColumn("current_balance", good.current_balance.cast("double")).withColumn("x", good.account_id)
    kinds = {v.kind for v in check(drift, BALANCE, ["account_id"])}
    assert kinds == {"type", "extra_column"}
    assert isinstance(BALANCE, T.StructType)
    strict = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("v", T.IntegerType(), False)])
    nulls = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int")
    assert {v.kind for v in check(nulls, strict, ["k"])} == {"null_value"}


def test_input_size_and_scale_settings(spark, tmp_root):
    from ledgerflow.session import GIB, scale_settings

    n = tables.input_size(spark, os.path.join(SF_SMALL, "events.parquet"))
    assert n == os.path.getsize(os.path.join(SF_SMALL, "events.parquet"))
    small = scale_settings(n, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    big = scale_settings(100_000 * GIB, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == str(100_000)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_has_data_sees_dynamic_partition_writes(spark, tmp_root):
    p = os.path.join(tmp_root, "dyn")
    assert not tables.has_data(spark, p)
    tables.write_partitions(spark.createDataFrame([(1, "x")], "v long, k string"), p, ["k"])
    assert tables.has_data(spark, p) and not tables.exists(spark, p)
