"""Adapters from the driver's generic tables to the wallet event contract.

The driver ships a clickstream table (``events``) and an order table
(``orders``), not wallet events. These adapters re-read them as signed wallet
changes. Every input row comes out as exactly one event; none is dropped.
Because the source has no bad rows, a fixed rule turns a deterministic share
of them into defects (null ids, null type) so that quarantine routing has work
to do; ``error`` events map to an out-of-domain type code.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.config import RATE_TYPE
from ledgerflow.functions.money import money
from ledgerflow.functions.timeutil import ts_lit


@dataclass(frozen=True)
class Defects:
    """Deterministic defect injection: every n-th event id loses a field."""

    null_user_every: int = 97
    null_account_every: int = 89
    null_type_every: int = 83


# Fixed dates of the fixture scenario (the data spans 2024-01-01 .. 2024-01-30).
FIXTURE_CUTOFF = dt.datetime(2024, 1, 29)
# Stored state = everything before the last day; incoming = the last day.
LAST_BATCH_START = dt.datetime(2024, 1, 30)
# "now" for data-quality checks on future timestamps.
DQ_AS_OF = dt.datetime(2024, 1, 31)
# Daily rate table with deliberate gaps (as-of lookup fills them).
FIXTURE_RATES = (
    (dt.date(2024, 1, 1), "0.00050"),
    (dt.date(2024, 1, 5), "0.00055"),
    (dt.date(2024, 1, 12), "0.00060"),
    (dt.date(2024, 1, 20), "0.00045"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def wallet_events(spark: SparkSession, sf_dir: str, defects: Defects = Defects()) -> DataFrame:
    """``events`` as signed wallet changes (the ``tx`` fixture)."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    et = F.col("event_type")
    uid = F.col("user_id").cast("string")
    ttype = (
        F.when(eid % defects.null_type_every == 0, F.lit(None).cast("string"))
        .when(et == "signup", "WALLET_CREATED")
        .when(et == "view", "DEPOSIT")
        .when(et == "purchase", "WITHDRAWAL")
        .when((et == "click") & (eid % 2 == 0), "TRANSFER_IN")
        .when(et == "click", "TRANSFER_OUT")
        .otherwise(F.upper(et))
    )
    signed = (
        F.when(et == "signup", F.lit(0.0))
        .when((et == "purchase") | ((et == "click") & (eid % 2 == 1)), -F.col("value"))
        .otherwise(F.col("value"))
    )
    return ev.select(
        eid.alias("event_id"),
        F.when(eid % defects.null_user_every == 0, F.lit(None).cast("string")).otherwise(uid).alias("user_id"),
        F.when(eid % defects.null_account_every == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("acc-"), uid))
        .alias("account_id"),
        ttype.alias("transaction_type"),
        F.col("ts").cast("timestamp").alias("event_time"),
        money(signed).alias("amount"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as wallet changes: larger balances over several years."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    cust = F.col("o_custkey").cast("string")
    return o.select(
        F.col("o_orderkey").alias("event_id"),
        cust.alias("user_id"),
        F.concat(F.lit("cust-"), cust).alias("account_id"),
        F.when(status == "F", "WITHDRAWAL").when(status == "O", "DEPOSIT").otherwise("TRANSFER_IN").alias("transaction_type"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        money(F.when(status == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))).alias("amount"),
    )


def rates_table(spark: SparkSession, rates=FIXTURE_RATES) -> DataFrame:
    """``rates(rate_date date, rate decimal(9,8))`` built from text values."""
    schema = T.StructType(
        [T.StructField("rate_date", T.DateType(), False), T.StructField("rate_text", T.StringType(), False)]
    )
    df = spark.createDataFrame([(d, r) for d, r in rates], schema)
    return df.select("rate_date", F.col("rate_text").cast(RATE_TYPE).alias("rate"))


def redelivered(valid: DataFrame, since: dt.datetime) -> DataFrame:
    """At-least-once delivery with corrections (the ``tx_dup`` fixture).

    Every event from ``since`` on is delivered a second time, one minute
    later, with its amount raised by 1.00: the later copy is the correction.
    Every 50th event also comes as an older version (a minute earlier, 1.00
    less), every 70th as an exact copy: neither changes the latest version.
    """
    again = valid.filter(F.col("event_time") >= ts_lit(since)).select(
        "event_id",
        "user_id",
        "account_id",
        "transaction_type",
        (F.col("event_time") + F.expr("INTERVAL 1 MINUTE")).alias("event_time"),
        money(F.col("amount") + Decimal("1.00")).alias("amount"),
    )
    older = valid.filter(F.col("event_id") % 50 == 0).withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 1 MINUTE"))
    older = older.withColumn("amount", money(F.col("amount") - Decimal("1.00")))
    return valid.unionByName(again).unionByName(older).unionByName(valid.filter(F.col("event_id") % 70 == 0))
