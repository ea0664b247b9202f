"""Explicit schemas for the event contract and the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerflow.config import Columns

MONEY = T.DecimalType(18, 2)

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("account_id", T.StringType(), True),
        T.StructField("transaction_type", T.StringType(), True),
        T.StructField("event_time", T.TimestampType(), True),
        T.StructField("amount", MONEY, True),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("account_id", T.StringType(), False),
        T.StructField("total_amount", MONEY, False),
        T.StructField("amount_cdi_applicable", MONEY, False),
        T.StructField("amount_cdi_not_applicable", MONEY, False),
    ]
)

PAYOUT = T.StructType(
    [
        T.StructField("account_id", T.StringType(), True),
        T.StructField("cdi_bonus", MONEY, True),
        T.StructField("business_date", T.DateType(), True),
        T.StructField("run_id", T.StringType(), True),
        T.StructField("cdi_bonus_date", T.TimestampType(), True),
    ]
)

BALANCE = T.StructType(
    [
        T.StructField("account_id", T.StringType(), True),
        T.StructField("current_balance", MONEY, True),
        T.StructField("last_day_bonus", MONEY, True),
        T.StructField("business_date", T.DateType(), True),
    ]
)


def named(contract: T.StructType, cols: Columns) -> T.StructType:
    """``contract`` under the configured column names."""
    return T.StructType([T.StructField(getattr(cols, f.name, f.name), f.dataType, f.nullable) for f in contract.fields])
