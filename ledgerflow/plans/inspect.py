"""Inspection report over a pipeline root: row counts and a few sample rows
per table (the quick look an operator takes after a run)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerflow.config import TablePaths
from ledgerflow.sources import tables


def layer_report(spark: SparkSession, root: str, sample_rows: int = 5) -> dict[str, dict]:
    """``{table: {"rows": n, "sample": [first rows...]}}`` for every table that
    exists under ``root``. ``sample_rows`` bounds what reaches the driver."""
    p = TablePaths(root)
    out: dict[str, dict] = {}
    candidates = {
        "bronze": p.bronze,
        "quarantine": p.quarantine,
        "audit": p.audit,
        "payout": p.payout,
    }
    for name, path in candidates.items():
        if tables.has_data(spark, path):
            df = spark.read.parquet(path)
            out[name] = {"rows": df.count(), "sample": [r.asDict() for r in df.limit(sample_rows).collect()]}
    for name, path in (("silver", p.silver), ("balance", p.balance)):
        store = tables.SnapshotTable(path)
        v = store.latest(spark)
        if v is not None:
            df = store.read(spark, v)
            out[name] = {
                "version": v,
                "rows": df.count(),
                "sample": [r.asDict() for r in df.limit(sample_rows).collect()],
            }
    return out
