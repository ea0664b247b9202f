"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path

#: White space of the contracts: blank and tab to carriage return. A word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: what follows survives lost executors without
    recomputing what came before, and several readers share one computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_bucket(col: str, n: int) -> Column:
    """crc32 of the id written as text, mod ``n`` (the contracts' fold number)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A key is heavy from this share of all rows on, so at most HEAVY_SHARE keys are.
HEAVY_SHARE = 1000
HEAVY_LEAST = 200


def join_by_key(rows: DataFrame, n_rows: int, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Left join of ``rows`` to ``groups`` (one row per key, ``size`` rows each) that no heavy key can skew.

    The at most HEAVY_SHARE heavy groups are broadcast; the rest is an
    ordinary shuffle join, none of whose keys has many rows.
    """
    heavy_from = max(HEAVY_LEAST, n_rows // HEAVY_SHARE)
    heavy = F.broadcast(groups.filter(F.col(size) >= heavy_from))
    light = groups.filter(F.col(size) < heavy_from)
    rest = rows.join(heavy.select(*keys), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(light, keys, "left"))


def give_back() -> None:
    """Hand the memory that Arrow and the C library hold for later use back to the system.

    Spark keeps a Python worker for the next tasks; without this it keeps the
    peak of those before, beside an executor whose heap has grown since.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for mapInArrow, after whose end the worker gives its memory back."""

    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole
