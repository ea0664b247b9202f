"""Reproducible samples: the same rows at every run, on every cluster.

A row's place is the MD5 of a seed and its key, so a sample does not depend on
partitions or on the order of files, and a larger sample contains a smaller
one. Exact sizes come from bounded top-k steps: every task passes on at most
the wanted number of rows (per stratum), whatever the table holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def place(key: str, seed: int = 0) -> Column:
    """Where a key stands in the sampling order: 32 hex digits, evenly spread. No key stands last."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def share(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """About ``fraction`` of the keys, with all their rows: one filter, no shuffle."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"a share of {fraction}")
    limit = f"{round(fraction * 16**8):09x}"  # nine digits, so that 1 takes all
    return df.filter(F.concat(F.lit("0"), F.substring(place(key, seed), 1, 8)) < F.lit(limit))


def _order(key: str, seed: int, df: DataFrame) -> list[Column]:
    # equal keys are told apart by the rest of the row; rows equal throughout are interchangeable
    return [place(key, seed).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in df.columns]]


def exactly(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows (all, if there are fewer): the first in sampling order, by a bounded heap per task."""
    return df.orderBy(*_order(key, seed, df)).limit(n)


def per_stratum(df: DataFrame, key: str, strata: list[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows of every combination of ``strata`` (all, if there are fewer; NULL is a value).

    Spark cuts every stratum to ``n`` rows within each task before the
    shuffle, so a stratum that holds most rows is no larger there than others.
    """
    w = Window.partitionBy(*strata).orderBy(*_order(key, seed, df))
    return df.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= n).drop("_place")
