"""Upsert on an equality key, as a DataFrame operator (no table format needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_source(source: DataFrame, key: str) -> DataFrame:
    """``source`` with a lazy guard: the job fails if a key repeats or is NULL.

    The guard is an aggregate by ``key``; its output is already hash-partitioned
    by ``key``, so the join that follows reuses that partitioning.
    """
    others = [c for c in source.columns if c != key]
    g = source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in others])
    checked_key = (
        F.when(F.col(key).isNull(), F.raise_error(F.lit(f"upsert source has a NULL {key}")))
        .when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"upsert source repeats {key} "), F.col(key).cast("string"))))
        .otherwise(F.col(key))
    )
    return g.select(checked_key.alias(key), *others)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_cols: list[str] | None = None,
    insert: bool = True,
    check_source: bool = True,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``key`` and return the new table.

    * matched: columns in ``update_cols`` (default: every source column) take
      the source value; other target columns keep theirs;
    * source-only rows are inserted (target columns missing in the source are
      NULL) when ``insert``;
    * target-only rows are kept unchanged.

    One full outer join; the output has the target's column order.
    """
    src = unique_source(source, key) if check_source else source
    update = [c for c in (update_cols if update_cols is not None else src.columns) if c != key]
    t = target.alias("t")
    s = src.withColumn("_src", F.lit(True)).alias("s")
    how = "full_outer" if insert else "left_outer"
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), how)
    matched_or_new = F.col("s._src").isNotNull()
    out = []
    for c in target.columns:
        if c == key:
            out.append(F.coalesce(F.col(f"t.{key}"), F.col(f"s.{key}")).alias(key))
        elif c in update:
            out.append(F.when(matched_or_new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in src.columns:
            # not updated on match, but an inserted row takes the source value
            new_only = matched_or_new & F.col(f"t.{key}").isNull()
            out.append(F.when(new_only, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)


def upsert_touched_only(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_cols: list[str] | None = None,
    check_source: bool = True,
) -> DataFrame:
    """``upsert`` for a source much smaller than the target (same rows).

    Only target rows whose key is in the source take part in the outer join;
    the rest are carried over by an anti join. The source keys go through one
    shuffle, so AQE measures them and broadcasts them into the semi and anti
    joins when small: the large target is then read once per join and never
    shuffled. Target rows with a NULL key are kept, as in ``upsert``.
    """
    src = unique_source(source, key) if check_source else source
    keys = src.select(key)
    touched = target.join(keys, key, "left_semi")
    untouched = target.join(keys, key, "left_anti")
    merged = upsert(touched, src, key, update_cols, insert=True, check_source=False)
    return merged.unionByName(untouched.select(*target.columns))
