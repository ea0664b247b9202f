"""Published-table contracts: schema, nullability and key uniqueness (D11)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Violation:
    kind: str
    detail: str


def check(df: DataFrame, expected: T.StructType, key: list[str]) -> list[Violation]:
    """Compare ``df`` with a contract; empty list means it holds.

    Types must match exactly (money stays decimal(18,2)); key columns must be
    non-null and unique, other columns non-null where the contract says so. Null and duplicate checks run as one aggregate over
    the key (partial counts map-side), never by collecting rows.
    """
    out: list[Violation] = []
    actual = {f.name: f.dataType for f in df.schema.fields}
    for f in expected.fields:
        if f.name not in actual:
            out.append(Violation("missing_column", f.name))
        elif actual[f.name] != f.dataType:
            out.append(Violation("type", f"{f.name}: {actual[f.name].simpleString()} != {f.dataType.simpleString()}"))
    for name in actual:
        if name not in expected.fieldNames():
            out.append(Violation("extra_column", name))
    if any(v.kind == "missing_column" and v.detail in key for v in out):
        return out
    required = [f.name for f in expected.fields if not f.nullable and f.name in actual and f.name not in key]
    if required:
        nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required]).first()
        out += [Violation("null_value", f"{c}: {nulls[c]} nulls") for c in required if nulls[c]]
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.max(null_key.cast("int")).alias("_null"))
    stats = per_key.agg(
        F.count(F.when(F.col("_n") > 1, 1)).alias("dup_keys"),
        F.count(F.when(F.col("_null") == 1, 1)).alias("null_keys"),
    ).first()
    if stats["dup_keys"]:
        out.append(Violation("duplicate_key", f"{stats['dup_keys']} keys repeat"))
    if stats["null_keys"]:
        out.append(Violation("null_key", f"{stats['null_keys']} null keys"))
    return out


def require(df: DataFrame, expected: T.StructType, key: list[str], what: str) -> None:
    """Raise if ``df`` breaks its contract: the gate before a table is published."""
    if broken := check(df, expected, key):
        raise ValueError(f"{what} breaks its contract: " + "; ".join(f"{v.kind} {v.detail}" for v in broken))
