"""Normalising raw event files to the event contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.config import MONEY_TYPE, Columns


def normalize(df: DataFrame, cols: Columns = Columns(), event_id_type: str | None = None) -> DataFrame:
    """Cast raw columns to the contract types without failing the job.

    ``event_time`` held as text is parsed with ``try_to_timestamp`` (so a
    textual comparison with the cutoff can never happen); ``amount`` is
    converted to exact money with ``try_cast``. Event ids held as text stay
    text and numbers become longs; with ``event_id_type`` ("long" or "string")
    they are brought to that type, for tables fed from sources that disagree.
    Values that do not parse become NULL and are quarantined by the routing
    checks. Extra columns pass through.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = df
    et = fields.get(cols.event_time)
    if isinstance(et, T.StringType):
        out = out.withColumn(cols.event_time, F.try_to_timestamp(F.col(cols.event_time)))
    elif et is not None and not isinstance(et, T.TimestampType):
        out = out.withColumn(cols.event_time, F.col(cols.event_time).try_cast("timestamp"))
    amt = fields.get(cols.amount)
    if amt is not None and amt != T.DecimalType(18, 2):
        out = out.withColumn(cols.amount, F.col(cols.amount).try_cast(MONEY_TYPE))
    eid = fields.get(cols.event_id)
    if eid is not None:
        wanted = event_id_type or ("string" if isinstance(eid, T.StringType) else "long")
        if wanted not in ("long", "string"):
            raise ValueError(f"event ids cannot be brought to {wanted!r}")
        if not isinstance(eid, T.StringType if wanted == "string" else T.LongType):
            out = out.withColumn(cols.event_id, F.col(cols.event_id).try_cast(wanted))
    for c in (cols.user_id, cols.account_id, cols.transaction_type):
        if c in fields and not isinstance(fields[c], T.StringType):
            out = out.withColumn(c, F.col(c).cast("string"))
    return out
