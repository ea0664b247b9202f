"""The driver contract in ``__spark_entry__``."""

from __future__ import annotations

import __spark_entry__ as entry_mod


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["account_id", "current_balance", "last_day_bonus"]
    assert df.count() > 0


def test_query_and_oracle_keys():
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert qs and set(sql) <= set(qs)
    assert set(entry_mod.QUERIES) <= set(qs) and set(entry_mod.QUERIES) <= set(sql)
