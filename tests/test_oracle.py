"""Every catalog query against its DuckDB statement on the driver's tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import QUERIES, oracle_sql, queries
from ledgerflow.plans import catalog
from ledgerflow.plans.oracle import ORACLE_SQL
from ledgerflow.plans.verify import compare, duck

from .conftest import SF_MID, SF_SMALL

LEDGER = sorted(QUERIES)


@pytest.fixture(scope="module")
def report(spark):
    return compare(spark, SF_SMALL, LEDGER, con=duck(SF_SMALL))


def test_every_query_has_an_oracle():
    assert set(LEDGER) <= set(ORACLE_SQL) and set(LEDGER) <= set(queries()) and set(LEDGER) <= set(oracle_sql())


def test_all_queries_match_oracle(report):
    bad = {k: v for k, v in report.items() if not v.get("match")}
    assert not bad, bad


def test_fixture_expectations(report):
    assert report["layer_counts"]["rows"] == 5
    assert report["gold_account_balance"]["rows"] == 15


def test_all_queries_match_oracle_at_sf001(spark):
    """The scale the driver's correctness gate uses."""
    rep = compare(spark, SF_MID, LEDGER, con=duck(SF_MID))
    bad = {k: v for k, v in rep.items() if not v.get("match")}
    assert not bad, bad


def test_fixture_reaches_every_merge_branch(spark):
    """New, common and stored-only accounts all occur."""
    stored = {r.account_id for r in catalog.stored(spark, SF_MID).select("account_id").collect()}
    incoming = {r.account_id for r in catalog.incoming(spark, SF_MID).select("account_id").collect()}
    assert incoming - stored and incoming & stored and stored - incoming
