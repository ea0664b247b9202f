"""ledgerflow: wallet-ledger analytics on Spark DataFrames.

Layers: ``sources`` (scans, sinks, snapshot tables), ``functions`` (pure
``Column`` builders), ``operators`` (``DataFrame -> DataFrame`` transforms),
``plans`` (the Bronze -> Silver -> Gold pipeline and the named query catalog)
and ``streaming`` (Structured Streaming twins of the batch operators).
"""

from ledgerflow.config import AccrualRule, Columns, LedgerConfig, TablePaths

__all__ = ["AccrualRule", "Columns", "LedgerConfig", "TablePaths"]
