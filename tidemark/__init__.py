"""tidemark — incremental, layered warehouse loading as Spark DataFrame plans.

Modules:
  functions/  Column -> Column helpers (normalisation, decoding, dates, hashing)
  sources/    reading landed tables, constant lookups, sinks and audit tables
  operators/  dedup, CDC resolve, watermark deltas, merges, SCD, lifecycle facts, DQ checks
  plans/      the registered queries over the driver tables, each with a DuckDB oracle
  streaming/  micro-batch CDC driver (readStream -> foreachBatch(resolve -> merge))
"""

from tidemark.session import build_session, checkpoint_dir  # noqa: F401
from tidemark.spec import TableSpec  # noqa: F401

__all__ = ["build_session", "checkpoint_dir", "TableSpec"]
