"""titlelens: title-catalogue analytics as lazy Spark DataFrame transforms.

Layers:
  sources/    schemas, TSV/Parquet catalogue readers, views, report sink,
              and the deterministic catalogue derivation used by tests
  functions/  column-level helpers (multi-value lists, decades)
  operators/  DataFrame-level building blocks (top-k, per-group limits,
              lag trends, bounded dimension lookups)
  plans/      the 24 catalogue questions, profiling and the batch runner
"""

from titlelens.catalog import Catalog, TABLES

__all__ = ["Catalog", "TABLES"]
