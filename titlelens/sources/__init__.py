"""Sources and sinks: catalogue schemas, file readers, views, report writer,
and the deterministic catalogue derivation from TPC-H-style tables."""

from titlelens.sources.schemas import SCHEMAS, KEYS
from titlelens.sources.files import (conform_catalog, conform_table, read_catalog, read_table,
                                     register_views, write_catalog)
from titlelens.sources.sink import write_report
from titlelens.sources.derived import derive_catalog

__all__ = ["SCHEMAS", "KEYS", "read_table", "read_catalog", "write_catalog", "register_views",
           "conform_table", "conform_catalog", "write_report", "derive_catalog"]
