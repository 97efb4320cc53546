"""Batch runner: answer a set of questions and write each as a report.

Every question is one lazy plan executed by exactly one action (its write);
a failing question is recorded and the others still run. The status is
returned as a small DataFrame (one row per question).
"""

from __future__ import annotations

import time
import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from titlelens.catalog import Catalog
from titlelens.plans.registry import QUESTIONS, question
from titlelens.sources.sink import write_report

STATUS_SCHEMA = StructType([
    StructField("question", StringType(), False),
    StructField("status", StringType(), False),
    StructField("seconds", DoubleType(), True),
    StructField("path", StringType(), True),
    StructField("error", StringType(), True),
])


def run_reports(spark: SparkSession, catalog: Catalog, out: str, names=None, fmt: str = "csv",
                params: dict | None = None) -> DataFrame:
    """Write ``out/<question>`` for each name (default: every question).
    ``params`` maps a question name to parameter overrides."""
    params = params or {}
    rows = []
    for name in (names or list(QUESTIONS)):
        path = f"{out.rstrip('/')}/{name}"
        t0 = time.perf_counter()
        try:
            df = question(name)(catalog, **params.get(name, {}))
            write_report(df, path, fmt=fmt)
            rows.append((name, "ok", time.perf_counter() - t0, path, None))
        except Exception as exc:  # isolate failures: record and continue
            detail = "".join(traceback.format_exception_only(type(exc), exc)).strip()
            rows.append((name, "failed", time.perf_counter() - t0, None, detail))
    return spark.createDataFrame(rows, STATUS_SCHEMA)
