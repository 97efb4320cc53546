"""Session helpers for tests, benchmarks and the CLI.

On a cluster the caller owns the session; nothing here overrides settings
that are already present.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter for these plans. AQE is on by default in Spark 4.x;
# it is listed so that an older default cannot silently switch it off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "titlelens") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
               .config("spark.driver.memory", os.environ.get("TITLELENS_DRIVER_MEMORY", "8g")))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings the plans rely on for hot keys, and what goes wrong without them.
_EXPECTED = {
    "spark.sql.adaptive.enabled": ("true", "no runtime re-planning: no skew-join splitting, no broadcast "
                                           "conversion of small runtime sides, no partition coalescing"),
    "spark.sql.adaptive.skewJoin.enabled": ("true", "a join key holding a large share of rows is processed "
                                                    "by a single task"),
    "spark.sql.exchange.reuse": ("true", "bounded lookups recompute the aggregate below a top-k"),
}


def check_session(spark: SparkSession) -> list[str]:
    """Warnings for session settings that defeat the plans' skew handling.
    The caller owns the session; nothing is changed here."""
    warnings = []
    for key, (want, consequence) in _EXPECTED.items():
        got = (spark.conf.get(key, None) or want).lower()
        if got != want:
            warnings.append(f"{key}={got}: {consequence}")
    limit = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if int(limit) < 5:
        warnings.append("spark.sql.optimizer.windowGroupLimitThreshold < 5: per-group top-k is not cut "
                        "before the shuffle, a hot group reaches one task whole")
    return warnings
