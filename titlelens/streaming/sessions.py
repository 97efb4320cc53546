"""Sessions of events that arrive in files, may repeat and may be late.

A *late* event is one whose time is not after the watermark, the latest event time of all earlier
batches less the allowed delay; it is dropped. A session is put out once, when the watermark has
passed its end, so what is put out never changes. Event times are instants, delays and gaps are in hours or less. The state holds the ids seen
within the delay and the open sessions, both bounded by the delay and the gap and not by
the age of the stream, and is dealt out by hash of id and of key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_event_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files of ``path`` (a folder or a pattern) as a stream, each read once; later files join a later run with the same checkpoint."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drop_repeated_events(events: DataFrame, id_column: str, at: str, delay: str) -> DataFrame:
    """One delivery of each event: others within ``delay`` go. Events without an id or a time
    cannot be told from repeats and are left out. Batch tables keep one of all deliveries."""
    known = events.where(F.col(id_column).isNotNull() & F.col(at).isNotNull())
    if not events.isStreaming:
        return known.dropDuplicates([id_column])
    return known.withWatermark(at, delay).dropDuplicatesWithinWatermark([id_column])


def event_sessions(events: DataFrame, key: str, at: str, gap: str, sums: dict[str, Column]) -> DataFrame:
    """Per ``key`` (null is one) the runs of events, each less than ``gap`` after the one before: ``session_start`` (first
    event), ``session_end`` (last event and ``gap``) and the aggregates ``sums``."""
    found = events.groupBy(F.session_window(at, gap).alias("__session"), key).agg(*(c.alias(n) for n, c in sums.items()))
    return found.select(key, F.col("__session.start").alias("session_start"), F.col("__session.end").alias("session_end"), *sums)


def closed_sessions(events: DataFrame, id_column: str, key: str, at: str, gap: str, delay: str, sums: dict[str, Column]) -> DataFrame:
    """The sessions that can no longer change. A stream gives them as they close; a batch
    table those that end before its last event less ``delay``, which is what a stream that got the
    whole table has put out."""
    once = drop_repeated_events(events, id_column, at, delay)
    found = event_sessions(once, key, at, gap, sums)
    if events.isStreaming:
        return found
    last = once.agg((F.max(at) - F.expr(f"INTERVAL {delay}")).alias("__mark")).scalar()
    return found.where(F.col("session_end") <= last)


def run_available(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run the stream over all files that have arrived, append what it puts out to the Parquet table ``path``
    and return that table. ``checkpoint`` keeps offsets and state: a run that was cut off or is repeated goes on
    there and puts out no row twice. Both must be on storage that all executors share."""
    run = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    query = run.trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
