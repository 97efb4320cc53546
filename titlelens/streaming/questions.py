"""The registered question over a stream: rating sessions from the events table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.streaming.sessions import closed_sessions, read_event_stream, run_available

GAP, DELAY = "6 hours", "24 hours"


def utc_instant(wall: Column) -> Column:
    """The instant of a time without zone (watermarks need instants), read as UTC whatever the session's zone is."""
    seconds = F.unix_date(wall.cast("date")) * F.lit(86400).cast("long") + F.hour(wall) * 3600 + F.minute(wall) * 60
    return F.timestamp_micros(seconds * 1000000 + (F.date_part(F.lit("SECOND"), wall) * 1000000).cast("long"))


def deliveries(events: DataFrame) -> DataFrame:
    """Rating events as a feed that sends every tenth event twice delivers them."""
    times = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return events.select("event_id", utc_instant(F.col("ts")).alias("ts"), "user_id", "event_type", "value", F.explode(times).alias("delivery"))


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        folder = tempfile.gettempdir()
    return f"{folder.rstrip('/')}/rating-sessions-{uuid.uuid4().hex}"


def rating_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions of each user's events, read as a file stream: repeats removed, six hours
    apart at most, one day late at most. The folder of a call is its own; a standing job keeps
    one and calls ``run_available`` again."""
    base = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{base}/events.parquet").schema
    # A pattern may name a file or a folder; a plain path of a stream must be a folder.
    feed = deliveries(read_event_stream(spark, base + "/{events}.parquet", schema))
    sums = {"event_count": F.count(F.lit(1)), "best_value": F.max("value"), "view_count": F.count_if(F.col("event_type") == "view")}
    folder = _shared_folder(spark)
    found = run_available(closed_sessions(feed, "event_id", "user_id", "ts", GAP, DELAY, sums), f"{folder}/sessions", f"{folder}/state")
    return found.select("user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), *sums)


QUERIES = {"rating_sessions": rating_sessions}

ORACLE_SQL = {"rating_sessions": """
WITH fed AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0),
once AS (SELECT event_id, any_value(ts) AS ts, any_value(user_id) AS user_id, any_value(event_type) AS event_type, any_value(value) AS value
         FROM fed WHERE event_id IS NOT NULL AND ts IS NOT NULL GROUP BY event_id),
o AS (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM once),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS number FROM o),
s AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 6 HOUR AS z, count(*) AS event_count, max(value) AS best_value,
             count(*) FILTER (WHERE event_type = 'view') AS view_count FROM n GROUP BY user_id, number)
SELECT user_id, epoch_us(a) AS start_us, epoch_us(z) AS end_us, event_count, best_value, view_count
FROM s WHERE z <= (SELECT max(ts) - INTERVAL 1 DAY FROM once)"""}
