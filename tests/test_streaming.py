"""File streams: batches, late and repeated events, restarts, against the batch version and plain sessions."""

import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as contract
from titlelens.streaming import closed_sessions, read_event_stream, run_available

from conftest import SF_SMALL, rows

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, at timestamp, who string, v long"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def sessions(df):
    return closed_sessions(df, "id", "who", "at", "10 minutes", "30 minutes", {"n": F.count(F.lit(1)), "total": F.sum("v")})


def add(spark, path, events):
    spark.createDataFrame([(i, None if m is None else at(m), w, v) for i, m, w, v in events], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path):
    feed = read_event_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    return sorted(rows(run_available(sessions(feed), str(tmp_path / "out"), str(tmp_path / "state"))), key=str)


def test_late_and_repeated_events_and_restart(spark, tmp_path):
    add(spark, str(tmp_path / "in"), [(1, 0, "a", 1), (2, 5, "a", 2), (2, 5, "a", 2), (3, 40, "b", 3), (None, 1, "a", 9), (4, None, "a", 9), (5, 41, None, 4)])
    assert run(spark, tmp_path) == []  # the watermark, 11, has passed no session's end
    add(spark, str(tmp_path / "in"), [(6, 12, "a", 5), (7, 9, "a", 100), (3, 40, "b", 3), (8, 100, "b", 6)])
    # 7 is late (9 is before 11); 6 comes in time and goes on from 2; 3 is a repeat known from the run before
    want = [("a", at(0), at(22), 3, 8), ("b", at(40), at(50), 1, 3), (None, at(41), at(51), 1, 4)]
    assert run(spark, tmp_path) == sorted(want, key=str)
    assert run(spark, tmp_path) == sorted(want, key=str)  # nothing new: nothing put out twice
    add(spark, str(tmp_path / "in"), [(9, 60, "a", 1), (10, 200, "a", 1)])  # 60 is late: the watermark is 70
    assert run(spark, tmp_path) == sorted([*want, ("b", at(100), at(110), 1, 6)], key=str)


def test_stream_equals_batch_and_plain_sessions(spark, tmp_path):
    rng = random.Random(5)
    events = [(i, rng.randrange(3000), "hot" if rng.random() < 0.5 else f"u{rng.randrange(20)}", i) for i in range(900)]
    add(spark, str(tmp_path / "in"), events + rng.sample(events, 200))
    plain, mark = [], max(m for _, m, _, _ in events) - 30
    for who in {w for _, _, w, _ in events}:
        mine = sorted((m, v) for _, m, w, v in events if w == who)
        cuts = [0, *(i for i in range(1, len(mine)) if mine[i][0] > mine[i - 1][0] + 10), len(mine)]
        for a, z in zip(cuts, cuts[1:]):
            if mine[z - 1][0] + 10 <= mark:
                plain.append((who, at(mine[a][0]), at(mine[z - 1][0] + 10), z - a, sum(v for _, v in mine[a:z])))
    got = run(spark, tmp_path)
    assert got == sorted(plain, key=str)
    assert sorted(rows(sessions(spark.read.parquet(str(tmp_path / "in")))), key=str) == got


def test_empty_stream(spark, tmp_path):
    add(spark, str(tmp_path / "in"), [])
    assert run(spark, tmp_path) == []


def test_rating_sessions_match_their_statement(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    df = contract.queries()["rating_sessions"](spark, SF_SMALL)
    want = con.execute(contract.oracle_sql()["rating_sessions"])
    assert [c[0] for c in want.description] == df.columns
    assert sorted(rows(df)) == sorted(want.fetchall()) != []
