"""Plan assertions: the physical shapes the design relies on at scale."""

import re

import pytest

from titlelens.plans.registry import QUESTIONS
from titlelens.sources import derive_catalog, read_catalog, write_catalog

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def parquet_catalog(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("catalog"))
    write_catalog(derive_catalog(spark, SF_SMALL, reuse=False), path)
    return read_catalog(spark, path, fmt="parquet", strict=True)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return physical(df)


@pytest.mark.parametrize("name", ["top_titles_per_genre", "top_actors_per_genre", "top_titles_per_region"])
def test_per_group_limit_is_partial_before_shuffle(parquet_catalog, name):
    plan = physical(QUESTIONS[name](parquet_catalog))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


@pytest.mark.parametrize("name", ["top_rated_titles", "duplicate_titles", "most_genre_diverse_people",
                                  "series_by_episode_count", "non_english_languages"])
def test_top_k_is_take_ordered(parquet_catalog, name):
    assert "TakeOrderedAndProject" in physical(QUESTIONS[name](parquet_catalog))


def test_no_cartesian_no_python_in_any_plan(spark, parquet_catalog):
    for name, q in QUESTIONS.items():
        plan = physical(q(parquet_catalog))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                    "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in plan, (name, bad)


def test_filters_and_columns_reach_the_scan(parquet_catalog):
    plan = physical(QUESTIONS["top_rated_titles"](parquet_catalog))
    assert "PushedFilters: [IsNotNull(titleType), EqualTo(titleType,movie)" in plan
    assert "GreaterThanOrEqual(numVotes,10000)" in plan
    # only the needed columns are read (runtimeMinutes, isAdult, endYear are not)
    read = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert any("titleType" in r and "runtimeMinutes" not in r for r in read)


# One kilobyte: large tables for the planner, small for twenty rows.
LOOKUPS = {"directors_of_high_rated": ("title.crew",), "lead_director_genre_counts": ("title.crew",),
           "most_referenced_titles": (), "release_gap_by_director": ("title.crew",)}


@pytest.mark.parametrize("name", LOOKUPS)
def test_bounded_lookup_runs_its_input_once(spark, parquet_catalog, name):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "1k", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plan = physical(QUESTIONS[name](parquet_catalog))
        huge = physical(QUESTIONS[name](parquet_catalog, n=50_000_000))
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "ReusedExchange" in plan
    # the dimension is filtered by a broadcast of the few top-k keys; of a huge limit it is not
    assert "LeftSemi, BuildRight" in plan and "BroadcastHashJoin" in plan
    assert "BroadcastHashJoin" not in huge and "BroadcastExchange" not in huge
    # one partial aggregate and one explode below the shuffle that both branches read
    assert len(re.findall(r"HashAggregate\(keys=\[[^\]]+\], functions=\[[^\]]*partial_", plan)) == 1
    assert plan.count("Generate explode") <= 1
    for table in LOOKUPS[name]:
        assert len(re.findall(rf"FileScan parquet.*{table}", plan)) == 1


def test_short_list_is_broadcast_and_a_huge_one_is_not(spark, parquet_catalog):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        short = physical(QUESTIONS["most_credited_people"](parquet_catalog, pool=10))
        huge = physical(QUESTIONS["most_credited_people"](parquet_catalog, pool=50_000_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "BroadcastHashJoin" in short and "BroadcastHashJoin" not in huge


def test_window_trend_reuses_partitioning(spark, parquet_catalog):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(QUESTIONS["improving_directors"](parquet_catalog))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # exchanges on the director key: the (director, year) aggregate, the
    # window, and the name table's side of the final join. The per-director
    # aggregate after the window and the fact side of that join reuse the
    # window's partitioning.
    assert len(re.findall(r"Exchange hashpartitioning\(director_id#\d+, startYear", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(director_id#\d+, \d+\)", plan)) == 2
    assert plan.count("Exchange") == 3 + plan.count("BroadcastExchange") + len(
        re.findall(r"Exchange hashpartitioning\(tconst", plan))


def test_release_gap_has_no_window(parquet_catalog):
    plan = physical(QUESTIONS["release_gap_by_director"](parquet_catalog))
    assert "Window" not in plan


@pytest.mark.parametrize("name", ["non_english_languages", "top_titles_per_region", "most_credited_people"])
def test_runtime_bloom_filter_prefilters_fact_scans(spark, parquet_catalog, name):
    # At scale the fact side (credits, alternative titles) exceeds Spark's
    # application-side threshold; scaled down here so the rule fires.
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plan = final_plan(QUESTIONS[name](parquet_catalog))
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "might_contain" in plan and "bloom_filter_agg" in plan


# Global windows over bounded domains (decades, genres, years).
WINDOWED_OVER_AGGREGATES = {"title_rank_positions", "runtime_by_decade", "genre_runtime_ranking", "votes_by_year_running_avg"}
# Whole-table profiles: global aggregates whose single task merges per-task partials.
GLOBAL_AGGREGATES = {"catalog_tables", "catalog_profile", "catalog_numeric_stats", "catalog_column_stats",
                     "catalog_key_violations"}


def test_single_partition_exchanges_only_over_aggregates(parquet_catalog):
    for name, q in QUESTIONS.items():
        lines = physical(q(parquet_catalog)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            child = lines[i + 1]
            if name in WINDOWED_OVER_AGGREGATES:
                # rows are already one per decade / genre / year / bucket of values
                assert "HashAggregate(keys=[" in child and "keys=[]" not in child, (name, child)
            elif name in GLOBAL_AGGREGATES:
                assert re.search(r"Aggregate\(keys?=\[\], functions=\[partial_", child), (name, child)
            else:
                raise AssertionError(f"{name}: unexpected single-partition exchange above {child.strip()}")
