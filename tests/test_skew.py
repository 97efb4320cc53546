"""Hot keys: one title holding a third of all credits, one genre holding a
third of all titles. Thresholds are scaled down to test size so that the
mechanisms the plans rely on at scale actually trigger here."""

import pytest
from pyspark.sql import functions as F

from titlelens.catalog import Catalog, TABLES
from titlelens.plans.registry import QUESTIONS
from titlelens.sources.schemas import SCHEMAS

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot_catalog(spark):
    n = 6000

    def conform(df, table):
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in SCHEMAS[table].fields])

    ids = spark.range(n).withColumn("k", F.col("id"))
    basics = conform(ids.select(
        F.concat(F.lit("tt"), F.col("k").cast("string")).alias("tconst"),
        F.when(F.col("k") % 2 == 0, "tvEpisode").otherwise("movie").alias("titleType"),
        F.lit(2000).alias("startYear"),
        F.when(F.col("k") % 3 == 0, "Drama").otherwise(F.concat(F.lit("G"), (F.col("k") % 50).cast("string")))
        .alias("genres")), "title.basics")
    # a third of all credits on title tt0, the rest spread over all titles
    credits = conform(spark.range(3 * n).select(
        F.when(F.col("id") % 3 == 0, F.lit("tt0"))
        .otherwise(F.concat(F.lit("tt"), (F.col("id") % n).cast("string"))).alias("tconst"),
        F.col("id").cast("int").alias("ordering"),
        F.concat(F.lit("nm"), (F.col("id") % 997).cast("string")).alias("nconst"),
        F.lit("actor").alias("category")), "title.principals")
    names = conform(spark.range(997).select(F.concat(F.lit("nm"), F.col("id").cast("string")).alias("nconst"),
                                            F.concat(F.lit("P"), F.col("id").cast("string")).alias("primaryName")),
                    "name.basics")
    frames = {t: spark.createDataFrame([], SCHEMAS[t]) for t in TABLES}
    frames.update({"title.basics": basics, "title.principals": credits, "name.basics": names})
    return Catalog(frames)


def _final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_title_join_is_split(spark, skew_conf, hot_catalog):
    plan = _final(QUESTIONS["most_credited_people"](hot_catalog))
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_title_answers_unchanged_by_skew_handling(spark, hot_catalog, skew_conf):
    skewed = sorted(map(tuple, QUESTIONS["top_actors_per_genre"](hot_catalog).collect()))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = sorted(map(tuple, QUESTIONS["top_actors_per_genre"](hot_catalog).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert skewed == plain and skewed


def test_hot_genre_is_cut_before_its_shuffle(spark, hot_catalog, skew_conf):
    plan = _final(QUESTIONS["top_actors_per_genre"](hot_catalog))
    # the per-genre limit runs on the map side, so the hot genre's shuffle
    # carries only each task's leaders, and aggregates combine map-side
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "partial_count" in plan and "partial_sum" in plan


def test_hot_title_does_not_flood_its_region(spark, skew_conf):
    """One leading title with a third of all alternative titles, all in one region."""
    n = 9000

    def conform(df, table):
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in SCHEMAS[table].fields])

    ids = spark.range(n // 3).select(F.concat(F.lit("tt"), F.col("id").cast("string")).alias("tconst"), "id")
    frames = {t: spark.createDataFrame([], SCHEMAS[t]) for t in TABLES}
    frames["title.basics"] = conform(ids.withColumns({"titleType": F.lit("movie"), "primaryTitle": F.col("tconst")}), "title.basics")
    frames["title.ratings"] = conform(ids.select("tconst", F.when(F.col("id") == 0, 9.9).otherwise(5.0 + F.col("id") % 40 / 10).alias("averageRating"),
                                                 F.lit(5000).alias("numVotes")), "title.ratings")
    frames["title.akas"] = conform(spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "tt0").otherwise(F.concat(F.lit("tt"), (F.col("id") % (n // 3)).cast("string"))).alias("titleId"),
        F.col("id").cast("int").alias("ordering"),
        F.when(F.col("id") % 3 == 0, "R0").otherwise(F.concat(F.lit("R"), (F.col("id") % 5).cast("string"))).alias("region")), "title.akas")
    df = QUESTIONS["top_titles_per_region"](Catalog(frames))
    got = [(r.region, r["rank"], r.primaryTitle) for r in df.collect()]
    assert len(got) == 15 and got[0] == ("R0", 1, "tt0") and len({(a, t) for a, _, t in got}) == 15
    exchanges = _region_exchange_rows(df)
    # at most k rows a task and region
    assert exchanges and max(exchanges) <= 3 * 5 * 16, exchanges


def _region_exchange_rows(df):
    """Rows written by the exchanges dealt by region, from the executed plan's metrics."""
    found = []

    def walk(node):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec" and "hashpartitioning(region" in node.outputPartitioning().toString() \
                and "tconst" not in node.outputPartitioning().toString():
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            walk(node.plan())

    walk(df._jdf.queryExecution().executedPlan())
    return found
