"""Questions over the characters of a credit, a JSON list kept as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.functions import json_list
from titlelens.operators import lookup_bounded, top_n
from titlelens.plans.common import count_rows


def _credits(cat: Catalog) -> DataFrame:
    return cat.title_principals.select("tconst", "ordering", "nconst", "category", "characters", json_list("characters").alias("names"))


def _malformed():
    return F.col("characters").isNotNull() & F.col("names").isNull()


def malformed_character_lists(cat: Catalog) -> DataFrame:
    """The credits whose characters are no JSON list, as they came."""
    return _credits(cat).where(_malformed()).drop("names")


def character_list_quality(cat: Catalog) -> DataFrame:
    """Per category (null is one): credits without characters, with text that is no JSON list, with an
    empty list and with a list, every credit once, and how many different characters these name."""
    credits = _credits(cat).select("category", "characters", "names")
    counts = credits.groupBy("category").agg(
        count_rows("credit_count"), F.count_if(F.col("characters").isNull()).alias("missing"), F.count_if(_malformed()).alias("malformed"),
        F.count_if(F.size("names") == 0).alias("empty"), F.count_if(F.size("names") > 0).alias("listed"))
    named = credits.select("category", F.explode("names").alias("name")).groupBy("category", "name").agg(F.lit(1).alias("one"))
    distinct = named.groupBy(F.col("category").alias("of")).agg(F.count("name").alias("distinct_characters"))
    return counts.join(distinct, F.col("category").eqNullSafe(F.col("of")), "left").select(
        *counts.columns, F.coalesce("distinct_characters", F.lit(0)).alias("distinct_characters"))


def people_by_characters(cat: Catalog, n: int = 20) -> DataFrame:
    """People with the most different characters, and in how many parts they play them (a credit has
    a part for each member of its list; null and empty names are none). Ties: parts, nconst.

    Counted by (person, character) first: a person with very many parts is a row a character."""
    parts = _credits(cat).select("nconst", F.explode("names").alias("name")).where(F.col("name") != "")
    per = parts.groupBy("nconst", "name").agg(count_rows("parts")).groupBy("nconst").agg(
        count_rows("character_count"), F.sum("parts").alias("part_count"))
    order = [F.desc("character_count"), F.desc("part_count"), F.asc_nulls_first("nconst")]
    named = lookup_bounded(top_n(per, n, *order), cat.name_basics.select("nconst", "primaryName"), "nconst", "nconst")
    return named.orderBy(*order).select("nconst", "primaryName", "character_count", "part_count")
