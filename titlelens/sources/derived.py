"""Deterministic title catalogue derived from TPC-H-style tables.

Used by tests, the benchmark and the driver contract: it turns ``orders``,
``lineitem``, ``customer``, ``supplier`` and ``nation`` into the seven
catalogue tables with integer arithmetic only, so the same derivation can be
written in any SQL dialect (see ``titlelens.oracle``). Every row of the
catalogue is a narrow projection of a source row, so the derivation scales
with the source tables; the only join is lineitem -> supplier -> nation
(akas); crew uses the customer count as a scalar subquery.

``k`` is ``o_orderkey``, ``c`` is ``c_custkey``, ``nc`` is the customer count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.sources.schemas import SCHEMAS

# Fixed values of the derivation (lists are picked from by index).
TITLE_TYPES = "movie,movie,tvSeries,tvEpisode,short"
GENRES = "Drama,Comedy,Action,Horror,Romance,Thriller,Documentary,Western"
CATEGORIES = "actor,actress,director,writer,producer"
LANGUAGES = "en,fr,de,ja,hi,es"
PROFESSIONS = ("actor,producer", "actress", "director,writer", None)  # by c % 4
DANGLING_TITLE = "tt999999999"


def pick(values: str, index: Column) -> Column:
    """Zero-based element of a comma-separated literal list."""
    return F.split_part(F.lit(values), F.lit(","), (index + 1).cast("int"))


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns in declared order with declared types."""
    cols = {c: F.col(c) for c in df.columns}
    return df.select(*[
        (cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SCHEMAS[table].fields
    ])


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def title_basics(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    g0, g1, g2 = pick(GENRES, k % 8), pick(GENRES, (k + 3) % 8), pick(GENRES, (k + 5) % 8)
    return _conform(orders.select(
        _id("tt", k).alias("tconst"),
        pick(TITLE_TYPES, k % 5).alias("titleType"),
        F.when(k % 2 == 0, _id("Title ", k % 700)).otherwise(_id("Title ", k % 1000000000))
         .alias("primaryTitle"),
        _id("Original ", k).alias("originalTitle"),
        F.when(k % 53 == 0, None).when(k % 17 == 0, 1).otherwise(0).alias("isAdult"),
        F.when(k % 41 == 0, None).otherwise(1900 + k % 126).alias("startYear"),
        F.when(k % 23 == 0, None).when(k % 31 == 0, 0).otherwise(40 + k % 140)
         .alias("runtimeMinutes"),
        F.when(k % 29 == 0, None).when(k % 3 == 0, g0)
         .when(k % 3 == 1, F.concat_ws(",", g0, g1))
         .otherwise(F.concat_ws(",", g0, g1, g2)).alias("genres"),
    ), "title.basics")


def title_ratings(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return _conform(orders.where(k % 10 != 9).select(
        _id("tt", k).alias("tconst"),
        (F.lit(1.0) + ((k * 7) % 91).cast("double") / 10).cast("float").alias("averageRating"),
        F.floor("o_totalprice").cast("int").alias("numVotes"),
    ), "title.ratings")


def title_crew(orders: DataFrame, customer: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    # Uncorrelated scalar subquery: evaluated once, then a constant in every task.
    nc = customer.agg(F.count(F.lit(1))).scalar()
    directors = (F.when(k % 37 == 0, None)
                 .when(k % 4 == 1, F.concat(_id("nm", c), F.lit(","), _id("nm", (c * 7 + 3) % nc)))
                 .otherwise(_id("nm", c)))
    writers = (F.when(k % 19 == 0, None)
               .when(k % 4 == 2, F.concat(_id("nm", (c + 1) % nc), F.lit(","), _id("nm", (c + 2) % nc)))
               .otherwise(_id("nm", (c + k % 2) % nc)))
    return _conform(orders.select(_id("tt", k).alias("tconst"), directors.alias("directors"),
                                  writers.alias("writers")), "title.crew")


def title_episode(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return _conform(orders.where(k % 5 == 3).select(
        _id("tt", k).alias("tconst"),
        _id("tt", k - k % 100 + 2).alias("parentTconst"),
        F.when(k % 47 == 0, None).otherwise(1 + (k % 100 - k % 25) % 4).alias("seasonNumber"),
        (k % 25).alias("episodeNumber"),
    ), "title.episode")


def title_principals(lineitem: DataFrame) -> DataFrame:
    s, k, p = F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_partkey")
    role = F.concat(F.lit('["Role '), (k % 300).cast("string"), F.lit('"'))
    characters = (F.when(p % 5 == 0, None).when(k % 43 == 0, role).when(k % 29 == 0, "[]")
                  .when(k % 3 == 0, F.concat(role, F.lit(',"Self"]'))).otherwise(F.concat(role, F.lit("]"))))
    return _conform(lineitem.select(
        _id("tt", F.col("l_orderkey")).alias("tconst"),
        F.col("l_linenumber").alias("ordering"),
        _id("nm", F.col("l_partkey")).alias("nconst"),
        F.when(s % 13 == 0, None).otherwise(pick(CATEGORIES, s % 5)).alias("category"),
        characters.alias("characters"),
    ), "title.principals")


def title_akas(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    p = F.col("l_partkey")
    # nation has 25 rows by definition: a fixed-size broadcast. The supplier
    # side grows with the data, so its join strategy is left to the planner.
    supplier_nation = supplier.join(
        F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey).select("s_suppkey", "n_name")
    joined = lineitem.join(supplier_nation, lineitem.l_suppkey == supplier_nation.s_suppkey)
    return _conform(joined.select(
        _id("tt", F.col("l_orderkey")).alias("titleId"),
        F.col("l_linenumber").alias("ordering"),
        _id("Aka ", F.col("l_orderkey")).alias("title"),
        F.when(p % 9 == 0, None).otherwise(F.col("n_name")).alias("region"),
        F.when(p % 11 == 0, None).otherwise(pick(LANGUAGES, p % 6)).alias("language"),
        # 0 for every row; written against a source column so that the
        # column stays nullable like every column read from a file.
        F.when(F.col("l_orderkey").isNotNull(), F.lit(0)).alias("isOriginalTitle"),
    ), "title.akas")


def name_basics(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    profession = F.when(c % 4 == 0, PROFESSIONS[0]).when(c % 4 == 1, PROFESSIONS[1]) \
        .when(c % 4 == 2, PROFESSIONS[2]).otherwise(F.lit(PROFESSIONS[3]))
    known = (F.when(c % 13 == 0, None)
             .when(c % 7 == 0, F.concat(_id("tt", c % 60), F.lit("," + DANGLING_TITLE)))
             .otherwise(F.concat(_id("tt", c % 60), F.lit(","), _id("tt", c % 45))))
    return _conform(customer.select(
        _id("nm", c).alias("nconst"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), (c % 40).cast("string")).alias("primaryName"),
        profession.alias("primaryProfession"),
        known.alias("knownForTitles"),
    ), "name.basics")


# (id(session), dir) -> (session, catalogue). Holding the session keeps its
# id from being reused by another object while the entry exists.
_DERIVED: dict[tuple[int, str], tuple[SparkSession, Catalog]] = {}


def _alive(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jsc is not None
    except Exception:
        return False


def derive_catalog(spark: SparkSession, sf_dir: str, reuse: bool = False) -> Catalog:
    """Lazily derive the seven catalogue tables from ``sf_dir/*.parquet``.

    Tables are planned on first use. With ``reuse`` the catalogue (plans
    and file listings, no data) is shared by calls with the same session and
    directory, which then do not see files added later; off by default.
    """
    key = (id(spark), sf_dir.rstrip("/"))
    if reuse and key in _DERIVED:
        owner, cat = _DERIVED[key]
        if owner is spark and _alive(spark):
            return cat
        del _DERIVED[key]
    sources: dict[str, DataFrame] = {}

    def src(name: str, *cols: str):
        def get() -> DataFrame:
            if name not in sources:
                sources[name] = _read(spark, sf_dir, name, *cols)
            return sources[name]
        return get

    orders = src("orders", "o_orderkey", "o_custkey", "o_totalprice")
    lineitem = src("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    customer = src("customer", "c_custkey", "c_mktsegment")
    supplier = src("supplier", "s_suppkey", "s_nationkey")
    nation = src("nation", "n_nationkey", "n_name")
    cat = Catalog({
        "title.basics": lambda: title_basics(orders()),
        "title.ratings": lambda: title_ratings(orders()),
        "title.crew": lambda: title_crew(orders(), customer()),
        "title.episode": lambda: title_episode(orders()),
        "title.principals": lambda: title_principals(lineitem()),
        "title.akas": lambda: title_akas(lineitem(), supplier(), nation()),
        "name.basics": lambda: name_basics(customer()),
    })
    if reuse:
        _DERIVED[key] = (spark, cat)
    return cat
