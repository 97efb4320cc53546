"""Explicit schemas of the seven catalogue tables.

Multi-value columns (``genres``, ``directors``, ``writers``,
``primaryProfession``, ``knownForTitles``, ``types``, ``attributes``) stay
comma-delimited strings at the boundary; questions split them once with
``titlelens.functions.lists``. ``averageRating`` is single precision, as in
the public dumps. Keys are declared nullable because file reads never
enforce nullability; ``titlelens.plans.profile.key_violations`` checks them.
"""

from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType


def _schema(*cols):
    return StructType([StructField(name, dtype, True) for name, dtype in cols])


S, I, F32 = StringType(), IntegerType(), FloatType()

SCHEMAS = {
    "name.basics": _schema(
        ("nconst", S), ("primaryName", S), ("birthYear", I), ("deathYear", I),
        ("primaryProfession", S), ("knownForTitles", S)),
    "title.akas": _schema(
        ("titleId", S), ("ordering", I), ("title", S), ("region", S), ("language", S),
        ("types", S), ("attributes", S), ("isOriginalTitle", I)),
    "title.basics": _schema(
        ("tconst", S), ("titleType", S), ("primaryTitle", S), ("originalTitle", S),
        ("isAdult", I), ("startYear", I), ("endYear", I), ("runtimeMinutes", I), ("genres", S)),
    "title.crew": _schema(("tconst", S), ("directors", S), ("writers", S)),
    "title.episode": _schema(
        ("tconst", S), ("parentTconst", S), ("seasonNumber", I), ("episodeNumber", I)),
    "title.principals": _schema(
        ("tconst", S), ("ordering", I), ("nconst", S), ("category", S), ("job", S),
        ("characters", S)),
    "title.ratings": _schema(("tconst", S), ("averageRating", F32), ("numVotes", I)),
}

# Primary key of each table (checked, not enforced).
KEYS = {
    "name.basics": ("nconst",),
    "title.akas": ("titleId", "ordering"),
    "title.basics": ("tconst",),
    "title.crew": ("tconst",),
    "title.episode": ("tconst",),
    "title.principals": ("tconst", "ordering"),
    "title.ratings": ("tconst",),
}
