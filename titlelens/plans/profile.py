"""Profiling: per-column schema/null profile and numeric summaries.

Each profile is one aggregation pass over the table (partial aggregates
merged map-side), returned as a long-format DataFrame rather than printed,
so profiles of all tables can be unioned, written or queried.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.catalog import TABLES, Catalog
from titlelens.sources.schemas import KEYS

DEFAULT_NUMERIC = ("int", "double", "float")


def numeric_columns(df: DataFrame, types=DEFAULT_NUMERIC, include_decimal: bool = False) -> list[str]:
    """Columns whose simple type name is in ``types`` (bigint and decimal are
    opt-in, as in the original column picker)."""
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in types
            or (include_decimal and f.dataType.simpleString().startswith("decimal"))]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_profile(df: DataFrame, table: str = "") -> DataFrame:
    """One row per column: table, column, position, data_type, nullable,
    row_count, null_count.

    Built as SQL expressions (one global aggregate, then ``stack`` into
    rows) so that a wide table costs two planner calls, not one per column.
    """
    fields = df.schema.fields
    counts = df.selectExpr("count(1) AS row_count",
                           *[f"count_if({_q(f.name)} IS NULL) AS _n{i}" for i, f in enumerate(fields)])
    rows = ", ".join(
        f"{_lit(table)}, {_lit(f.name)}, {i + 1}, {_lit(f.dataType.simpleString())}, "
        f"{'true' if f.nullable else 'false'}, row_count, _n{i}"
        for i, f in enumerate(fields))
    return counts.selectExpr(
        f"stack({len(fields)}, {rows}) AS (table_name, column_name, position, data_type, nullable, "
        f"row_count, null_count)")


def describe_table(df: DataFrame, table: str = "") -> DataFrame:
    """One row: table_name, column_count, row_count and the schema as DDL
    text (the summary part of a schema report; per-column detail is
    ``table_profile``)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), F.lit(len(df.columns)).alias("column_count"), "row_count",
        F.lit(df.schema.toDDL()).alias("schema_ddl"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows as a DataFrame (a bounded LIMIT; nothing is
    collected unless the caller does)."""
    return df.limit(n)


def numeric_stats(df: DataFrame, cols=None, table: str = "") -> DataFrame:
    """count, mean, sample stddev, min and max of numeric columns, one row per
    column (typed, unlike ``describe()`` which returns strings)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        raise ValueError(f"no numeric columns to summarise in {table or 'frame'}")
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c)
        aggs += [f"count({x}) AS _c{i}", f"avg({x}) AS _a{i}", f"stddev_samp({x}) AS _s{i}",
                 f"CAST(min({x}) AS DOUBLE) AS _lo{i}", f"CAST(max({x}) AS DOUBLE) AS _hi{i}"]
    rows = ", ".join(f"{_lit(table)}, {_lit(c)}, _c{i}, _a{i}, _s{i}, _lo{i}, _hi{i}" for i, c in enumerate(cols))
    return df.selectExpr(*aggs).selectExpr(
        f"stack({len(cols)}, {rows}) AS (table_name, column_name, count, mean, stddev, min, max)")


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def column_stats(df: DataFrame, cols=None, table: str = "") -> DataFrame:
    """count, mean, sample stddev, min and max of columns of any type (all
    columns by default), one row per column. Numbers have ``min``/``max`` as
    doubles, other columns have ``min_text``/``max_text`` and no mean or stddev."""
    cols = list(cols) if cols is not None else df.columns
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, rows = [], []
    for i, c in enumerate(cols):
        x = _q(c)
        aggs.append(f"count({x}) AS _c{i}")
        if kinds[c].startswith(_NUMERIC):
            aggs += [f"avg({x}) AS _a{i}", f"stddev_samp({x}) AS _s{i}",
                     f"CAST(min({x}) AS DOUBLE) AS _lo{i}", f"CAST(max({x}) AS DOUBLE) AS _hi{i}"]
            rows.append(f"{_lit(table)}, {_lit(c)}, _c{i}, CAST(_a{i} AS DOUBLE), _s{i}, _lo{i}, _hi{i}, "
                        "CAST(NULL AS STRING), CAST(NULL AS STRING)")
        else:
            aggs += [f"CAST(min({x}) AS STRING) AS _lo{i}", f"CAST(max({x}) AS STRING) AS _hi{i}"]
            rows.append(f"{_lit(table)}, {_lit(c)}, _c{i}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
                        f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), _lo{i}, _hi{i}")
    return df.selectExpr(*aggs).selectExpr(
        f"stack({len(cols)}, {', '.join(rows)}) AS (table_name, column_name, count, mean, stddev, min, max, "
        "min_text, max_text)")


def _tables(cat: Catalog, tables) -> list[tuple[str, DataFrame]]:
    """The catalogue's tables by name: all seven and any extra ones, or those
    asked for. An absent one raises ``MissingTableError``; a profile never
    leaves a table out silently."""
    names = sorted(tables) if tables is not None else sorted({*TABLES, *cat})
    return [(t, cat[t]) for t in names]


def profile_catalog(cat: Catalog, tables=None) -> DataFrame:
    """Union of ``table_profile`` over every table."""
    return reduce(DataFrame.unionByName, [table_profile(df, t) for t, df in _tables(cat, tables)])


def describe_catalog(cat: Catalog, tables=None) -> DataFrame:
    """Union of ``describe_table`` over every table."""
    return reduce(DataFrame.unionByName, [describe_table(df, t) for t, df in _tables(cat, tables)])


def numeric_stats_catalog(cat: Catalog, types=DEFAULT_NUMERIC, tables=None) -> DataFrame:
    """Union of ``numeric_stats`` over the tables that have numeric columns."""
    parts = [numeric_stats(df, numeric_columns(df, types), t) for t, df in _tables(cat, tables)
             if numeric_columns(df, types)]
    return reduce(DataFrame.unionByName, parts)


def column_stats_catalog(cat: Catalog, tables=None) -> DataFrame:
    """Union of ``column_stats`` over every column of every table."""
    return reduce(DataFrame.unionByName, [column_stats(df, None, t) for t, df in _tables(cat, tables)])


def titles_by_type(cat: Catalog) -> DataFrame:
    """Titles by type and their mean rating, asked in SQL over the catalogue's
    registered views."""
    session = cat.title_basics.sparkSession
    cat.register_views()
    return session.sql("""
        SELECT b.titleType, count(*) AS title_count, count(r.tconst) AS rated_count,
               max(r.numVotes) AS most_votes
        FROM title_basics b LEFT JOIN title_ratings r ON b.tconst = r.tconst
        GROUP BY b.titleType""")


def key_violations(cat: Catalog, tables=None) -> DataFrame:
    """Per table: rows with a null key part and key values that occur more
    than once (declared keys are not enforced by file reads). The duplicate
    count is an aggregation on the key, shuffled by the key."""
    parts = []
    for table, df in _tables(cat, tables if tables is not None else TABLES):
        key = [_q(k) for k in KEYS[table]]
        any_null = " OR ".join(f"{k} IS NULL" for k in key)
        per_key = df.groupBy(*KEYS[table]).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.selectExpr(
            f"{_lit(table)} AS table_name",
            f"CAST(coalesce(sum(CASE WHEN {any_null} THEN n END), 0) AS BIGINT) AS null_keys",
            f"count_if(NOT ({any_null}) AND n > 1) AS duplicated_keys",
            f"CAST(coalesce(sum(CASE WHEN NOT ({any_null}) AND n > 1 THEN n END), 0) AS BIGINT) "
            f"AS rows_with_duplicated_keys"))
    return reduce(DataFrame.unionByName, parts)
