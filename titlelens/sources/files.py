"""File sources for the catalogue.

``read_table`` reads one public-dump style TSV file (tab separated, header
row, ``\\N`` as null). The dialect has no quoting, so quoting is off by
default: with Spark's default quote character a cell that starts with ``"``
and is never closed swallows the following tabs. Pass ``quote='"'`` to get
that behaviour back.

Paths are Hadoop URIs (local, HDFS, object stores); existence is checked by
Spark, not by the local file system. Gzipped dumps (``.tsv.gz``) are read
directly, but gzip is not splittable: convert the catalogue to Parquet once
with ``write_catalog`` and query that, which also gives column pruning and
predicate pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from titlelens.catalog import TABLES, Catalog
from titlelens.sources.schemas import SCHEMAS

_SUFFIX = {"tsv": ".tsv", "parquet": ".parquet"}


def table_path(path: str, table: str, fmt: str = "tsv", suffix: str | None = None) -> str:
    return f"{path.rstrip('/')}/{table}{_SUFFIX[fmt] if suffix is None else suffix}"


def read_table(spark: SparkSession, path: str, table: str, schema: StructType | None = None,
               fmt: str = "tsv", quote: str = "", suffix: str | None = None,
               infer: bool = False) -> DataFrame:
    """Lazily read one catalogue table.

    ``schema`` defaults to the declared schema of ``table`` when it is one
    of the seven known names; ``infer=True`` (or an unknown name with no
    schema) falls back to schema inference, as a last resort.
    Unparsable numbers become null (Spark's PERMISSIVE mode).
    """
    if schema is None and not infer:
        schema = SCHEMAS.get(table)
    location = table_path(path, table, fmt, suffix)
    if fmt == "parquet":
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(location)
    if fmt != "tsv":
        raise ValueError(f"unsupported catalogue format {fmt!r}")
    reader = (spark.read.option("sep", "\t").option("header", "true")
              .option("nullValue", "\\N").option("quote", quote)
              .option("mode", "PERMISSIVE"))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(location)


def read_catalog(spark: SparkSession, path: str, fmt: str = "tsv", quote: str = "",
                 tables=TABLES, strict: bool = False, suffix: str | None = None,
                 schemas: dict | None = None, infer: bool = False) -> Catalog:
    """Read the seven tables. Tables whose files are missing are recorded in
    ``Catalog.missing`` (or raise immediately with ``strict=True``); a
    question that needs one fails with a message naming it.

    ``schemas`` overrides the declared schema per table name; ``infer=True``
    infers the schema of every table without an override (an extra pass
    over each file; declared schemas are the default)."""
    frames, missing = {}, {}
    for table in tables:
        try:
            schema = (schemas or {}).get(table)
            df = read_table(spark, path, table, schema=schema, fmt=fmt, quote=quote, suffix=suffix,
                            infer=infer and schema is None)
            df.schema  # resolves the path now, so a missing file is reported here
            frames[table] = df
        except AnalysisException as exc:
            # Only an absent path is a missing table; anything else (format, permission, schema) is an error.
            if strict or exc.getCondition() != "PATH_NOT_FOUND":
                raise
            missing[table] = str(exc).splitlines()[0]
    return Catalog(frames, missing)


def write_catalog(catalog: Catalog, path: str, mode: str = "overwrite",
                  partitions: int | None = None) -> None:
    """Store every table as Parquet under ``path`` (one directory per table).

    With ``partitions`` each table is range-partitioned on its key into that
    many files (a one-time shuffle), so file and row-group min/max
    statistics cover disjoint key ranges and key predicates prune them.
    Without it the input partitioning is kept and rows are only sorted by
    key inside each file.
    """
    from titlelens.sources.schemas import KEYS
    for table, df in catalog.items():
        key = KEYS.get(table, ())  # an extra table has no declared key
        out = df.repartitionByRange(partitions, *(key or df.columns[:1])) if partitions else df
        out = out.sortWithinPartitions(*key) if key else out
        out.write.mode(mode).parquet(table_path(path, table, "parquet"))


def register_views(catalog: Catalog) -> list[str]:
    """Register every loaded table as a temp view (``title.basics`` ->
    ``title_basics``) so the catalogue can be queried with ``spark.sql``."""
    return catalog.register_views()


def conform_table(df: DataFrame, table: str) -> DataFrame:
    """Declared columns, in declared order, with declared types: values that
    do not convert become null (``try_cast``, as a permissive TSV read does),
    absent columns are null. Use for inferred schemas or catalogues written
    by other tools; questions assume declared types (under ANSI mode a text
    year compared with a number would otherwise raise on a bad value)."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in SCHEMAS[table].fields])


def conform_catalog(catalog: Catalog) -> Catalog:
    """``conform_table`` applied to every loaded table."""
    return Catalog({t: conform_table(df, t) for t, df in catalog.items()}, catalog.missing)
