"""Two collections of rows compared as multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each distinct row of both with ``n_old`` and ``n_new``, how often it occurs in either.
    Nulls are equal to each other. One shuffle of rows already counted in their
    task: ``EXCEPT ALL`` and ``INTERSECT ALL`` either way follow from the two counts."""
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    side = lambda df, o, n: df.select("*", F.lit(o).cast("long").alias("__old"), F.lit(n).cast("long").alias("__new"))
    both = side(old, 1, 0).unionByName(side(new, 0, 1))
    return both.groupBy(*old.columns).agg(F.sum("__old").alias("n_old"), F.sum("__new").alias("n_new"))


def compare_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each of ``keys`` in either: ``old_rows``, ``new_rows``, ``common_rows``
    (the size of their ``INTERSECT ALL``), ``only_old`` and ``only_new`` (of their ``EXCEPT ALL``) and
    ``status``: ``added`` or ``removed`` if one side has no row, ``same`` if they are equal multisets,
    ``recounted`` if only the numbers of copies differ, else ``changed``. Null keys are one key.

    Both aggregates are partial in their task, so a key with very many rows is one row a task."""
    rows = multiset_counts(old, new)
    common = F.least("n_old", "n_new")
    per = rows.groupBy(*keys).agg(F.sum("n_old").alias("old_rows"), F.sum("n_new").alias("new_rows"), F.sum(common).alias("common_rows"),
                                  F.sum(F.col("n_old") - common).alias("only_old"), F.sum(F.col("n_new") - common).alias("only_new"),
                                  F.max((F.col("n_old") == 0) | (F.col("n_new") == 0)).alias("__alone"))
    status = (F.when(F.col("old_rows") == 0, "added").when(F.col("new_rows") == 0, "removed").when(F.col("__alone"), "changed")
              .when(F.col("only_old") + F.col("only_new") > 0, "recounted").otherwise("same"))
    return per.withColumn("status", status).drop("__alone")
