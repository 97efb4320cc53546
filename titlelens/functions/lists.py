"""Multi-value columns: comma-delimited strings such as ``genres``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = ","


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c, sep: str = SEP) -> Column:
    """``'a,b'`` -> ``['a', 'b']``; null stays null, ``''`` -> ``['']``."""
    return F.split(_col(c), sep)


def first_listed(c, sep: str = SEP) -> Column:
    """First element of a delimited list, i.e. ``split(c)[0]`` without
    building the array (never out of range: ``''`` -> ``''``)."""
    return F.substring_index(_col(c), sep, 1)


def json_list(c) -> Column:
    """The members of a JSON list of texts, ``'["a","b"]'`` -> ``['a', 'b']``; other
    members become text, JSON null a null. Null for null and for all that is no JSON list: torn
    or trailing text, objects, bare values, an empty text."""
    text = F.btrim(_col(c), F.lit(" \t\r\n"))
    return F.when(text.startswith("[") & text.endswith("]"), F.from_json(text, "array<string>"))


def explode_list(df: DataFrame, column: str, alias: str, sep: str = SEP, keep=None) -> DataFrame:
    """One row per list element (inner explode: null lists produce no rows).

    ``keep`` restricts the output to those columns plus ``alias``; explode as
    late as possible so that joins and shuffles carry the unexploded rows.
    """
    cols = [F.col(c) for c in (keep if keep is not None else [c for c in df.columns if c != alias])]
    return df.select(*cols, F.explode(split_list(column, sep)).alias(alias))
