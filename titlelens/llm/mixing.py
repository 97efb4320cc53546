"""Mixing of sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import SPACE_WORD, cut, ordered_sums, text_key

#: A source gives at most this many times its size.
EPOCHS = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)


def text_quality(text: Column, size: Column) -> Column:
    """Quality weight of a document: long enough texts with words of usual length come first."""
    mean = F.char_length(text) / F.greatest(size, F.lit(1))
    return F.when((size < 50) | (mean < 3) | (mean > 16), 0.25).when((mean < 4.5) | (mean > 10), 0.5).otherwise(1.0)


def source_targets(sources: DataFrame, share: float = 1.0, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from one row a source (``source, source_size``).

    Sources in order of their code points, null last, weigh ``weights`` in turn and
    share ``share`` of all sizes.  A target stops at ``epochs`` times its source's size and
    its excess goes to the others by weight.  All targets are then ``min(cap, level *
    weight)`` for one level; sources in order of cap per weight, with what those
    before them took and weigh, tell each whether it is capped.  No source is
    compared with another, so their number does not matter.
    """
    one = sources.select("source", "source_size", F.lit(1).cast("long").alias("n"), F.lit(0).alias("__all"))
    placed = ordered_sums(one, "__all", [F.col("source").asc_nulls_last()], ["n"], "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before_n") % len(weights) + 1).cast("int")).cast("long")
    placed = placed.select("__all", "source", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).alias("cap"))
    level = placed.select("*", (F.col("cap") / F.col("weight")).alias("full_at"))
    filled = ordered_sums(level, "__all", [F.col("full_at").asc(), F.col("source").asc_nulls_last()], ["weight", "cap", "source_size"], "levels")
    rest = F.col("all_source_size") * F.lit(share) - F.col("before_cap")
    here = rest / (F.col("all_weight") - F.col("before_weight"))  # the level if all before are capped and this one is not
    filled = cut(filled.select("__all", "source", "source_size", "weight", "cap", "full_at", here.alias("here")), "filled")
    # The first source that is not capped tells the level of all.
    open_ = filled.where("here < full_at").agg(F.min(F.struct("full_at", F.col("source").isNull().alias("last"), "source", "here")).alias("x")).first()["x"]
    target = F.col("cap").cast("double")
    if open_ is not None:
        target = F.when(F.col("full_at") > F.lit(open_["here"]), F.lit(open_["here"]) * F.col("weight")).otherwise(target)
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, share: float = 1.0, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS, quality: Column | None = None,
        whole: bool = False, seed: int = 13, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: ``doc_id, size`` (its words), ``source_size, target`` (of its
    source), ``taken`` (words that the mix takes of it, repeats counted), ``source``.

    A source is taken as a whole as often as its target allows.  What is left of the
    target is filled with documents in order of ``-ln(u) / weight``, ``u`` a uniform number that follows from
    seed, id and text, ``weight`` the document's ``quality`` (by default ``text_quality``, not
    positive or null: last): the keys of a weighted sample without replacement.  Sizes are summed in
    that order, and the document at the budget's end gives the words that are still wanted;
    with ``whole`` it is taken or left, whichever is nearer.

    Keys are sorted by ranges, so a source may hold any share of all rows.  Null texts have no
    words; a null source is one source, the last; null ids and repeated rows are documents of their own; an empty
    table gives no row.  A rerun, with any partitioning, takes the same.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.regexp_count(text, F.lit(SPACE_WORD)).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
                       text_key(F.col(text_col)).alias("text_key"), *([] if quality is None else [quality.cast("double").alias("quality")]),
                       *([text.alias("text")] if quality is None else []))
    if quality is None:
        rows = rows.select("doc_id", "source", "size", "text_key", text_quality(F.col("text"), F.col("size")).alias("quality"))
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), F.coalesce("doc_id", F.lit(-1)), "text_key"), 11) + 0.5) / F.lit(float(1 << 53))
    key = F.when(F.col("quality") > 0, -F.log(draw) / F.col("quality")).otherwise(F.lit(float("inf")))
    rows = cut(rows.select("doc_id", "source", "size", "text_key", key.alias("key")), "sizes")
    sources = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    facts = source_targets(sources, share, epochs, weights)
    order = [F.col("key").asc(), F.col("doc_id").asc_nulls_last(), F.col("text_key").asc()]
    placed = ordered_sums(rows, "source", order, ["size"], "mixed", facts)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = F.greatest(F.round(F.col("target")).cast("long") - times * F.col("source_size"), F.lit(0))
    left = budget - F.col("before_size")
    if whole:
        part = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(0)
    else:
        part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.select("doc_id", "size", "source_size", "target", (times * F.col("size") + part).alias("taken"), "source")
