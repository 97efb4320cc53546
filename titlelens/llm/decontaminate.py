"""Benchmark decontamination by winnowing, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import ALNUM_WORD, ascii_lower, cut, text_key, words

WINDOW = 13


def _pairs(a: str, gap: int, f: Callable[[Column, Column], Column]) -> Column:
    """``f`` of elements ``gap`` apart; empty if there are none."""
    n = F.greatest(F.size(a) - gap, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + gap), n), f)


def _spread(df: DataFrame, col: str, width: int, f: Callable[[Column, Column], Column]) -> DataFrame:
    """Replaces ``col`` by ``f`` over all runs of ``width`` elements, by doubling; the
    last step lets its two halves overlap, which both a hash of contents and a minimum allow."""
    done = 1
    while done < width:
        gap = min(done, width - done)
        df = df.withColumn(col, _pairs(col, gap, f))
        done += gap
    return df


def fingerprints(df: DataFrame, out: str, words_col: str, span: int) -> DataFrame:
    """Adds the distinct winnowing fingerprints of ``words_col``: hashes of
    k-grams, and of every ``span - k + 1`` consecutive ones the least.  Any
    ``span`` words shared by two texts give both one fingerprint in common."""
    k = (span + 1) // 2
    df = df.withColumn(out, F.transform(words_col, lambda x: F.xxhash64(x)))
    df = _spread(df, out, k, lambda a, b: F.xxhash64(a, b))
    df = _spread(df, out, span - k + 1, lambda a, b: F.least(a, b))
    return df.withColumn(out, F.array_distinct(out))


def _windows(words_col: str, length: Column) -> Column:
    n = F.size(words_col)
    return F.when(n >= length, F.transform(F.sequence(F.lit(0), F.greatest(n - length, F.lit(0))), lambda i: F.struct(
        i.alias("i"), length.alias("len"), F.array_join(F.slice(words_col, i + 1, length), " ").alias("w"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", min_percent: int = 5) -> DataFrame:
    """One row a document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key``.

    A window is 13 consecutive words of an item, or all words of a shorter one.
    Fingerprints guarantee a shared one for every shared window: the span they
    guarantee is the length of the shortest window there is.  Documents that
    share a fingerprint with the benchmark are compared word by word:
    their windows are joined with the items' windows as text, and hits are extended to the
    union of all matching windows.

    Null texts have no words.  Items without id count as hits but are not
    listed.  Rows that share an id are judged by their own text; repeated rows
    give repeated rows.  Without items nothing is hit.
    """
    lowered = lambda c: words(ascii_lower(F.col(c)), ALNUM_WORD)
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), lowered(item_text).alias("words")).where("size(words) > 0")
    # At most 13 different lengths.
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW))).distinct().collect())
    base = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), lowered(text_col).alias("words"))
    base = base.withColumn("n_words", F.size("words").cast("long"))
    if not lengths:
        return _verdict(base.drop("words").withColumns({"n_hit": F.lit(None).cast("long"), "items": F.lit(None).cast("array<string>")}), min_percent)
    found = cut(fingerprints(base, "prints", "words", lengths[0]).drop("words"), "fingerprints")
    # explode() would add a filter on the array; moved below, it would copy the steps of its making many times over.
    of_items = (fingerprints(items, "prints", "words", lengths[0]).select(F.explode_outer("prints").alias("print"))
                .where("print is not null").distinct())
    near = (found.select("doc_id", "text_key", F.explode("prints").alias("print"))
            .join(of_items, "print", "left_semi").select("doc_id", "text_key").distinct())
    # Written first, so that the planner knows their size before it deals out texts; only those of documents with a common fingerprint are compared.
    near = cut(near, "near-documents")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))
    match = [texts["doc_id"].eqNullSafe(near["doc_id"]), texts["text_key"] == near["text_key"]]
    texts = texts.join(near, match, "left_semi").select("doc_id", "text_key", lowered("text").alias("words"))
    all_windows = F.flatten(F.filter(F.array(*(_windows("words", F.lit(n)) for n in lengths)), lambda x: x.isNotNull()))
    in_docs = texts.select("doc_id", "text_key", F.explode(all_windows).alias("x")).select("doc_id", "text_key", "x.*")
    own = F.least(F.size("words"), F.lit(WINDOW))
    in_items = items.select("item", F.explode(_windows("words", own)).alias("x")).select("item", F.col("x.w").alias("w"), F.col("x.len").alias("len")).distinct()
    hits = in_docs.join(in_items, ["w", "len"])
    spans = hits.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct(F.col("i"), (F.col("i") + F.col("len")).alias("end"))).alias("spans"),
        F.collect_set("item").alias("items"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    union = F.aggregate(F.sort_array("spans"), zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["i"], a["end"]))).alias("n")), lambda a: a["n"])
    spans = cut(spans.select("doc_id", "text_key", union.alias("n_hit"), "items"), "hits")
    left = found.select("doc_id", "text_key", "n_words")
    joined = left.join(spans, [left["doc_id"].eqNullSafe(spans["doc_id"]), left["text_key"] == spans["text_key"]], "left")
    return _verdict(joined.select(left["doc_id"], left["text_key"], "n_words", "n_hit", "items"), min_percent)


def _verdict(df: DataFrame, min_percent: int) -> DataFrame:
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return df.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                     F.sha2(F.array_join(F.sort_array(items), ","), 256).alias("items_sha256"),
                     ((n_hit > 0) & (100 * n_hit >= min_percent * F.col("n_words"))).alias("contaminated"), "text_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that ``decontaminate`` does not find contaminated."""
    bad = decontaminate(docs, benchmark, id_col, text_col, **kw).where("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    bad = cut(bad, "contaminated")
    return docs.join(bad, [docs[id_col].eqNullSafe(bad["__id"]), text_key(docs[text_col]) == bad["__key"]], "left_anti")
