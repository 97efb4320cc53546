"""Repeated line runs by prefix doubling over line ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import SPACE_WORD, cut, discard, ordered_sums, salted, text_key

#: Rows of one run beyond which they are dealt out over tasks.
HOT_RUN = 1000


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct documents with their lines (hash, length, words) and the place of the
    first line. Places number all lines in the order of the document ids, null ids last, and
    leave one free behind each document; they are found by range partitions and prefix
    sums, so neither a document nor a range may have too many lines."""
    line = lambda x: F.struct(F.xxhash64(x).alias("h"), F.octet_length(x).alias("size"), F.regexp_count(x, F.lit(SPACE_WORD)).cast("long").alias("words"))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                       F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1), line).alias("lines"))
    rows = rows.dropDuplicates(["doc_id", "text_key"]).select("*", (F.size("lines") + 1).cast("long").alias("n"), F.lit(0).alias("all"))
    placed = ordered_sums(rows, "all", [F.col("doc_id").asc_nulls_last(), F.col("text_key").asc()], ["n"], "lines")
    return placed.select("doc_id", "text_key", "lines", F.col("before_n").alias("place"))


def _shortest_runs(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, width)`` of the shortest runs with ``min_words`` words, one from every line and one up to every line."""
    total = np.concatenate(([0], np.cumsum(words)))
    line = np.arange(len(words))
    end = np.maximum(np.searchsorted(total, total[:-1] + min_words), line + 1)
    start = np.minimum(np.searchsorted(total, total[1:] - min_words, side="right") - 1, line)
    runs = np.concatenate((np.stack((line, end))[:, end <= len(words)], np.stack((start, line + 1))[:, start >= 0]), axis=1)
    start, end = np.unique(runs, axis=1)
    return start, end - start


def repeated_runs(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, n_lines, gone`` (line numbers) of every distinct document.

    A later copy of a run goes, whatever its number of lines, if it has ``min_words`` words.
    Each of its lines lies in the shortest run with these words from its first line, or
    in the shortest one up to the line itself, and both are inside it; so the shortest
    runs from and up to every line that have an earlier copy are all that goes.

    Prefix doubling: the rank of a run of h lines is the place where it first
    starts; the rank of a run of 2h lines comes from the ranks of its halves
    as the least place of their pair.  Places of equal rank are an interval of the suffix
    array with a common prefix of h lines. Runs without a second copy
    leave at each step, so later steps are over repeated runs alone,
    until none is left or no shortest run is as long.  A shortest run of h to 2h - 1 lines is
    known by the ranks of its first and its last h lines.

    Every step is a partial aggregate and an equi-join; a line that a third of all
    documents hold is combined before it is shuffled, and its rows are dealt out over tasks.
    """
    docs_ = _numbered(docs, id_col, text_col)
    lines = docs_.select("place", F.posexplode("lines").alias("line", "x")).select(
        "place", (F.col("place") + F.col("line")).alias("at"), "x.h", "x.size", "x.words")

    def shortest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "at", "width"]
        for batch in batches:
            places, at, width, rows = [], [], [], 0
            counts = batch.column(1)
            for k, place in enumerate(batch.column(0).to_pylist()):
                start, size = _shortest_runs(counts[k].values.to_numpy(zero_copy_only=False), min_words)
                more = size > 1  # runs of one line need no second rank
                at.append(place + start[more])
                width.append(size[more])
                places.append(np.full(len(at[-1]), place))
                rows += len(at[-1])
                if rows > 1_000_000:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in (places, at, width)], names=names)
                    places, at, width, rows = [], [], [], 0
            if rows:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (places, at, width)], names=names)

    windows = cut(docs_.select("place", F.transform("lines", lambda x: x["words"]).alias("words"))
                  .mapInArrow(shortest, "place long, at long, width long"), "shortest-runs")
    widest = windows.agg(F.max("width")).first()[0] or 1
    keys, width, gone, ranked = ["h", "size"], 1, [], None
    runs = lines
    while True:
        first = cut(runs.groupBy(*keys).agg(F.min("at").alias("least"), F.count("*").alias("n")).where("n > 1"), f"repeated-runs-{width}")
        dealt, first = salted(runs, first, keys, F.col("n") > HOT_RUN, f"hot-runs-{width}")
        ranked, before = cut(dealt.join(first, [*keys, "__salt"]).select("at", F.col("least").alias("rank"), *["place", "words"] * (width == 1)), f"runs-{width}"), ranked
        if width > 2:
            discard(before)
        if not ranked.limit(1).count():
            break
        if width == 1:
            gone.append(ranked.where((F.col("rank") < F.col("at")) & (F.col("words") >= min_words)).select("place", "at", F.lit(1).cast("long").alias("width")))
        else:
            last = ranked.select(F.col("at").alias("last"), F.col("rank").alias("rank_last"))
            here = (windows.where(F.col("width").between(width, 2 * width - 1)).join(ranked, "at")
                    .withColumn("last", F.col("at") + F.col("width") - width).join(last, "last"))
            here = cut(here.select("place", "at", "width", "rank", "rank_last"), f"shortest-runs-{width}")
            same = ["width", "rank", "rank_last"]
            least = cut(here.groupBy(*same).agg(F.min("at").alias("least"), F.max("at").alias("most"), F.count("*").alias("n")).where("least < most"), f"copied-runs-{width}")
            dealt, least = salted(here, least, same, F.col("n") > HOT_RUN, f"hot-copies-{width}")
            gone.append(dealt.join(least, [*same, "__salt"]).where("least < at").select("place", "at", "width"))
        if 2 * width > widest:
            break
        # Places of one document are consecutive, and between two documents lies a place that no line has.
        after = ranked.select((F.col("at") - width).alias("at"), F.col("rank").alias("rank_after"))
        runs = ranked.select("at", "rank").join(after, "at").select("at", "rank", "rank_after")
        keys, width = ["rank", "rank_after"], 2 * width
    base = docs_.select("doc_id", "text_key", "place", F.size("lines").cast("long").alias("n_lines"))
    if not gone:
        return base.select("doc_id", "text_key", "n_lines", F.array().cast("array<bigint>").alias("gone"))
    spans = gone[0]
    for more in gone[1:]:
        spans = spans.unionByName(more)
    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column(1):
                start, size = (spans.values.field(k).to_numpy() for k in range(2))
                step = np.zeros(int((start + size).max()) + 1, np.int64)
                np.add.at(step, start, 1)
                np.add.at(step, start + size, -1)
                out.append(np.flatnonzero(np.cumsum(step)))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["place", "gone"])

    by_doc = (spans.groupBy("place").agg(F.collect_list(F.struct((F.col("at") - F.col("place")).alias("start"), "width")).alias("spans"))
              .mapInArrow(covered, "place long, gone array<bigint>"))
    return base.join(by_doc, "place", "left").select(
        "doc_id", "text_key", "n_lines", F.coalesce("gone", F.array().cast("array<bigint>")).alias("gone"))


def remove_line_runs(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later copies of repeated line runs taken out of the
    text, which keeps its other lines in order; all other columns as they are.

    A text without such a run is left as it is, null included.  Documents come in the
    order of their ids, null ids last, texts of one id by their hash; rows of one id and
    text are one document and get the same text.  Lines are compared
    by a 64-bit hash and their length.  An empty table stays empty.
    """
    found = repeated_runs(docs, min_words, id_col, text_col).where("size(gone) > 0").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("gone").alias("__gone"))
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), F.col(id_col).alias("__i"),
                      text_key(F.col(text_col)).alias("__k"), F.split(F.col(text_col), "\n", -1).alias("__lines"))
    joined = row.join(found, [row["__i"].eqNullSafe(found["__id"]), row["__k"] == found["__key"]], "left")
    stay = F.array_except(F.sequence(F.lit(0).cast("long"), F.size("__lines").cast("long") - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col(f"__row.{text_col}")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("__lines", i.cast("int"))), "\n"))
    return joined.select(F.col("__row").withField(text_col, text).alias("__row")).select("__row.*")


def line_report(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, the number of its lines, ``n_lines``, and of what
    ``remove_line_runs`` leaves of it the lines, characters and hash: ``n_lines_left,
    n_chars_left, kept_sha256``.  A null text has one line, an empty one, and stays."""
    left = remove_line_runs(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                                        F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).cast("long").alias("n_lines")), min_words)
    kept = F.coalesce("text", F.lit(""))
    n_left = F.when(F.col("text").isNull(), 1).otherwise(F.size(F.split(kept, "\n", -1))).cast("long")
    return left.select("doc_id", "n_lines", n_left.alias("n_lines_left"), F.char_length(kept).cast("long").alias("n_chars_left"),
                       F.sha2(kept, 256).alias("kept_sha256"))
