"""Host-level quality rules: documents are measured, rule failures are counted
by host, host rates are shrunk with a beta prior fitted to all hosts, and the
hosts' verdicts are joined back to their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import SPACE_WORD, cut, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
#: A host is flagged on a rule when its shrunken failure rate is above this.
HOST_RATE = 0.5
#: Weight of the prior, in documents, where all hosts have the same rate, and the least weight of any:
#: where hosts fail as a whole or not at all, the fit would give none.
FLAT_PRIOR, LEAST_PRIOR = 100.0, 1.0

# Rules that a document can fail; all but the first two count only where the host is flagged on them.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}


def measure(docs: DataFrame, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` and the measures of each whole text, computed row by row.

    Windows of three words are compared by 64-bit hashes within one document.
    A sort of (hash, position) pairs, made only for documents in which some
    window repeats, gives the positions of repeated windows; a word between
    two of them counts once.  A null text has no words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(*(keep or []), text.alias("__t"), words(F.col(text_col), SPACE_WORD).alias("__w"))
    kept = [F.col(c) for c in df.columns[:-2]]
    has_word = lambda line: line.rlike(SPACE_WORD)
    df = df.select(
        *kept,
        F.size("__w").cast("long").alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("__t", "\n"), has_word).alias("__l"),
        F.transform("__w", lambda x: F.xxhash64(x)).alias("__h"))
    window = F.when(F.size("__h") >= 3, F.transform(
        F.slice("__h", F.lit(3), F.greatest(F.size("__h") - 2, F.lit(0))),
        lambda x, i: F.xxhash64(F.get("__h", i), F.get("__h", i + 1), x)))
    plain = ["n_words", "word_chars", "n_symbols"]
    df = df.select(*kept, *plain, F.size("__l").cast("long").alias("n_lines"),
                   (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                   window.alias("__g"))
    plain += ["n_lines", "n_dup_lines"]
    pairs = F.when(F.size(F.array_distinct("__g")) < F.size("__g"),
                   F.sort_array(F.transform("__g", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    df = df.select(*kept, *plain, pairs.alias("__s"))
    same = lambda e, k: F.get("__s", k).getField("h").eqNullSafe(e.getField("h"))
    again = F.filter("__s", lambda e, k: same(e, k - 1) | same(e, k + 1))
    df = df.select(*kept, *plain, F.sort_array(F.transform(again, lambda e: e.getField("i"))).alias("__p"))
    covered = F.aggregate(
        F.transform("__p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("__p", k + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.select(*kept, *plain, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))
    return df.withColumn("base_failed", F.expr(f"({RULES['short']}) or ({RULES['repeats']})"))


def host_verdicts(measured: DataFrame, host: str) -> DataFrame:
    """``host, n_docs``, and for every rule its failures, shrunken rate and flag;
    one row a host, null hosts left out.

    The beta prior of a rule is fitted by moments to the failure rates of all
    hosts (mean ``m`` and variance ``v``: weight ``m (1 - m) / v - 1``, at least
    ``LEAST_PRIOR``, and ``FLAT_PRIOR`` if ``v`` is 0), so a host with few documents stays
    near the mean and one with many keeps its own rate; the more hosts differ, the less a host is drawn to the mean.
    """
    hosts = measured.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("n_docs"), *(F.sum(F.expr(rule).cast("long")).alias(f"{r}_failed") for r, rule in RULES.items()))
    hosts = cut(hosts, "hosts")
    rates = {r: F.col(f"{r}_failed") / F.col("n_docs") for r in RULES}
    # One row of ten numbers.
    prior = hosts.agg(*(f(rate).alias(f"{k}_{r}") for r, rate in rates.items()
                        for k, f in (("m", F.avg), ("v", F.var_pop)))).first()
    out = hosts
    for r in RULES:
        m, v = prior[f"m_{r}"] or 0.0, prior[f"v_{r}"] or 0.0
        weight = max(m * (1 - m) / v - 1, LEAST_PRIOR) if v > 0 else FLAT_PRIOR
        out = out.withColumn(f"{r}_rate", (F.col(f"{r}_failed") + m * weight) / (F.col("n_docs") + weight))
        out = out.withColumn(f"{r}_flag", F.col(f"{r}_rate") > HOST_RATE)
    return out


def _judge(measured: DataFrame, host: str) -> DataFrame:
    """Adds ``kept``: false if a base rule fails, or if the document fails a
    rule on which its host is flagged.  Clean documents of a flagged host
    stay.  Only flagged hosts are joined back."""
    flags = [f"{r}_flag" for r in RULES]
    verdicts = host_verdicts(measured, host).where(" or ".join(flags)).select(F.col(host).alias("__host"), *flags)
    fails = F.lit(False)
    for r, rule in RULES.items():
        fails = fails | (F.expr(rule) & F.coalesce(F.col(f"{r}_flag"), F.lit(False)))
    joined = measured.join(verdicts, measured[host] == verdicts["__host"], "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~fails)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row a document: its id, the measures, ``base_failed`` and ``kept``.

    Null ids stay null; a null text has no words and fails; a document without
    host is judged by the base rules alone; repeated rows count as often as
    they occur; an empty table gives an empty result.
    """
    keep = [F.col(id_col).alias("doc_id"), F.col(host_col).alias("__source")]
    measured = cut(measure(docs, text_col, keep), "measured")
    return _judge(measured, "__source").select("doc_id", *MEASURES, "kept")


def quality_filter(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``quality_report`` keeps, with the columns of ``docs``
    (carried as one struct, so that their names cannot clash with the measures)."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    measured = cut(measure(docs, text_col, [row, F.col(host_col).alias("__source")]), "measured")
    return _judge(measured, "__source").where("kept").select("__row.*")
