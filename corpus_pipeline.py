"""Corpus pipeline over ``documents``: quality rules, line dedup, one document of
each group of near copies, benchmark decontamination, packed token sequences.

Every stage takes ``(spark, docs, sf_dir)``, works on all that the stage before
kept, and but for the last returns the columns of ``documents``.  ``run`` writes what
a stage returns to the shared folder and reads it back, so a lost executor
costs a re-read.  A stage first deletes the tables of earlier work that no
DataFrame reads any more.  Null, empty and repeated rows are handled as the
operators' docstrings say; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.llm.common import cut, sweep
from titlelens.llm.queries import table, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that fail a base rule, or a rule on which their host is flagged, go."""
    from titlelens.llm.quality import quality_filter

    sweep(spark)
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: later copies of repeated line runs are cut from the texts;
    a document of which nothing is left goes."""
    from titlelens.llm.line_dedup import remove_line_runs

    sweep(spark)
    left = remove_line_runs(docs).where(F.col("text") != "")
    return left.withColumn("n_chars", F.char_length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3, on five-word shingles and a similarity of 0.8: one document of each group stays."""
    from titlelens.llm.ngram_join import one_of_each_group

    sweep(spark)
    return one_of_each_group(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: contaminated documents go."""
    from titlelens.llm.decontaminate import drop_contaminated

    sweep(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token pieces of the kept documents, packed into sequences."""
    from titlelens.llm.packing import pack

    sweep(spark)
    return pack(docs, vocabulary(), capacity=4096, end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

# Token ids and their packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, f"stage-{i + 1}")
    return docs
