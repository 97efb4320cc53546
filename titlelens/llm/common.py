"""Helpers shared by the operators: the cluster's shared folder, tables that
cut lineage, connected components, and small column expressions."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The two word definitions of the contracts, as regular expressions.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A scratch folder is made only where none is set and the master is local
    (tests); on a cluster a missing setting is an error, because a
    machine-local folder would lose what other executors write.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="titlelens-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Tables that ``cut`` has written: path, and a weak reference to the file listing that every plan over it shares.
_WRITTEN: list[tuple[str, object]] = []


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later
    steps reuse the rows instead of recomputing them, and a lost executor
    costs a re-read of a file and no more."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    listing = out._jdf.queryExecution().analyzed().relation().location()
    _WRITTEN.append((path, spark._jvm.java.lang.ref.WeakReference(listing)))
    out._written = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _WRITTEN[:] = [x for x in _WRITTEN if x[0] != path]


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` has returned and that no plan reads any more."""
    for t in tables:
        _delete(t.sparkSession, t._written)


def sweep(spark: SparkSession) -> None:
    """Delete every table of ``cut`` that no plan in this driver can read any more.
    As long as a DataFrame made from such a table exists, the JVM holds its listing."""
    gc.collect()
    spark._jvm.System.gc()
    for path in [p for p, listing in _WRITTEN if listing.get() is None]:
        _delete(spark, path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside: a batch of long texts is
    held by the JVM and by the Python worker, there also as strings.  The caller's setting
    is put back, and stays where it asks for smaller batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    if before is None or not 0 < int(before) <= rows:  # 0 and less: no limit
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else.  ``lower`` does the same on a text of
    ASCII characters only, and faster."""
    return F.when(F.char_length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, ASCII_UPPER, ASCII_UPPER.lower()))


def words(c: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in order; no text has none."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({pattern})"), F.lit(1))


def text_key(c: Column) -> Column:
    """Tells apart rows that share an id but not a text."""
    return F.coalesce(F.xxhash64(c), F.lit(0))


#: Bits that mark heavy keys: a table of at most HEAVY_BITS / 64 rows, and the parts into which a heavy key's rows are dealt.
HEAVY_BITS, SALTS = 1 << 20, 64


def salted(rows: DataFrame, facts: DataFrame, keys: list[str], heavy: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` and ``facts`` with a column ``__salt``, to be joined by ``keys`` and it.

    ``facts`` has one row a key.  Where ``heavy`` holds, its row is repeated for every
    salt and the key's ``rows`` are dealt out over the salts, so that no task gets all of
    them.  Which keys are heavy is told by a bitmap of hashed keys of fixed size; keys that
    share a bit with a heavy one are treated alike on both sides.
    """
    mark = F.xxhash64(*(F.col(k) for k in keys)).bitwiseAND(HEAVY_BITS - 1)
    marks = facts.where(heavy).select(mark.alias("m")).selectExpr("shiftright(m, 6) AS __word", "shiftleft(1L, cast(m & 63 AS int)) AS bit")
    marks = cut(marks.groupBy("__word").agg(F.bit_or("bit").alias("__bits")), name)
    if not marks.limit(1).count():
        return rows.withColumn("__salt", F.lit(0)), facts.withColumn("__salt", F.lit(0))

    def add(df: DataFrame, salt: Column) -> DataFrame:
        hit = F.col("__bits").isNotNull() & F.expr("(shiftrightunsigned(__bits, cast(__mark & 63 AS int)) & 1) = 1")
        marked = df.withColumn("__mark", mark).withColumn("__at", F.shiftright(F.col("__mark"), 6))
        joined = marked.join(F.broadcast(marks), F.col("__at") == F.col("__word"), "left")
        return joined.withColumn("__hit", hit).select(*(df[c] for c in df.columns), salt.alias("__salt"))

    dealt = F.when(F.col("__hit"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))).otherwise(0).cast("int")
    every = F.explode(F.when(F.col("__hit"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    return add(rows, dealt), add(facts, every)


def ordered_sums(df: DataFrame, group: str, order: list[Column], values: list[str], name: str,
                 facts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``before_<v>``, the sum of the longs ``v`` over the rows of the same
    ``group`` that come earlier by ``order``, and ``all_<v>``, over the whole group
    (null is a group of its own).  ``facts``, one row a group, adds its columns.

    Rows are dealt out by ranges of (group, order), so a group of any size is
    spread over tasks.  Each range sums up on its own; ranges' totals (at most one
    row for each range that a group meets) become offsets, and are joined back by
    (group, range), which splits a hot group as the ranges do.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    kinds = df.select(group, *values).schema
    at = [df.columns.index(c) for c in (group, *values)]
    fields = [*df.schema.fields, *(f for f in df.select(*(F.lit(0).cast("long").alias(c) for c in ("__range", *(f"__in_{v}" for v in values)))).schema.fields)]
    schema = type(kinds)(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, carry = None, [0] * len(values)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            code = batch.column(at[0]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, n]))
            first = (batch.column(at[0])[0].as_py(),)
            cols = []
            for k, i in enumerate(at[1:]):
                v = batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(v)
                before = total - v
                inner = before - before[start][of]
                if first == last:
                    inner[of == 0] += carry[k]
                carry[k] = int(inner[-1] + v[-1])
                cols.append(pa.array(inner))
            last = (batch.column(at[0])[n - 1].as_py(),)
            yield pa.record_batch([*batch.columns, pa.array(np.full(n, part)), *cols], names=[f.name for f in fields])

    dealt = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), name)
    parts = dealt.groupBy(F.col(group).alias("__group"), F.col("__range").alias("__of")).agg(
        *(F.max(F.col(f"__in_{v}") + F.col(v)).alias(f"__sum_{v}") for v in values))
    of_group = Window.partitionBy("__group")
    earlier = of_group.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__group", "__of", *(F.coalesce(F.sum(f"__sum_{v}").over(earlier), F.lit(0)).alias(f"__off_{v}") for v in values),
                         *(F.sum(f"__sum_{v}").over(of_group).alias(f"all_{v}") for v in values))
    more = []
    if facts is not None:
        more = [c for c in facts.columns if c != group]
        parts = parts.join(facts.withColumnRenamed(group, "__key"), F.col("__group").eqNullSafe(F.col("__key"))).drop("__key")
    parts = cut(parts, f"{name}-offsets")
    out = dealt.join(parts, dealt[group].eqNullSafe(parts["__group"]) & (dealt["__range"] == parts["__of"]))
    return out.select(*(dealt[c] for c in df.columns), *((F.col(f"__in_{v}") + F.col(f"__off_{v}")).alias(f"before_{v}") for v in values),
                      *(f"all_{v}" for v in values), *more)


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph as ``(node, component)``, component
    being the smallest node reachable; nodes without an edge do not appear.

    ``edges`` has the columns ``a`` and ``b``.  Alternating star contraction:
    each round links the larger neighbours of every node to its smallest one,
    then the smaller neighbours to the smallest.  The number of rounds grows
    with the logarithm of the graph's size.  Every round is written to the shared folder,
    and neighbourhoods are only ever aggregated with ``min``, never gathered;
    the joins back to the edges are plain equi-joins that AQE may split.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .where("u > v").distinct(), f"{name}-edges")
    size = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        large, before = cut(large, f"{name}-large"), e
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small, f"{name}-small")
        discard(large, before)
        # The contraction has settled when the edges form stars: no centre is itself a leaf, no leaf has two centres.
        stats = e.agg(F.count("*").alias("n"), F.count_distinct("u").alias("leaves"), F.sum(F.xxhash64("v").cast("decimal(20,0)")).alias("s")).first()
        chained = e.select("u").join(e.select(F.col("v").alias("u")), "u", "left_semi").limit(1).count()
        if stats["n"] == stats["leaves"] and not chained:
            break
        if size == tuple(stats):
            raise RuntimeError("connected components made no progress")
        size = tuple(stats)
    else:
        raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
