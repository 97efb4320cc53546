"""Substring deduplication: recurring passages are found by sampled phrases,
located by Aho-Corasick automata, and removed from all but the first document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import cut, text_key
from titlelens.llm.shingles import WordHasher, mix, split_words

#: Phrases of one automaton, on average.
SHARD_PHRASES = 4000
#: Characters of the documents that stream through an automaton in one task.
TASK_CHARS = 8_000_000
#: A first owner whose documents fill more than one of so many parts of a task has a shard of its own.
ALONE = 4
#: Stands for a null id: larger than any other.
NO_ID = (1 << 63) - 1

_A = np.uint64(0x9E3779B97F4A7C15)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, by doubling; the last step overlaps its halves."""
    if len(hashes) < n:
        return hashes[:0]
    done, out = 1, mix(hashes + _A)
    while done < n:
        gap = min(done, n - done)
        out = mix(out[:len(out) - gap] * _A + out[gap:])
        done += gap
    return out


def window_least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of every ``n`` consecutive elements."""
    if len(x) < n:
        return x[:0]
    done = 1
    while done < n:
        gap = min(done, n - done)
        x = np.minimum(x[:len(x) - gap], x[gap:])
        done += gap
    return x


def _automaton(phrases: list[bytes]) -> tuple[ahocorasick.Automaton, dict[bytes, int]]:
    """Over numbers of words, so that a match is one of whole words."""
    numbers: dict[bytes, int] = {}
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for p in phrases:
        found.add_word(tuple(numbers.setdefault(w, len(numbers) + 1) for w in p.split(b" ")), 1)
    found.make_automaton()
    return found, numbers


def _spans(starts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Sorted window starts as disjoint spans of words."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.r_[True, np.diff(starts) > size])
    ends = np.r_[new[1:], len(starts)] - 1
    return list(zip(starts[new].tolist(), (starts[ends] + size).tolist(), strict=True))


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def remove_repeats(docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``doc_id, n_words, n_removed, kept_sha256, text_key``.

    A word goes if a window of ``size`` words that covers it also starts in a
    document with a smaller id; windows are those of the input.

    1. Phrases of ``size / 2`` words are sampled so that each window holds one of
       its own (the least hash in it); those met in two documents recur.
    2. The recurring phrases of a first owner go, as text, to the automaton
       of one of many shards, and the documents that hold some of them with it.
       An owner with many documents has a shard of its own, the others share shards that
       fit a task.  A shard with more documents than that is spread over tasks that
       share its phrases.
    3. The documents stream through the automata in ascending id.  Windows whose
       sampled phrase occurs are looked up among those seen before; what
       spread shards have seen first in each task is settled by a join.

    Null texts have no words.  Null ids count as larger than any other, and do not
    precede each other.  Rows of one id never remove each other's words;
    repeated rows give repeated rows.  An empty table gives an empty result.
    """
    gram = size // 2
    slack = size - gram
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text_col).alias("text"),
                        text_key(F.col(text_col)).alias("text_key"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        names = ["doc", "text_key", "n_words", "chars", "sha", "phrase"]
        for batch in batches:
            n_words, chars, sha, phrases, owners, keys = [], [], [], [], [], []
            for doc, text, key in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = split_words(text)
                n_words.append(len(words))
                chars.append(len(text or ""))
                sha.append(_sha(words))
                if len(words) >= size:
                    least = np.unique(window_least(runs(hasher(words), gram), slack + 1))
                    phrases.append(least)
                    owners.append(np.full(len(least), doc))
                    keys.append(np.full(len(least), key))
            n = batch.num_rows
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n_words, pa.int64()), pa.array(chars, pa.int64()), pa.array(sha, pa.string()), pa.nulls(n, pa.int64())], names=names)
            if phrases:
                p = pa.array(np.concatenate(phrases).view(np.int64))
                yield pa.record_batch([pa.array(np.concatenate(owners), pa.int64()), pa.array(np.concatenate(keys), pa.int64()), pa.nulls(len(p), pa.int64()), pa.nulls(len(p), pa.int64()), pa.nulls(len(p), pa.string()), p], names=names)

    made = cut(texts.mapInArrow(sample, "doc long, text_key long, n_words long, chars long, sha string, phrase long"), "phrases")
    each = made.where("phrase is null").select("doc", "text_key", "n_words", "sha")
    phrases = made.where("phrase is not null").select("doc", "text_key", "phrase")
    # Everything goes by (id, text hash): texts that share an id, or have none, are routed each on its own.
    recurring = cut(phrases.groupBy("phrase").agg(F.min(F.struct("doc", "text_key")).alias("first"), F.max("doc").alias("most"))
                    .where("first.doc < most").select("phrase", F.col("first.doc").alias("owner"), F.col("first.text_key").alias("owner_key")), "recurring")
    held_by = cut(phrases.join(recurring, "phrase").select("doc", "text_key", "owner", "owner_key").distinct(), "owners")  # at most one for each sampled phrase of a text
    # A window that no other document has ends in the task that finds it, if that task has all documents of its phrase's
    # owner; else it is written for the join.  So an owner's documents stay together as far as one task can take them.
    sizes = made.where("phrase is null").groupBy(F.col("doc").alias("of"), F.col("text_key").alias("of_key")).agg(F.sum("chars").alias("chars"))
    weights = cut(held_by.join(sizes, (F.col("doc") == F.col("of")) & (F.col("text_key") == F.col("of_key")))
                  .groupBy("owner", "owner_key").agg(F.sum("chars").alias("chars")), "weights")
    alone = weights.where(F.col("chars") * ALONE > TASK_CHARS).select(F.col("owner").alias("alone"), F.col("owner_key").alias("alone_key"))
    shared = weights.where(F.col("chars") * ALONE <= TASK_CHARS).agg(F.sum("chars")).first()[0] or 0
    shards = max(1, -(-recurring.count() // SHARD_PHRASES), -(-2 * shared // TASK_CHARS))

    def sharded(owners: DataFrame) -> DataFrame:
        """With the ``shard`` of each owner; shared ones are numbered from 0."""
        code = F.xxhash64("owner", "owner_key")
        own = F.col("alone").isNotNull()
        return (owners.join(alone, (F.col("owner") == F.col("alone")) & (F.col("owner_key") == F.col("alone_key")), "left")
                .withColumn("shard", F.when(own, F.lit(shards) + F.pmod(code, F.lit(1 << 62))).otherwise(F.pmod(code, F.lit(shards)))).drop("alone", "alone_key"))

    routes = sharded(held_by).select("doc", "text_key", "shard").distinct().groupBy("doc", "text_key").agg(F.collect_set("shard").alias("shards"))
    owned = sharded(recurring.groupBy("owner", "owner_key").agg(F.collect_set("phrase").alias("owned"))).withColumnRenamed("shard", "home")
    routes = routes.join(owned, (routes["doc"] == owned["owner"]) & (routes["text_key"] == owned["owner_key"]), "left").select(
        F.col("doc").alias("to"), F.col("text_key").alias("to_key"), "shards", "owned", "home")
    with_text = texts.where("text is not null")
    held = cut(with_text.join(routes, (with_text["doc"] == routes["to"]) & (with_text["text_key"] == routes["to_key"]))
               .select("doc", "text_key", "text", "shards", "owned", "home"), "documents-with-repeats")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            shard, phrase = [], []
            for text, wanted, to in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = split_words(text)
                own = runs(hasher(words), gram)
                _, at = np.unique(own, return_index=True)
                at = at[np.isin(own[at], np.array(wanted, np.int64).view(np.uint64))]
                phrase += [b" ".join(words[p:p + gram]) for p in at.tolist()]
                shard += [to] * len(at)
            yield pa.record_batch([pa.array(shard, pa.int64()), pa.array(phrase, pa.binary())], names=["shard", "phrase"])

    spelled = (held.where("owned is not null").select("text", "owned", "home")
               .mapInArrow(spell, "shard long, phrase binary").distinct())
    routed = held.select("doc", "text_key", "text", F.explode("shards").alias("shard"))
    load = routed.groupBy("shard").agg(F.ceil(F.sum(F.char_length("text")) / TASK_CHARS).cast("int").alias("tasks"))
    load = cut(load.select(F.col("shard").alias("of"), "tasks"), "shards")  # one row a shard
    to_all = spelled.join(load, F.col("shard") == F.col("of")).select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "tasks", F.lit(None).cast("long").alias("doc"),
        F.lit(None).cast("long").alias("text_key"), F.col("phrase").alias("body"))
    to_one = routed.join(load, F.col("shard") == F.col("of")).select(
        "shard", F.pmod(F.xxhash64("doc", "text_key"), F.col("tasks")).cast("int").alias("task"), "tasks", "doc", "text_key",
        F.col("text").cast("binary").alias("body"))
    sent = to_all.unionByName(to_one).repartition("shard", "task").sortWithinPartitions("shard", "task", F.col("doc").asc_nulls_first(), "text_key")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, group, waiting, machine, first = WordHasher(), None, [], None, {}
        for batch in batches:
            out: list[tuple] = []
            for shard, task, tasks, doc, key, body in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if (shard, task) != group:
                    group, waiting, machine, first = (shard, task), [], None, {}
                if doc is None:
                    waiting.append(body)
                    continue
                if machine is None:
                    machine, numbers = _automaton(waiting)
                    waiting = []
                words = body.split()
                if len(words) < size:
                    continue
                at = np.array([end for end, _ in machine.iter(tuple(map(numbers.get, words, repeat(0))))], np.int64) - (gram - 1)
                if not len(at):
                    continue
                # A window recurs only if its own sampled phrase does; the automaton has found all places of those.
                hashes = hasher(words)
                own = runs(hashes, gram)
                starts = np.flatnonzero(np.isin(window_least(own, slack + 1), own[at]))
                if not len(starts):
                    continue
                windows = runs(hashes, size)[starts]
                seen = np.array([first.setdefault(h, doc) for h in windows.tolist()], np.int64)
                out += [(doc, key, a, b, None) for a, b in _spans(starts[seen < doc], size)]
                if tasks > 1:  # another task of this shard may have seen these windows in an earlier document
                    new = seen == doc
                    out += [(doc, key, a, a + size, h) for a, h in zip(starts[new].tolist(), windows[new].view(np.int64).tolist(), strict=True)]
            if out:
                cols = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["doc", "text_key", "start", "end", "window"])

    found = cut(sent.mapInArrow(locate, "doc long, text_key long, start long, end long, window long"), "occurrences")
    open_ = found.where("window is not null")
    earliest = open_.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("window", "least")
    settled = open_.join(earliest, "window").where("least < doc").select("doc", "text_key", "start", "end")
    spans = (found.where("window is null").select("doc", "text_key", "start", "end").unionByName(settled)
             .groupBy(F.col("doc").alias("of"), F.col("text_key").alias("of_key")).agg(F.collect_set(F.struct("start", "end")).alias("spans")))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, sha = [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = split_words(text)
                keep = np.ones(len(words), bool)
                for s in spans:
                    keep[s["start"]:s["end"]] = False
                removed.append(len(words) - int(keep.sum()))
                sha.append(_sha([words[k] for k in np.flatnonzero(keep).tolist()]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                                  names=["of", "of_key", "n_removed", "kept"])

    changed = (held.join(spans, (F.col("doc") == F.col("of")) & (F.col("text_key") == F.col("of_key")))
               .select("of", "of_key", "text", "spans").mapInArrow(clean, "of long, of_key long, n_removed long, kept string")
               .dropDuplicates(["of", "of_key"]))
    out = each.join(changed, (F.col("doc") == F.col("of")) & (F.col("text_key") == F.col("of_key")), "left")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words",
                      F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"), "text_key")
