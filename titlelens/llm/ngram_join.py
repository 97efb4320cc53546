"""Set-similarity join of documents by a prefix tree of ordered n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import connected_components, cut, discard, salted, small_batches, text_key
from titlelens.llm.shingles import WordHasher, ngrams, split_words

#: Shingles are counted in this many buckets: a table of fixed size, whatever the corpus.
BUCKETS = 1 << 18
#: Bytes of the coarse profile of a set: how many shingles fall into each bin.
BINS = 128
#: Bytes of the sketch of a set, one for each equal part of the hash range.
LANES = 128
#: Natural logarithm of the chance, 1e-20, with which a sketch may hide a pair that links: less than that of equal hashes.
NEVER = -46.0
#: An n-gram in more prefixes than this joins them without a look at profiles.
HOT = 4000
#: Rows of a class beyond which they are dealt out over tasks when its results are joined to them.
HOT_CLASS = 1000
#: Shingles of one block of a candidate component; larger components are joined block by block.
BLOCK = 4_000_000
#: Bits that mark the ids of wanted documents: a table of 2 MB, whatever their number.
MARKS = 1 << 24
#: Texts that a task hands to Python at a time.
BATCH_ROWS = 500


def _buckets(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - 18)).astype(np.int64)


def _profile(s: np.ndarray) -> bytes:
    """Counts by seven middle bits; empty if one does not fit a byte."""
    count = np.bincount(((s >> np.uint64(20)) & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
    return count.astype(np.uint8).tobytes() if count.max(initial=0) < 256 else b""


_LANE_STARTS = np.arange(LANES, dtype=np.uint64) << np.uint64(64 - 7)


def _sketch(s: np.ndarray) -> bytes:
    """Of every lane a byte of its least shingle; 0 if it has none. Lanes of two sets agree, by chance apart,
    where the least shingle of both together is a common one: as many as their Jaccard similarity says, whatever their size."""
    at = np.searchsorted(s, _LANE_STARTS)
    filled = at < np.append(at[1:], len(s))
    out = np.zeros(LANES, np.uint8)
    out[filled] = s[at[filled]] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


@lru_cache
def _fewest(percent: int) -> np.ndarray:
    """For every number of lanes that two sets fill together, the fewest that agree if they link.  The shingles seen are
    drawn without repeats from those of both, so Chernoff's bound holds for the number of common ones among them."""
    out, p = np.zeros(LANES + 1, np.int64), percent / 100
    for k in range(1, LANES + 1):
        q = np.arange(k) / k
        with np.errstate(divide="ignore", invalid="ignore"):
            chance = -k * (np.where(q > 0, q * np.log(q / p), 0) + (1 - q) * np.log((1 - q) / (1 - p)))
        out[k] = np.count_nonzero((q < p) & (chance <= NEVER))
    return out


def _need(percent: int, total: np.ndarray | int) -> np.ndarray | int:
    """``(100 + percent) * overlap`` must reach this for sets of ``total`` shingles together."""
    return percent * total


class Trie:
    """Path-compressed prefix tree of distinct sets, each an ascending array of
    ranks in the global order, most common n-gram first."""

    def __init__(self, sets: list[np.ndarray]):
        keys = [s.astype(">u4").tobytes() for s in sets]
        order = sorted(range(len(sets)), key=keys.__getitem__)
        # nodes: parent, set that spells the label, label from and to, set that ends here
        parent, who, d0, d1, ends = [-1], [0], [0], [0], [-1]
        path, prev = [0], None
        for i in order:
            s = sets[i]
            if prev is None:
                common = 0
            else:
                m = min(len(prev), len(s))
                differ = np.flatnonzero(prev[:m] != s[:m])
                common = int(differ[0]) if len(differ) else m
            child = -1
            while d1[path[-1]] > common:
                node = path.pop()
                if d0[node] < common:  # split: the upper part becomes a node of its own
                    parent.append(parent[node])
                    who.append(who[node])
                    d0.append(d0[node])
                    d1.append(common)
                    ends.append(-1)
                    child = len(parent) - 1
                    parent[node], d0[node] = child, common
                    path.append(child)
                    break
            parent.append(path[-1])
            who.append(i)
            d0.append(common)
            d1.append(len(s))
            ends.append(i)
            path.append(len(parent) - 1)
            prev = s
        self.parent, self.d0, self.d1, self.ends = (np.array(x) for x in (parent, d0, d1, ends))
        n = len(parent)
        length = self.d1 - self.d0
        self.at = np.concatenate(([0], np.cumsum(length)))
        self.labels = np.concatenate([sets[w][a:b] for w, a, b in zip(who, d0, d1, strict=True)] or [np.zeros(0, np.int64)]).astype(np.int64)
        self.last = np.where(length > 0, self.labels[np.maximum(self.at[1:] - 1, 0)] if len(self.labels) else 0, -1)
        self.size = np.array([len(s) for s in sets])
        least, most = np.full(n, 1 << 40), np.full(n, -1)
        at_end = self.ends >= 0
        least[at_end] = most[at_end] = self.size[self.ends[at_end]]
        for node in np.argsort(-self.d1, kind="stable").tolist():  # deeper ends first
            p = parent[node]
            if p >= 0:
                least[p] = min(least[p], least[node])
                most[p] = max(most[p], most[node])
        self.least, self.most = least, most
        by_parent = np.argsort(self.parent, kind="stable")
        self.children = by_parent[1:]  # the root has no parent and comes first
        self.first = np.searchsorted(self.parent[by_parent], np.arange(n)) - 1
        self.n_children = np.bincount(self.parent[1:], minlength=n)

    @staticmethod
    def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
        shift = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length)
        return shift + np.arange(int(length.sum()))

    def similar(self, x: np.ndarray, mask: np.ndarray, percent: int) -> np.ndarray:
        """Sets whose Jaccard similarity with ``x`` is ``percent`` or more.  All
        nodes of a level are visited at once; a node's overlap is its parent's and that of
        its own label, and its subtree is left if no length in it could
        still reach the needed overlap with what remains of both sides."""
        nx, found = len(x), []
        node, over = self.children[:self.n_children[0]], np.zeros(self.n_children[0], np.int64)
        while len(node):
            length = self.d1[node] - self.d0[node]
            hit = np.concatenate(([0], np.cumsum(mask[self.labels[self._runs(self.at[node], length)]])))
            ends = np.cumsum(length)
            over = over + hit[ends] - hit[ends - length]
            depth = self.d1[node]
            rest = nx - np.searchsorted(x, self.last[node], side="right")
            best = np.clip(depth + rest, self.least[node], self.most[node])
            reach = over + np.minimum(rest, best - depth)
            ok = (100 + percent) * reach >= _need(percent, nx + best)
            node, over = node[ok], over[ok]
            who = self.ends[node]
            hits = (who >= 0) & ((100 + percent) * over >= _need(percent, nx + self.size[who]))
            found.append(who[hits])
            more = self.n_children[node]
            over = np.repeat(over, more)
            node = self.children[self._runs(self.first[node], more)]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def links_of(sets: list[np.ndarray], count: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Every set once, with all others similar to it and those of them that no
    set before met. Chains of similar pairs are followed, so the links to the latter span each group."""
    everything, local = np.unique(np.concatenate(sets), return_inverse=True)
    rank = np.empty(len(everything), np.int64)
    rank[np.lexsort((everything, -count[_buckets(everything)]))] = np.arange(len(everything))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    ordered = [np.sort(r) for r in np.split(rank[local], cuts)]
    mask = np.zeros(len(everything), np.int64)
    met = np.zeros(len(sets), bool)
    trie = Trie(ordered)
    for root in range(len(sets)):
        if met[root]:
            continue
        met[root] = True
        queue = [root]
        while queue:
            i = queue.pop()
            mask[ordered[i]] = 1
            found = trie.similar(ordered[i], mask, percent)
            mask[ordered[i]] = 0
            found = found[found != i]
            new = found[~met[found]]
            met[new] = True
            queue += new.tolist()
            yield i, found, new


def _may_link(size: np.ndarray, at: np.ndarray, profiles: list[bytes], sketches: list[bytes], percent: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Tells which of the pairs of rows ``i, j`` of one n-gram can link, if the n-gram is the first that they share: what
    follows it in the shorter rest, lanes that agree, and the profiles' common count, which is at least the overlap."""
    rest, fewest = size - at, _fewest(percent)
    known = np.array([len(p) == BINS for p in profiles], bool)
    table = np.frombuffer(b"".join(p if len(p) == BINS else b"\xff" * BINS for p in profiles), np.uint8).reshape(-1, BINS)
    lanes = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, LANES)

    def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        ok = np.flatnonzero((100 + percent) * np.minimum(rest[i], rest[j]) >= _need(percent, size[i] + size[j]))
        a, b = lanes[i[ok]], lanes[j[ok]]
        filled = np.count_nonzero(a | b, axis=1)
        ok = ok[np.count_nonzero((a == b) & (a > 0), axis=1) >= fewest[filled]]
        i, j = i[ok], j[ok]
        bound = np.where(known[i] & known[j], np.minimum(table[i], table[j]).sum(axis=1, dtype=np.int64), 1 << 40)
        return ok[(100 + percent) * bound >= _need(percent, size[i] + size[j])]

    return test


def _candidate_edges(gram: np.ndarray, may_link: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the candidate pairs of every n-gram; rows are sorted by n-gram."""
    cuts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1], True])
    length = np.diff(cuts)
    two = cuts[:-1][length == 2]
    two = two[may_link(two, two + 1)]
    left, right = [two], [two + 1]
    for a, n in zip(cuts[:-1][length > 2].tolist(), length[length > 2].tolist(), strict=True):
        rest, queue = np.arange(a, a + n), []
        while len(rest):
            if not queue:
                queue.append(int(rest[0]))
                rest = rest[1:]
            i = queue.pop()
            hit = may_link(np.full(len(rest), i), rest)
            if len(hit):
                left.append(np.full(len(hit), i))
                right.append(rest[hit])
                queue += rest[hit].tolist()
                rest = np.delete(rest, hit)
    return np.concatenate(left), np.concatenate(right)


def _partnered(gram: np.ndarray, size: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Which rows, sorted by n-gram and each of another class under it, have a partner there. If the n-gram is the
    first that two sets share, their overlap is at most what follows it in the shorter rest."""
    room = (100 + percent) * (size - at) - percent * size  # rows link only if the room of each reaches the share of the other
    share = percent * size
    cuts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1], True])
    length = np.diff(cuts)
    keep = np.zeros(len(gram), bool)
    two = cuts[:-1][length == 2]
    keep[two] = keep[two + 1] = (room[two] >= share[two + 1]) & (room[two + 1] >= share[two])
    for a, n in zip(cuts[:-1][length > 2].tolist(), length[length > 2].tolist(), strict=True):
        order = a + np.argsort(size[a:a + n], kind="stable")
        r, s = room[order], share[order]
        # The largest and second largest room of the rows whose share fits; a row may be one of these itself.
        most = np.maximum.accumulate(r)
        second = np.maximum.accumulate(np.r_[r[0] - (1 << 40), np.minimum(most[:-1], r[1:])])
        fit = np.searchsorted(s, r, side="right") - 1
        keep[order] = (fit >= 0) & (np.where(r >= s, second[fit], most[fit]) >= s)
    return keep


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, text_key, text`` of the rows whose (id, text hash) may be one of ``wanted``, told in the scan
    by a bitmap of hashed pairs, so that only these texts are shuffled. A full bitmap lets all pass."""
    at = lambda i, k: F.xxhash64(i, k).bitwiseAND(MARKS - 1).alias("mark")
    words = wanted.select(at(*wanted.columns)).selectExpr("shiftright(mark, 6) AS word", "shiftleft(1L, cast(mark & 63 AS int)) AS bit")
    table = np.zeros(MARKS >> 6, np.uint64)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():  # at most MARKS / 64 rows
        table[r.column(0).to_numpy()] = r.column(1).to_numpy().view(np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()  # a row that repeats id and text need not be sent again
        for batch in batches:
            mark = batch.column(3).to_numpy()
            hit = np.flatnonzero((shared.value[mark >> 6] >> (mark & 63).astype(np.uint64)) & np.uint64(1))
            some = batch.select([0, 1, 2]).take(pa.array(hit))
            new = []
            for row in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                new.append(row not in seen)
                seen.add(row)
            if len(seen) > 500_000:
                seen.clear()
            yield some.filter(pa.array(new, pa.bool_()))

    return texts.select("doc_id", "text_key", "text", at("doc_id", "text_key")).mapInArrow(pick, "doc_id long, text_key long, text string")


def class_links(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``class_a, class_b``: every two classes of ``similarity_groups`` that link, once,
    the smaller ``class_id`` first. A group of m similar classes has up to m (m - 1) / 2."""
    return similarity_groups(docs, n, percent, id_col, text_col, listed=True)


def similarity_groups(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id",
                      text_col: str = "text", listed: bool = False) -> DataFrame:
    """One row a document: ``doc_id, n_shingles, component_id, class_id, class_least, n_links, text_key``;
    with ``listed`` the linked classes instead (``class_links``).

    Words are lower-cased (A-Z); a document's set holds its distinct ``n``-word shingles, or
    its whole sequence if it is shorter.  Documents link when the Jaccard similarity of their sets is
    ``percent`` or more; ``component_id`` is the smallest id that links reach, ``n_links``
    the number of other rows that the document links with, equal sets included. Documents of
    equal sets are a class; ``class_least`` is its smallest id.

    1. One pass makes sets, and counts shingles in a table of fixed size: the
       global order is (bucket count, shingle).  Equal sets form a class, and
       only classes take part.
    2. A class's prefix, its rarest shingles, must share one with every partner's. Prefixes
       are joined by shingle; lengths, places and profiles (upper bounds of the
       overlap) sort out most pairs.  What is left spans candidate components.
    3. The sets of a component meet once, in one task, or block by block if they
       are many, in a prefix tree, most common shingle first.  It decides exactly, and
       finds all partners of a class; their members are summed in the task.

    A text that is null, empty or without words has no set and stays alone.  Null ids
    count as larger than any other; repeated rows are one class.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))

    def sets_of(column: pa.Array, hasher: WordHasher) -> Iterator[np.ndarray]:
        for text in column.to_pylist():
            yield np.unique(ngrams(hasher(split_words(text, lower=True)), n))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, count = WordHasher(), np.zeros(BUCKETS, np.int64)
        names = ["doc_id", "text_key", "n", "digest", "profile", "sketch", "bucket", "hits"]
        for batch in batches:
            rows = []
            for s in sets_of(batch.column(1), hasher):
                np.add.at(count, _buckets(s), 1)
                rows.append((len(s), _digest(s), _profile(s), _sketch(s)))
            size, digest, profile, sketch = zip(*rows, strict=True) if rows else ((), (), (), ())
            none = pa.nulls(len(rows), pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                                   pa.array(profile, pa.binary()), pa.array(sketch, pa.binary()), none, none], names=names)
        at = np.flatnonzero(count)
        none = pa.nulls(len(at), pa.int64())
        blank = pa.nulls(len(at), pa.binary())
        for i in range(0, len(at), 10_000):
            k = at[i:i + 10_000]
            yield pa.record_batch([*[none[:len(k)]] * 3, *[blank[:len(k)]] * 3, pa.array(k), pa.array(count[k])], names=names)

    with small_batches(spark, BATCH_ROWS):
        made = cut(texts.mapInArrow(first_pass, "doc_id long, text_key long, n long, digest binary, profile binary, sketch binary, bucket long, hits long"), "sets")
    each = made.where("bucket is null").select("doc_id", "text_key", "n", "digest", F.xxhash64("digest").alias("cls"), "profile", "sketch")
    count = np.zeros(BUCKETS, np.int64)
    for r in made.where("bucket is not null").groupBy("bucket").agg(F.sum("hits").alias("hits")).toArrow().to_batches():  # at most BUCKETS rows
        count[r.column(0).to_numpy()] = r.column(1).to_numpy()
    shared = spark.sparkContext.broadcast(count.astype(np.int64))
    classes = cut(each.where("n > 0").groupBy("digest", "cls").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("least"), F.count("*").alias("members"),
                                                                  F.first("n").alias("n"), F.first("profile").alias("profile"), F.first("sketch").alias("sketch")), "classes")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, count = WordHasher(), set(), shared.value
        for batch in batches:
            grams, places, owners = [], [], []
            for s in sets_of(batch.column(0), hasher):
                d = _digest(s)
                if not len(s) or d in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(d)
                p = len(s) + (-percent * len(s)) // 100 + 1
                weight = count[_buckets(s)]
                if p < len(s):  # the rarest p: those of smaller counts, and the smallest shingles among the last count
                    part = np.argpartition(weight, p - 1)[:p]
                    top = weight[part].max()
                    sure = np.flatnonzero(weight < top)
                    part = np.concatenate((sure, np.flatnonzero(weight == top)[:p - len(sure)]))
                    rare = s[part][np.lexsort((s[part], weight[part]))]
                else:
                    rare = s[np.lexsort((s, weight))]
                grams.append(rare)
                places.append((len(s) << 24) + np.arange(len(rare)))
                owners += [d] * len(rare)
            if grams:
                yield pa.record_batch([pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(places)), pa.array(owners, pa.binary())],
                                      names=["gram", "place", "digest"])

    prefix = texts.select("text").mapInArrow(prefixes, "gram long, place long, digest binary").select("gram", "place", F.xxhash64("digest").alias("cls"))
    with small_batches(spark, BATCH_ROWS):
        prefix = cut(prefix, "prefixes")
    common = prefix.groupBy("gram").agg(F.min("cls").alias("a"), F.max("cls").alias("b"), F.count("*").alias("k")).where("a < b")
    pairs = prefix.join(common, "gram").select("gram", "cls", "place", "a", "k")
    pairs = cut(pairs, "shared-prefixes")
    discard(prefix)
    # A hot n-gram joins all that have it to the least of them; the exact step decides.
    hot = pairs.where((F.col("k") > HOT) & (F.col("a") != F.col("cls"))).select("a", F.col("cls").alias("b"))
    facts = classes.select("cls", "profile", "sketch").dropDuplicates(["cls"])
    cool = pairs.where(F.col("k") <= HOT).select("gram", "cls", "place")

    def partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            gram, place = table.column(0).to_numpy(), table.column(2).to_numpy()
            cls = table.column(1).to_numpy()
            one = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (cls[1:] != cls[:-1])])  # copies of a text may come from several tasks
            gram, place = gram[one], place[one]
            keep = _partnered(gram, place >> 24, place & 0xFFFFFF, percent)
            yield from table.take(pa.array(one[keep])).to_batches()

    cool_rows = cut(cool.repartition("gram").sortWithinPartitions("gram", "cls").mapInArrow(partnered, "gram long, cls long, place long"), "partnered-prefixes")
    cool = cool_rows.join(facts, "cls")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted: set[tuple[int, int]] = set()
        for table in _whole_groups(batches):
            gram, cls, place = (table.column(k).to_numpy() for k in range(3))
            a, b = _candidate_edges(gram, _may_link(place >> 24, place & 0xFFFFFF, table.column(3).to_pylist(), table.column(4).to_pylist(), percent))
            fresh = set(zip(np.minimum(cls[a], cls[b]).tolist(), np.maximum(cls[a], cls[b]).tolist(), strict=True))
            fresh -= emitted
            if fresh:
                emitted = emitted | fresh if len(emitted) < 500_000 else fresh
                a, b = zip(*fresh, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    met = (cool.select("gram", "cls", "place", "profile", "sketch").repartition("gram").sortWithinPartitions("gram", "cls")
           .mapInArrow(candidates, "a long, b long"))
    component = connected_components(met.unionByName(hot), "candidates")
    discard(pairs, cool_rows)
    near = cut(classes.join(component.withColumnRenamed("node", "cls"), "cls")
               .select("digest", F.col("first.doc_id").alias("least"), F.col("first.text_key").alias("key"), "n", "members", F.col("component").alias("comp")), "candidate-classes")
    blocks = near.groupBy("comp").agg(F.sum("n").alias("total"))
    blocks = blocks.select("comp", F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"))
    placed = near.join(blocks, "comp").withColumn("own", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    # Every two blocks meet in one job, and with them the members of each.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("least", "key", "digest", "members", "comp", "own", "blocks", other.alias("other")).where("own != other or blocks = 1").select(
        "least", "key", "digest", "members", "own", F.struct("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).alias("job"))
    wanted = placed.select(F.col("least").alias("id"), "key", F.col("digest").alias("d"), "members", "own", "job")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, count = WordHasher(), shared.value
        job, digests, members, owns, sets = None, [], [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(sets) > 1:
                _, i, j = job
                weight, own = np.array(members), np.array(owns)
                # Two sets of one block meet in all jobs of the block, and count in one of them.
                here = (own == i) | (own == j) if i == j else (i == 0) & ((own == j) | (j == 1))
                out = []
                for a, found, new in links_of(sets, count, percent):
                    found_here = found[(own[found] != own[a]) | here[a]]
                    if listed:
                        out += [(digests[a], digests[b], 1) for b in found_here.tolist() if digests[a] < digests[b]]
                    else:
                        out += [(digests[a], digests[b], None) for b in new.tolist()]
                        if len(found_here):
                            out.append((digests[a], None, int(weight[found_here].sum())))
                    if len(out) > 100_000:
                        yield links_batch(out)
                        out = []
                if out:
                    yield links_batch(out)
            for x in (digests, members, owns, sets):
                x.clear()

        def links_batch(rows: list[tuple]) -> pa.RecordBatch:
            a, b, links = zip(*rows, strict=True)
            return pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(links, pa.int64())], names=["a", "b", "links"])

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True)
            for (*now, d, m, own), s in zip(keys, sets_of(batch.column(6), hasher), strict=True):
                if now != job:
                    yield from close()
                    job = now
                if (not digests or digests[-1] != d) and _digest(s) == d:
                    digests.append(d)
                    members.append(m)
                    owns.append(own)
                    sets.append(s)
        yield from close()

    # A text is known by its id and its hash: any number of texts may share an id, or have none.
    near_texts = _marked(texts, near.select("least", "key"))
    sent = (near_texts.join(wanted, near_texts["doc_id"].eqNullSafe(wanted["id"]) & (near_texts["text_key"] == wanted["key"]))
            .select("job.comp", "job.i", "job.j", "d", "members", "own", "text").repartition("comp", "i", "j")
            .sortWithinPartitions("comp", "i", "j", "d"))
    made = sent.mapInArrow(exact, "a binary, b binary, links long")
    if listed:
        a, b = F.xxhash64("a"), F.xxhash64("b")
        return made.select(F.least(a, b).alias("class_a"), F.greatest(a, b).alias("class_b"))
    with small_batches(spark, BATCH_ROWS):
        made = cut(made, "exact")
    n_links = made.where("b is null").groupBy(F.col("a").alias("digest")).agg(F.sum("links").alias("links"))
    linked = connected_components(made.where("b is not null").select("a", "b"), "links")
    groups = linked.select(F.col("node").alias("digest"), "component").join(classes.select("digest", "least"), "digest")
    least = groups.groupBy("component").agg(F.min("least").alias("group_least"))
    of_class = classes.select("digest", "least", "members").join(
        groups.join(least, "component").select("digest", "group_least"), "digest", "left").join(n_links, "digest", "left")
    of_class = of_class.select("digest", F.coalesce("group_least", "least").alias("component_id"), F.col("least").alias("class_least"),
                               (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "members")
    # A third of all rows may be copies of one text.
    of_class = cut(of_class, "classes-with-links")
    rows, of_class = salted(each.where("n > 0"), of_class, ["digest"], F.col("members") > HOT_CLASS, "hot-classes")
    out = rows.join(of_class, ["digest", "__salt"]).select("doc_id", "n", "component_id", "cls", "class_least", "n_links", "text_key")
    alone = each.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("cls"),
                                         F.lit(None).cast("long").alias("class_least"), F.lit(0).cast("long").alias("n_links"), "text_key")
    return out.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("cls").alias("class_id"), "class_least", "n_links", "text_key")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables that never part rows of one first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        if held and key[-1] != held[-1].column(0)[-1].as_py():
            at = int(np.searchsorted(key, key[-1]))  # the last group may go on
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = [batch.slice(at)]
        elif not held and key[-1] != key[0]:
            at = int(np.searchsorted(key, key[-1]))
            yield pa.Table.from_batches([batch.slice(0, at)])
            held = [batch.slice(at)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of every group the row with the
    smallest id (of its texts the one with the smallest hash) stays, once;
    documents without words all stay."""
    groups = similarity_groups(docs, n, percent, id_col, text_col)
    first = groups.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "text_key")).alias("x"))
    keep = first.select(F.col("x.doc_id").alias("__id"), F.col("x.text_key").alias("__key"), F.lit(True).alias("__once"))
    empty = groups.where("n_shingles = 0").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.lit(False).alias("__once"))
    keep = keep.unionByName(empty.distinct())
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), F.col(id_col).cast("long").alias("__i"),
                      text_key(F.col(text_col)).alias("__k"))
    found = row.join(keep, [row["__i"].eqNullSafe(keep["__id"]), row["__k"] == keep["__key"]])
    once = found.where("__once").dropDuplicates(["__i", "__k"]).select("__row.*")
    return once.unionByName(found.where("not __once").select("__row.*"))
