"""Merkle manifest of a dataset: hash trees over the documents of every source
and over the sources, with resumable hash states."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import ascii_lower, cut, ordered_sums

#: Children of a parent.
FAN = 16
#: Bytes of a digest as hex text, and of a full run of them.
HEX = 64
RUN = FAN * HEX
#: Levels of the tree that one block of leaves, or of upper nodes, spans: blocks of 256 and 4096.
LEAF_LEVELS, UPPER_LEVELS = 2, 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATHS = "grp string, idx long, path array<struct<left: binary, right: binary>>, subroot binary, root binary"


class StateTree:
    """The tree over one block of nodes (their hex digests, one after another).

    A parent hashes its children in turn and keeps a copy of the hash state
    before each child's slot.  ``fold`` resumes that state with another digest in
    the slot and the siblings right of it; those on the left are in the state.
    """

    def __init__(self, nodes: bytes, levels: int):
        self.rows, self.states = [nodes], []
        while len(self.states) < levels:
            row, states, up = self.rows[-1], [], []
            for a in range(0, len(row), RUN):
                h = hashlib.sha256()
                for b in range(a, min(a + RUN, len(row)), HEX):
                    states.append(h.copy())
                    h.update(row[b:b + HEX])
                up.append(h.hexdigest())
            self.states.append(states)
            self.rows.append("".join(up).encode())

    @property
    def top(self) -> bytes:
        return self.rows[-1]

    def siblings(self, i: int) -> list[tuple[bytes, bytes]]:
        """Those left and right of node ``i`` and of its ancestors, level by level."""
        out = []
        for row in self.rows[:-1]:
            a = i // FAN * RUN
            out.append((row[a:i * HEX], row[(i + 1) * HEX:a + RUN]))
            i //= FAN
        return out

    def fold(self, i: int, digest: bytes) -> bytes:
        for row, states in zip(self.rows, self.states, strict=False):
            h = states[i].copy()
            h.update(digest + row[(i + 1) * HEX:i // FAN * RUN + RUN])
            digest, i = h.hexdigest().encode(), i // FAN
        return digest


def levels_of(total: int, most: int) -> int:
    """Levels that a block climbs: to a single node if the group is one block, else ``most``."""
    k = 0
    while k < most and total > FAN ** k:
        k += 1
    return k


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: dict[str, Column]) -> Column:
    """Hex SHA-256 of the fields in order, each ``-`` if null, else its UTF-8 length, ``:`` and value."""
    return F.sha2(F.concat(*(_field(columns[c]) for c in FIELDS)), 256)


def _blocks(nodes: DataFrame, levels: int, name: str) -> DataFrame:
    """One row a block of ``FAN ** levels`` nodes of a group: their digests in order, what else
    they carry, and the digest on top.  ``nodes`` has ``grp, idx, total, digest, other, doc_id``."""
    size = FAN ** levels
    schema = "grp string, block long, total long, digests binary, others binary, doc_ids array<long>, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digests, others, ids = None, [], [], []

        def close() -> pa.RecordBatch:
            row = "".join(d.hex() for d in digests).encode()
            other = "".join((o or d).hex() for o, d in zip(others, digests, strict=True)).encode() if any(others) else None
            top = StateTree(row, levels_of(key[2], levels)).top
            return pa.record_batch([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()), pa.array([key[2]], pa.int64()), pa.array([row], pa.binary()),
                                    pa.array([other], pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([top], pa.binary())],
                                   names=["grp", "block", "total", "digests", "others", "doc_ids", "digest"])

        for batch in batches:
            for grp, block, total, d, o, i in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (grp, block, total) != key:
                    if key is not None:
                        yield close()
                    key, digests, others, ids = (grp, block, total), [], [], []
                digests.append(d)
                others.append(o)
                ids.append(i)
        if key is not None:
            yield close()

    block = F.floor(F.col("idx") / size).cast("long").alias("block")
    dealt = nodes.select("grp", block, "idx", "total", "digest", "other", "doc_id").repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")
    return cut(dealt.select("grp", "block", "total", "digest", "other", "doc_id").mapInArrow(run, schema), name)


def _above(blocks: DataFrame, levels: int) -> DataFrame:
    """The blocks' tops as the nodes of the next round."""
    return blocks.select("grp", F.col("block").alias("idx"), F.ceil(F.col("total") / FAN ** levels).cast("long").alias("total"),
                         F.unhex(F.col("digest").cast("string")).alias("digest"), F.lit(None).cast("binary").alias("other"), F.lit(None).cast("long").alias("doc_id"))


def _climb(nodes: DataFrame, levels: int, name: str) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """Rounds of blocks until every group is one node, and those nodes.  A group
    that is one node already stays as it is."""
    rounds: list[tuple[DataFrame, int]] = []
    while True:
        blocks = _blocks(nodes, levels, f"{name}-{len(rounds)}")
        rounds.append((blocks, levels))
        nodes = _above(blocks, levels)
        levels = UPPER_LEVELS
        if (nodes.agg(F.max("total")).first()[0] or 0) <= 1:
            return rounds, nodes


def _joined(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    up = paths.select(F.col("grp").alias("up_grp"), F.col("idx").alias("up_idx"), "path", "subroot", "root")
    return blocks.join(up, blocks["grp"].eqNullSafe(up["up_grp"]) & (blocks["block"] == up["up_idx"]))


def _descend(rounds: list[tuple[DataFrame, int]], paths: DataFrame, name: str) -> DataFrame:
    """Siblings up to the root of every node of the lowest of ``rounds``, given those of the top nodes."""
    for blocks, levels in reversed(rounds):
        size = FAN ** levels

        def run(batches: Iterator[pa.RecordBatch], levels: int = levels, size: int = size) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for grp, block, total, digests, path, subroot, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    tree = StateTree(digests, levels_of(total, levels))
                    rows = [{"grp": grp, "idx": block * size + i, "path": [{"left": x, "right": y} for x, y in tree.siblings(i)] + path,
                             "subroot": subroot, "root": root} for i in range(len(digests) // HEX)]
                    side = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("path", side), ("subroot", pa.binary()), ("root", pa.binary())]))

        paths = cut(_joined(blocks, paths).select("grp", "block", "total", "digests", "path", "subroot", "root").mapInArrow(run, _PATHS), f"{name}-paths")
    return paths


class Manifest(NamedTuple):
    """The trees: ``rounds`` of blocks of every source (``grp``), the lowest first, and over the sources."""

    rounds: list[tuple[DataFrame, int]]
    subroots: DataFrame  # grp, idx (its place among the sources), digest
    above: list[tuple[DataFrame, int]]
    root: DataFrame  # digest, one row


def build_manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, where: Column | None = None) -> Manifest:
    """Hash trees of ``docs``, whose columns are ``FIELDS``.

    Leaves are hashed in the scan.  Those of a source ascend by ``doc_id`` (null
    first; rows of one id by their digest), sources by their UTF-8 bytes (null first).
    The place of a leaf is found by range partitions and offsets, so a source that holds a
    third of all rows is spread over tasks like any other; blocks of 256 leaves meet in a
    task, and blocks of 4096 tops in each round above.

    ``tampered`` replaces columns where ``where`` holds: what a later reader finds there.
    """
    own = {c: F.col(c) for c in FIELDS}
    other = F.lit(None).cast("binary") if tampered is None else F.when(where, F.unhex(leaf(own | tampered)))
    leaves = cut(docs.select(F.col("source").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
                             F.unhex(leaf(own)).alias("digest"), other.alias("other"), F.lit(1).cast("long").alias("n")), "leaves")
    placed = ordered_sums(leaves, "grp", [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()], ["n"], "placed-leaves")
    nodes = placed.select("grp", F.col("before_n").alias("idx"), F.col("all_n").alias("total"), "digest", "other", "doc_id")
    rounds, tops = _climb(nodes, LEAF_LEVELS, "blocks")
    tops = tops.select("grp", "digest", F.lit(0).alias("all"), F.lit(1).cast("long").alias("n"))
    subroots = ordered_sums(tops, "all", [F.col("grp").asc_nulls_first()], ["n"], "subroots")
    subroots = cut(subroots.select("grp", F.col("before_n").alias("idx"), F.col("all_n").alias("total"), "digest"), "placed-subroots")
    above, root = _climb(subroots.select(F.lit("").alias("grp"), "idx", "total", "digest", F.lit(None).cast("binary").alias("other"),
                                         F.lit(None).cast("long").alias("doc_id")), UPPER_LEVELS, "sources")
    return Manifest(rounds, subroots, above, root.select("digest"))


def fold_proofs(manifest: Manifest) -> DataFrame:
    """One row a leaf: ``doc_id, source, leaf, subroot, root, proof_sha256`` (of its siblings,
    level by level, left to right), ``folded_root`` from what is found in the leaf's place, and
    ``verified``.  Siblings above a block are handed down, a block's row at a time."""
    hexed = F.lower(F.hex("digest")).cast("binary")
    none = F.array().cast("array<struct<left: binary, right: binary>>")
    top = manifest.root.select(F.lit("").alias("grp"), F.lit(0).cast("long").alias("idx"), none.alias("path"), hexed.alias("subroot"), hexed.alias("root"))
    of_sources = _descend(manifest.above, top, "sources").select(F.col("idx").alias("at"), "path", "root")
    paths = manifest.subroots.join(of_sources, F.col("idx") == F.col("at")).select(
        "grp", F.lit(0).cast("long").alias("idx"), "path", hexed.alias("subroot"), "root")
    paths = _descend(manifest.rounds[1:], paths, "blocks")
    blocks, levels = manifest.rounds[0]
    names = ["doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, total, digests, others, ids, path, subroot, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree = StateTree(digests, levels_of(total, levels))
                upper = [(hashlib.sha256(p["left"]), p["right"]) for p in path]
                rest = b"".join(p["left"] + p["right"] for p in path)
                found = others or digests
                proofs, folded, n = [], [], len(ids)
                for i in range(n):
                    h = hashlib.sha256(b"".join(x + y for x, y in tree.siblings(i)))
                    h.update(rest)
                    proofs.append(h.hexdigest())
                    now = tree.fold(i, found[i * HEX:(i + 1) * HEX])
                    for state, right in upper:
                        h = state.copy()
                        h.update(now + right)
                        now = h.hexdigest().encode()
                    folded.append(now.decode())
                leaves = [digests[i * HEX:(i + 1) * HEX].decode() for i in range(n)]
                same = lambda x: pa.array([x.decode()] * n, pa.string())
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([grp] * n, pa.string()), pa.array(leaves, pa.string()), same(subroot), same(root),
                                       pa.array(proofs, pa.string()), pa.array(folded, pa.string())], names=names)

    rows = _joined(blocks, paths).select("grp", "total", "digests", "others", "doc_ids", "path", "subroot", "root")
    out = rows.mapInArrow(run, "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def merkle_check(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` against a copy of them in which every document whose id's
    crc32 is divisible by 5 has its A-Z lower-cased: ``doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified``.

    Null fields are marked as such, so null and empty texts differ; a document without id is
    not tampered with.  Repeated rows are leaves of their own, next to each other; a lone
    document is its source's subroot.  An empty table gives no row.  Other columns are not read.
    """
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return fold_proofs(build_manifest(docs, {"text": ascii_lower(F.col("text"))}, hit)).drop("source")


def changed_documents(old: Manifest, new: Manifest) -> DataFrame:
    """``source, doc_id`` of the leaves that only ``old`` (``side`` -1) or only ``new`` (1) holds, read from
    the blocks whose digests differ; equal blocks are left out by their digest alone."""
    def blocks(m: Manifest) -> DataFrame:
        b, _ = m.rounds[0]
        return b.select("grp", "block", "digest", "digests", "doc_ids")

    def leaves(some: DataFrame, side: int) -> DataFrame:
        row = F.posexplode("doc_ids").alias("i", "doc_id")
        return some.select("grp", "digests", row).select(F.col("grp").alias("source"), "doc_id", F.substr(F.col("digests").cast("string"), F.col("i") * HEX + 1, F.lit(HEX)).alias("leaf"),
                                                         F.lit(side).alias("side"))

    a, b = blocks(old), blocks(new)
    same = [a["grp"].eqNullSafe(b["grp"]), a["block"] == b["block"], a["digest"] == b["digest"]]
    both = leaves(a.join(b, same, "left_anti"), -1).unionByName(leaves(b.join(a, same, "left_anti"), 1))
    return both.groupBy("source", "doc_id", "leaf").agg(F.sum("side").alias("side")).where("side != 0").select("source", "doc_id", "side")
