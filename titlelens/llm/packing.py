"""Best-fit packing of token sequences with certified bin counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import cut, small_batches
from titlelens.llm.encoder import encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
_PACKED = _PIECES + ", part int, bin long, at long, fill long"
#: Texts that an encoding task holds at a time.
BATCH_ROWS = 500


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text plus ``end_id``: only documents longer
    than ``capacity`` are cut, into pieces of that size and a last one.
    ``uid`` numbers the pieces.  A null text is empty: one piece, the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        end = np.array([end_id], "<u4")
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate((enc.encode(text), end), dtype="<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    for col, v in zip(cols, (i, k, at, len(part), zlib.crc32(part.tobytes()), uid), strict=True):
                        col.append(v)
                    uid += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                  names=[c.split()[0] for c in _PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, _PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin.  Open bins are
    kept by free space; bit ``s`` of ``free`` says that one has ``s`` left."""
    order = np.argsort(-lengths, kind="stable")
    bins, at = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_free: dict[int, list[int]] = {}
    free, fills = 0, []
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fit = free >> size
        if fit:
            space = size + (fit & -fit).bit_length() - 1
            stack = by_free[space]
            b = stack.pop()
            if not stack:
                free &= ~(1 << space)
        else:
            b, space = len(fills), capacity
            fills.append(0)
        bins[i], at[i] = b, capacity - space
        fills[b] = capacity - space + size
        space -= size
        if space:
            by_free.setdefault(space, []).append(b)
            free |= 1 << space
    return bins, at, np.array(fills, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions
    over the histogram of lengths: one rounds an item to the number of
    ``1 / (k + 1)`` shares it exceeds, the other counts items beyond
    ``capacity - e`` as whole bins and drops those below ``e``."""
    size, count = np.unique(lengths, return_counts=True)
    if not len(size):
        return 0
    best = -(-int((size * count).sum()) // capacity)
    for k in range(1, 21):
        share = size * (k + 1)
        whole = share % capacity == 0
        # in k-ths of a bin: an exact multiple keeps its size, any other counts its whole shares
        units = np.where(whole, size * k, share // capacity * capacity)
        best = max(best, -(-int((units * count).sum()) // (k * capacity)))
    for e in size[size <= capacity // 2].tolist():
        units = np.where(size > capacity - e, capacity, np.where(size < e, 0, size))
        best = max(best, -(-int((units * count).sum()) // capacity))
    return best


def _pack_round(pieces: DataFrame, capacity: int, parts: int, salt: int) -> DataFrame:
    """Best-fit decreasing in each of ``parts`` partitions.  ``settled`` says
    that the piece's bin stays: its partition meets its bound (all but its
    emptiest bin, which may still merge with another partition's), or
    the bin is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        lengths = table["length"].to_numpy()
        bins, at, fills = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        stays = fills == capacity
        if len(fills) == bound:
            stays[:] = True
        stays[np.argmin(fills)] = fills.min() == capacity
        n = len(lengths)
        out = table.append_column("part", pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)))
        for name, col in (("bin", bins), ("at", at), ("fill", fills[bins]), ("settled", stays[bins])):
            out = out.append_column(name, pa.array(col))
        yield from out.to_batches()

    dealt = pieces.repartition(parts, F.xxhash64("uid", F.lit(salt))).sortWithinPartitions("uid")
    return dealt.mapInArrow(run, _PACKED + ", settled boolean")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", part_pieces: int = 100_000, max_rounds: int = 6) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as can be
    found: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Pieces of full length are sequences of their own.  The others are dealt to
    partitions of about ``part_pieces`` and packed best-fit decreasing; a
    partition whose bin count equals its dual-feasible bound is certified.
    The documents of partitions with a gap, and the emptiest bin of each
    certified one, are exchanged: dealt anew, by another hash, to fewer
    partitions, and repacked.  A round that saves no bin is not taken and
    ends the exchange, as does one that had a single partition.  Only sizes
    and ids move; texts never leave the scan's task.

    Null texts are empty and still hold the end id; null ids stay null;
    repeated rows are packed each; an empty table packs to nothing.
    """
    with small_batches(docs.sparkSession, BATCH_ROWS):
        pieces = cut(cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    open_ = pieces.where(F.col("length") < capacity)
    n = open_.count()
    done, last = [], None
    for r in range(max_rounds):
        if n == 0:
            break
        parts = max(1, -(-n // part_pieces))
        now = cut(_pack_round(open_, capacity, parts, r).withColumn("round", F.lit(r)), f"packed-{r}")
        kinds = {x["settled"]: x for x in now.groupBy("settled").agg(
            F.count("*").alias("n"), F.sum((F.col("at") == 0).cast("long")).alias("bins")).collect()}
        bins = sum(x["bins"] for x in kinds.values())
        if last is not None and bins >= last[1]:
            break  # the packing before the exchange was as good
        if last is not None:
            done.append(last[0].where("settled"))
        last = (now, kinds[False]["bins"] if False in kinds else 0)
        n = kinds[False]["n"] if False in kinds else 0
        open_ = now.where("not settled").select(*[c.split()[0] for c in _PIECES.split(", ")])
        if parts == 1 or last[1] <= 1:
            break
    cols = [F.col(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    out = whole.select(*cols, (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if last is not None:
        done.append(last[0])
    for d in done:
        # 6 bits of round, 21 of partition and 36 of bin: distinct from each other, and the full pieces are negative
        seq = (F.shiftleft(F.col("round").cast("long"), 57) + F.shiftleft(F.col("part").cast("long"), 36) + F.col("bin"))
        out = out.unionByName(d.select(*cols, seq.alias("sequence_id"), F.col("at").alias("offset")))
    return out
