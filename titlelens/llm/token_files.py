"""Token files: one concatenated id array a shard, document boundaries and
document ids in Elias-Fano form behind it."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.llm import elias_fano
from titlelens.llm.common import fresh_path
from titlelens.llm.encoder import encoder

MAGIC = b"TLIDS001"
#: id bytes; documents; ids; documents without id; smallest id; places of the two sequences; magic
_TAIL = "<BQQQqQQ8s"
_CHUNK = 1 << 20


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _tail(width: int, n_tokens: int, ids: list, lengths: list) -> bytes:
    nulls = sum(i is None for i in ids)  # nulls sort first
    base = ids[nulls] if nulls < len(ids) else 0
    starts = np.concatenate(([0], np.cumsum(np.array(lengths, np.uint64), dtype=np.uint64)))
    bounds = elias_fano.encode(starts)
    keys = elias_fano.encode(np.array([i - base for i in ids[nulls:]], np.uint64))
    at = n_tokens * width
    return bounds + keys + struct.pack(_TAIL, width, len(ids), n_tokens, nulls, base, at, at + len(bounds), MAGIC)


class TokenFile:
    """Random access to one shard."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        head = self.file.read_at(struct.calcsize(_TAIL), size - struct.calcsize(_TAIL))
        self.width, self.n_docs, self.n_tokens, self.nulls, self.base, b, k, magic = struct.unpack(_TAIL, head)
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        self.bounds = elias_fano.Sequence(self.file.read_at(k - b, b))
        self.keys = elias_fano.Sequence(self.file.read_at(size - struct.calcsize(_TAIL) - k, k))

    def doc_ids(self, lo: int, hi: int) -> list:
        nulls = max(0, min(hi, self.nulls) - lo)
        keys = self.keys.select(max(lo, self.nulls) - self.nulls, max(hi, self.nulls) - self.nulls)
        return [None] * nulls + [int(x) + self.base for x in keys]

    def ids(self, start: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - start) * self.width, start * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds.select(i, i + 2)
        return self.ids(int(start), int(end))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Encode every whole text, add ``end_id``, and write shards to ``path`` in
    ascending id order.  Returns the manifest: ``shard, uri, n_docs, n_tokens, base``.

    Texts are dealt out by ranges of (id, text hash, row number), so an id
    that a third of all rows carry is spread over shards like any other.  A shard is
    streamed to a temporary name and moved into place, so a repeated attempt
    leaves the same file.  Null texts are empty, null ids sort first, rows
    of one id keep their multiplicity; an empty table gives no shard.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("h"), F.monotonically_increasing_id().alias("r"))
    keys = ("id", "h", "r")
    rows = rows.repartitionByRange(shards, *keys) if shards else rows.repartitionByRange(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        fs, root = _filesystem(path)
        final, temp = f"{root}/shard-{shard:06d}.ids", f"{root}/.shard-{shard:06d}.{uuid.uuid4().hex}"
        enc, out, ids, lengths = encoder(tokenizer), None, [], []
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            if out is None and batch.num_rows:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(temp)
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = enc.encode(text)
                out.write(got.tobytes() + end)
                ids.append(i)
                lengths.append(len(got) + 1)
        if out is None:
            return
        width = np.dtype(enc.dtype).itemsize
        out.write(_tail(width, sum(lengths), ids, lengths))
        out.close()
        if fs.get_file_info(final).type != pafs.FileType.NotFound:
            fs.delete_file(final)
        fs.move(temp, final)
        yield pa.RecordBatch.from_pylist([{"shard": shard, "uri": f"{path}/shard-{shard:06d}.ids",
                                           "n_docs": len(ids), "n_tokens": sum(lengths)}])

    done = (rows.sortWithinPartitions("id", "h", "r").select("id", "text")
            .mapInArrow(write, "shard long, uri string, n_docs long, n_tokens long"))
    base, manifest = 0, []
    for r in sorted(done.collect()):  # one row a shard
        manifest.append((*r, base))
        base += r["n_tokens"]
    out = docs.sparkSession.createDataFrame(manifest, "shard long, uri string, n_docs long, n_tokens long, base long")
    out.coalesce(1).write.parquet(f"{path}/manifest")
    return out


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row a document of the files under ``path``: ``doc_id, start`` (ids
    before it in all shards), ``n_tokens, ids_crc32``; one task a shard."""
    manifest = spark.read.parquet(f"{path}/manifest")
    n = manifest.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = TokenFile(uri)
                lo = 0
                while lo < shard.n_docs:
                    hi = min(lo + 4096, shard.n_docs)
                    bounds = shard.bounds.select(lo, hi + 1).astype(np.int64)
                    crcs, at, ids = [], 0, shard.ids(0, 0)
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                        if b > at + len(ids) or a < at:
                            at = int(a)
                            ids = shard.ids(at, max(int(b), min(at + _CHUNK, int(bounds[-1]))))
                        crcs.append(zlib.crc32(ids[a - at:b - at].astype("<u4").tobytes()))
                    yield pa.record_batch([pa.array(shard.doc_ids(lo, hi), pa.int64()), pa.array(bounds[:-1] + base),
                                           pa.array(np.diff(bounds)), pa.array(crcs, pa.int64())],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    lo = hi

    return (manifest.select("uri", "base", "shard").repartitionByRange(max(1, n), "shard").select("uri", "base")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write ``docs`` as token files (to a fresh place in the shared folder
    unless ``path`` is given) and read them back."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(spark, path)
