"""Report sink: write one question's answer as CSV or Parquet.

Unlike a count-then-repartition writer, this runs exactly one job: no
``count()`` is taken to size the output. Shuffle partitions of the answer
are already coalesced by AQE; ``rebalance=True`` adds a ``REBALANCE`` hint
for large unordered answers (it gives up the row order of a sorted answer).
Errors propagate to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "csv", partition_by=None,
                 mode: str = "overwrite", rebalance: bool = False,
                 max_records_per_file: int | None = None) -> None:
    out = df.hint("rebalance") if rebalance else df
    writer = out.write.mode(mode)
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        writer = writer.partitionBy(*cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if fmt == "csv":
        writer.option("header", "true").option("sep", ",").option("encoding", "UTF-8").csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported report format {fmt!r}")
