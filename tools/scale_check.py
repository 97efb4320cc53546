"""Scaling check: every question over the derived catalogue and over a
k-fold copy of it.

The copy suffixes every id with the copy number (ids inside multi-value
lists too), so each copy keeps the join structure, while shared values
(genres, regions, languages, names, years) get k times hotter. Both
catalogues are written once as Parquet under a fresh scratch directory;
the questions then run with one action each (noop sink, median of 3).

usage: python tools/scale_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from titlelens.catalog import Catalog  # noqa: E402
from titlelens.plans.registry import QUESTIONS  # noqa: E402
from titlelens.session import local_session  # noqa: E402
from titlelens.sources import derive_catalog, read_catalog, write_catalog  # noqa: E402

ID_COLUMNS = {
    "title.basics": ["tconst"], "title.ratings": ["tconst"], "title.crew": ["tconst"],
    "title.episode": ["tconst", "parentTconst"], "title.principals": ["tconst", "nconst"],
    "title.akas": ["titleId"], "name.basics": ["nconst"],
}
LIST_COLUMNS = {"title.crew": ["directors", "writers"], "name.basics": ["knownForTitles"]}


def copied(cat: Catalog, copies: int) -> Catalog:
    frames = {}
    for table, df in cat.items():
        c = F.col("__copy").cast("string")
        out = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        for col in ID_COLUMNS.get(table, []):
            out = out.withColumn(col, F.concat(F.col(col), F.lit("_"), c))
        for col in LIST_COLUMNS.get(table, []):
            out = out.withColumn(col, F.concat_ws(",", F.transform(F.split(F.col(col), ","),
                                                                   lambda e: F.concat(e, F.lit("_"), c))))
            out = out.withColumn(col, F.when(F.col(col) == "", None).otherwise(F.col(col)))
        frames[table] = out.drop("__copy")
    return Catalog(frames)


def timed(cat: Catalog, reps: int = 3) -> dict:
    out = {}
    for name, q in QUESTIONS.items():
        def run():
            t0 = time.perf_counter()
            q(cat).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        run()
        out[name] = round(statistics.median(run() for _ in range(reps)), 3)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
    # argv[3]: a folder that all executors share, on a cluster
    scratch = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="titlelens-scale-")
    base = derive_catalog(spark, sf_dir, reuse=False)
    write_catalog(base, f"{scratch}/x1", partitions=8)
    t0 = time.perf_counter()
    write_catalog(copied(read_catalog(spark, f"{scratch}/x1", fmt="parquet"), copies), f"{scratch}/x{copies}",
                  partitions=8 * copies)
    build = time.perf_counter() - t0
    one = read_catalog(spark, f"{scratch}/x1", fmt="parquet", strict=True)
    many = read_catalog(spark, f"{scratch}/x{copies}", fmt="parquet", strict=True)
    rows1 = {t: df.count() for t, df in one.items()}
    rowsk = {t: df.count() for t, df in many.items()}
    t1, tk = timed(one), timed(many)
    print(json.dumps({"copies": copies, "build_sec": round(build, 1), "rows_x1": rows1, "rows_xk": rowsk,
                      "total_x1": round(sum(t1.values()), 2), "total_xk": round(sum(tk.values()), 2),
                      "x1": t1, "xk": tk}))


if __name__ == "__main__":
    main()
