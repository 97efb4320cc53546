import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from titlelens.catalog import Catalog, TABLES  # noqa: E402
from titlelens.sources.schemas import SCHEMAS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from titlelens.session import DEFAULT_CONF
    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "4g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def make_catalog(spark):
    """Catalogue from literal rows: ``make_catalog(title_basics=[{...}], ...)``.
    Missing columns are null; tables not given are empty."""

    def build(**tables):
        frames = {}
        for table in TABLES:
            schema = SCHEMAS[table]
            rows = tables.get(table.replace(".", "_"), [])
            data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
            frames[table] = spark.createDataFrame(data, schema)
        return Catalog(frames)

    return build


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
