import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hirelake.session import get_session
    scratch = tempfile.mkdtemp(prefix="hirelake-tests-")
    s = get_session("local[4]", app_name="hirelake-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                           "spark.checkpoint.dir": os.path.join(scratch, "checkpoints")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="hirelake-t-")


def one(spark, expr, value, dtype="string"):
    """Evaluate a Column expression over a one-row frame holding ``value``."""
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(__import__("pyspark.sql.functions", fromlist=["col"]).col("v")).alias("r")).first().r


def canon_frame(spark, rows):
    """Canonical raw rows from dicts (missing keys -> NULL)."""
    import datetime as dt
    from hirelake.schema import JOBS_SCHEMA
    base = {"source_id": "s1", "source_name": "S1", "ingested_at": dt.datetime(2024, 1, 1)}
    data = []
    for r in rows:
        full = dict(base)
        full.update(r)
        data.append(tuple(full.get(f.name) for f in JOBS_SCHEMA.fields))
    return spark.createDataFrame(data, JOBS_SCHEMA)
