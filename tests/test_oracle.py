"""Every registered query against its DuckDB oracle on the smallest tables."""
from conftest import SF_SMALL

from hirelake.plans.queries import ORACLES, QUERIES
from oracle_check import compare


def test_all_queries_match_oracle(spark):
    assert compare(spark, SF_SMALL) == []


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert set(df.columns) == {"skill", "job_postings", "source_count"} and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())
