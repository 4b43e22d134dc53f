"""Which raw tables exist, and which relation to explore."""
from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

RAW_NAME = re.compile(r"^raw_[a-z0-9_]+$")
# Canonical raw tables of the four file sources, in union order.
RAW_TABLE_IDS = ("raw_huggingface_data_jobs", "raw_kaggle_data_engineer_2023",
                 "raw_kaggle_linkedin_postings", "raw_kaggle_linkedin_jobs_skills_2024")


def _q(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def present_sources(spark: SparkSession, candidates: Sequence[str] = RAW_TABLE_IDS,
                    database: str | None = None) -> list[str]:
    """The candidates that exist, in the candidates' order."""
    return [t for t in candidates if spark.catalog.tableExists(_q(t, database))]


def list_raw_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Every table or view named like ``raw_*``, sorted; with ``database`` only those stored in it."""
    names = {t.name for t in spark.catalog.listTables(database) if RAW_NAME.match(t.name) and not (database and t.isTemporary)}
    return sorted(names)


def bronze_models(spark: SparkSession, candidates: Sequence[str] = RAW_TABLE_IDS,
                  database: str | None = None) -> dict[str, DataFrame]:
    """``brz_<source>`` pass-through relations of the present raw tables."""
    return {"brz_" + t[len("raw_"):]: spark.table(_q(t, database))
            for t in present_sources(spark, candidates, database)}


def jobs_relation(spark: SparkSession, table: str | None = None, database: str | None = None,
                  master: str = "master_jobs") -> tuple[DataFrame, str]:
    """(relation, mode): the master table if present, else the only raw table,
    else the named raw table (which must match ``raw_*``)."""
    if table is None and spark.catalog.tableExists(_q(master, database)):
        return spark.table(_q(master, database)), "master_jobs"
    raw = list_raw_tables(spark, database)
    if table is not None:
        if not RAW_NAME.match(table):
            raise ValueError(f"invalid table id {table!r}")
        if table not in raw:
            raise ValueError(f"table {table!r} does not exist")
        return spark.table(_q(table, database)), "raw_pick"
    if not raw:
        raise RuntimeError("no master table and no raw_* tables: load data first")
    if len(raw) == 1:
        return spark.table(_q(raw[0], database)), "raw_single"
    raise ValueError(f"several raw tables, pick one of {raw}")
