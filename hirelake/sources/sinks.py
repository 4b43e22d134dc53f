"""Writers: the Parquet lake, raw tables, the master table, partitioned marts, CSV exports."""
from __future__ import annotations

import logging
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType
from pyspark.errors import AnalysisException

from hirelake.functions.dates import as_date_literal, month_start
from hirelake.functions.sql import sql_literal
from hirelake.functions.vocab import WHITESPACE
from hirelake.schema import JOBS_SCHEMA, conform
from hirelake.sources.versions import Lake, VersionedTable, read_drifted

log = logging.getLogger(__name__)

#: Error conditions that mean there is nothing to read; all others are raised.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_lake(df: DataFrame, base: str, dataset: str) -> str:
    """Replace the lake's rows of a dataset with the canonical rows as Parquet; the path of the new version.

    Readers see the old rows until the new ones are complete (see ``sources.versions``).
    """
    lake = Lake(df.sparkSession, base)
    lake.publish({dataset: lake.stage(dataset, conform(df, skills_as="keep"))})
    return lake.path(dataset)


def _raw_versions(spark: SparkSession, table: str, table_root: str | None) -> VersionedTable:
    root = table_root or spark.conf.get("spark.sql.warehouse.dir") + "/versions"
    return VersionedTable(spark, f"{root.rstrip('/')}/{table}")


def stored_raw_table(spark: SparkSession, table: str, table_root: str | None = None) -> DataFrame:
    """The rows of a raw table straight from its current version's files; of a table that was not loaded so, the table."""
    versions = _raw_versions(spark, table, table_root)
    return versions.read() if versions.current() else spark.table(table)


def load_raw_table(spark: SparkSession, base: str, dataset: str, table: str,
                   table_root: str | None = None) -> bool:
    """Truncate-and-replace ``table`` from every Parquet file of the dataset's
    current version.  No files -> warn and leave the table untouched.

    The files need not have one schema: columns are matched by name and
    drifted types widened.  The rows are staged as a new version of the table
    and become visible in one step, so a load that fails leaves the old ones.
    The table is a view of its current version: in the session catalog, with
    versions under the warehouse, or with ``table_root`` a temporary view, with
    versions under ``<table_root>/<table>``.
    """
    path = Lake(spark, base).path(dataset)
    try:
        df = read_drifted(spark, path)
    except AnalysisException as e:
        if e.getCondition() not in ABSENT:
            raise
        log.warning("no Parquet files under %s (%s); %s left as is", path, e.getMessage()[:80], table)
        return False
    current = _raw_versions(spark, table, table_root).replace(df)
    if table_root:
        spark.read.parquet(current).createOrReplaceTempView(table)
    else:
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM parquet.`{current}`")
    return True


# ---- master table: view, empty table, refresh ---------------------------------------------------

def create_master_view(spark: SparkSession, df: DataFrame, name: str = "master_jobs") -> None:
    df.createOrReplaceTempView(name)


def _master_sql(spark: SparkSession, table: str) -> str:
    """The clean master projection of one raw table, as SQL."""
    have = {f.name: f.dataType for f in spark.table(table).schema.fields}
    text = lambda c: f"coalesce(trim(BOTH {sql_literal(WHITESPACE)} FROM {c}), '')"
    columns = {}
    for f in JOBS_SCHEMA.fields:
        value = "NULL" if f.name not in have else f"to_json({f.name})" if f.name == "skills" and isinstance(have["skills"], ArrayType) else f.name
        columns[f.name] = f"CAST({value} AS {f.dataType.simpleString()})"
    columns["salary_info"] = f"coalesce({columns['salary_info']}, '')"
    complete = (f"{text(columns['job_title'])} != '' AND ({text(columns['job_description'])} != '' OR {columns['skills']} IS NOT NULL)")
    return f"SELECT {', '.join(f'{c} AS {n}' for n, c in columns.items())}, {complete} AS is_complete FROM {table}"


def create_persistent_master_view(spark: SparkSession, tables: Sequence[str], name: str = "master_jobs") -> None:
    """The clean master over the raw tables given, as a view stored in the catalog.

    The view is SQL text over the tables' names: every session sees it, and it
    follows the tables when they are loaded again.  The tables must be stored
    in the catalog too (a view cannot be built on temporary ones).
    """
    if not tables:
        raise ValueError("no source tables are present: nothing to union")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + " UNION ALL ".join(_master_sql(spark, t) for t in tables))


def create_master_table(spark: SparkSession, df: DataFrame, name: str = "master_jobs") -> bool:
    """Create the table empty (schema only) unless it exists."""
    if spark.catalog.tableExists(name):
        return False
    df.limit(0).write.saveAsTable(name)
    return True


def refresh_master_table(spark: SparkSession, df: DataFrame, name: str = "master_jobs") -> None:
    """Replace the rows of an existing table; a missing table is an error."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist: create it first")
    df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


# ---- partitioned, clustered marts -----------------------------------------------------------------

def write_partitioned(df: DataFrame, path: str, date_col: str, cluster_by=(), month_col: str | None = None,
                      mode: str = "overwrite") -> str:
    """Write one folder per month of ``date_col`` (NULL dates go to the
    default partition), rows sorted by the cluster columns inside each file.

    ``REBALANCE`` on the month lets AQE split a month that holds a large share
    of the rows into several tasks instead of one straggler.
    """
    month_col = month_col or f"{date_col}_month"
    with_month = df.withColumn(month_col, month_start(date_col)) if month_col not in df.columns else df
    ordered = with_month.hint("rebalance", month_col).sortWithinPartitions(month_col, *cluster_by)
    ordered.write.mode(mode).partitionBy(month_col).parquet(path)
    return path


def read_partitioned(spark: SparkSession, path: str, date_col: str, date_from=None, date_to=None,
                     month_col: str | None = None) -> DataFrame:
    """Read a month-partitioned mart for a date range, pruning folders.

    A filter on the date alone cannot prune month folders, so the matching
    month predicate is added next to it."""
    month_col = month_col or f"{date_col}_month"
    df = spark.read.parquet(path)
    if date_from is not None:
        df = df.where((F.col(month_col) >= month_start(as_date_literal(date_from)))
                      & (F.col(date_col) >= as_date_literal(date_from)))
    if date_to is not None:
        df = df.where((F.col(month_col) <= month_start(as_date_literal(date_to)))
                      & (F.col(date_col) <= as_date_literal(date_to)))
    return df


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with a header.  ``single_file`` is for small, already limited
    results (a browse list, a comparison sample) only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
