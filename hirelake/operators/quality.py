"""Data-quality jobs: raw table health, the strict gate, not-null counts."""
from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from hirelake.functions.text import col_of

# Raw table that may be absent without failing the strict gate.
OPTIONAL_RAW = ("raw_kaggle_linkedin_postings",)


def _qualified(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def raw_table_health(spark: SparkSession, tables: Sequence[str], database: str | None = None,
                     ts_col: str = "ingested_at") -> DataFrame:
    """Row count and latest ``ingested_at`` per table.  A missing table gives a
    row with ``error = 'not_found'``, one that cannot be analysed (no such
    column, unreadable) a row with its error; neither fails the job."""
    def unusable(name: str, why: str) -> DataFrame:
        return spark.range(1).select(
            F.lit(name).alias("table_name"), F.lit(None).cast(LongType()).alias("row_count"),
            F.lit(None).cast(TimestampNTZType()).alias("last_ingested"), F.lit(why).alias("error"))

    parts = []
    for t in tables:
        if not spark.catalog.tableExists(_qualified(t, database)):
            parts.append(unusable(t, "not_found"))
            continue
        try:
            parts.append(spark.table(_qualified(t, database)).agg(
                F.lit(t).alias("table_name"),
                F.count(F.lit(1)).cast(LongType()).alias("row_count"),
                F.max(F.col(ts_col).cast(TimestampNTZType())).alias("last_ingested"),
                F.lit(None).cast(StringType()).alias("error")))
        except AnalysisException as e:
            parts.append(unusable(t, e.getCondition() or "unreadable"))
    if not parts:
        raise ValueError("no tables to check")
    return reduce(lambda a, b: a.unionByName(b), parts)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scan answers counts and extremes from the files' footers."""
    s = spark.newSession()
    v1 = [x for x in s.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip() and x.strip() != "parquet"]
    s.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return s


def stored_health(spark: SparkSession, paths: Mapping[str, str], ts_col: str = "ingested_at") -> DataFrame:
    """:func:`raw_table_health` of stored Parquet tables, given as name -> path, without reading a row.

    Count and latest time are pushed into the scan, which takes them from the
    row groups' statistics.  That works for whole numbers but not for time
    stamps, so a time stamp without zone, which Spark stores as microseconds,
    is asked for as a number.  Times of other types are read.
    """
    reader = footer_session(spark)
    parts = []
    for name, path in paths.items():
        try:
            df, latest = reader.read.parquet(path), F.max(ts_col)
            if ts_col in df.columns and df.schema[ts_col].dataType == TimestampNTZType():
                whole = [StructField(f.name, LongType() if f.name == ts_col else f.dataType) for f in df.schema.fields]  # the scan goes by place
                df = reader.read.schema(StructType(whole)).parquet(path)
                latest = F.timestamp_add("MICROSECOND", latest, F.lit("1970-01-01 00:00:00").cast(TimestampNTZType()))
            got = df.agg(F.count(F.lit(1)).alias("row_count"), latest.alias("last_ingested"))
        except AnalysisException as e:
            why = "not_found" if e.getCondition() == "PATH_NOT_FOUND" else e.getCondition() or "unreadable"
            got = reader.range(1).select(F.lit(None).cast(LongType()).alias("row_count"), F.lit(None).alias("last_ingested"), F.lit(why).alias("error"))
        error = F.col("error").cast(StringType()) if "error" in got.columns else F.lit(None).cast(StringType())
        # files without a row group give no count, though the planner holds a count to be never null
        rows = F.when(error.isNull(), F.greatest("row_count", F.lit(0)))
        parts.append(got.select(F.lit(name).alias("table_name"), rows.cast(LongType()).alias("row_count"),
                                F.col("last_ingested").cast(TimestampNTZType()).alias("last_ingested"), error.alias("error")))
    if not parts:
        raise ValueError("no tables to check")
    return reduce(lambda a, b: a.unionByName(b), parts)


def quality_gate(health: DataFrame, as_of, max_age_hours: float | None = None,
                 ignore_stale: bool = False, optional: Iterable[str] = OPTIONAL_RAW) -> DataFrame:
    """Failures of the strict gate, one row each: (table_name, failure, age_hours).

    * missing table -> 'missing' (ignored for ``optional`` tables)
    * any other error -> 'error'
    * zero or unknown row count -> 'zero_rows'
    * ``now - last_ingested > max_age_hours`` -> 'stale' (skipped when the
      limit is 0/None or ``ignore_stale``)

    An empty result means the gate passes; the caller picks the exit status.
    """
    now = F.lit(str(as_of)).cast(TimestampNTZType())
    optional = list(optional)
    missing = F.coalesce(F.col("error") == "not_found", F.lit(False))
    broken = ~missing & F.col("error").isNotNull()
    age = F.timestamp_diff("MICROSECOND", F.col("last_ingested"), now).cast("double") / F.lit(3.6e9)
    null_age = F.lit(None).cast("double")
    checks = [
        F.when(missing & ~F.col("table_name").isin(optional) if optional else missing,
               F.struct(F.lit("missing").alias("failure"), null_age.alias("age_hours"))),
        F.when(broken, F.struct(F.lit("error").alias("failure"), null_age.alias("age_hours"))),
        F.when(~missing & ~broken & F.coalesce(F.col("row_count") == 0, F.lit(True)),
               F.struct(F.lit("zero_rows").alias("failure"), null_age.alias("age_hours"))),
    ]
    if max_age_hours and not ignore_stale:
        checks.append(F.when(~missing & F.col("last_ingested").isNotNull() & (age > F.lit(float(max_age_hours))),
                             F.struct(F.lit("stale").alias("failure"), F.bround(age, 1).alias("age_hours"))))
    found = health.select("table_name", F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("f"))
    return found.select("table_name", F.col("f.failure").alias("failure"), F.col("f.age_hours").alias("age_hours"))


def not_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) for each column, from one pass over the data."""
    agg = df.agg(*[F.count_if(col_of(c).isNull()).cast(LongType()).alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column_name", "null_rows")


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise when any of the columns holds a NULL (a model test)."""
    bad = not_null_counts(df, columns).where(F.col("null_rows") > 0).collect()
    if bad:
        raise AssertionError("not_null failed: " + ", ".join(f"{r.column_name}={r.null_rows}" for r in bad))
