"""The canonical 11-column posting row and the projection that enforces it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, DateType, StringType, StructField, StructType,
                               TimestampNTZType)

TEXT_COLUMNS = ("job_title", "job_description", "company_name", "location", "job_url", "salary_info")

JOBS_SCHEMA = StructType([
    StructField("source_id", StringType(), False),
    StructField("source_name", StringType(), False),
    StructField("job_title", StringType(), True),
    StructField("job_description", StringType(), True),
    StructField("company_name", StringType(), True),
    StructField("location", StringType(), True),
    StructField("posted_date", DateType(), True),
    StructField("job_url", StringType(), True),
    StructField("skills", StringType(), True),       # JSON text; array<string> also accepted
    StructField("salary_info", StringType(), True),
    StructField("ingested_at", TimestampNTZType(), False),
])
JOBS_COLUMNS = tuple(f.name for f in JOBS_SCHEMA.fields)
REQUIRED = ("source_id", "source_name")


def _skills_column(df: DataFrame, skills_as: str) -> Column:
    if "skills" not in df.columns:
        return F.lit(None).cast(StringType() if skills_as == "json" else ArrayType(StringType()))
    dtype = df.schema["skills"].dataType
    c = F.col("skills")
    if skills_as == "keep":
        return c
    if skills_as == "array":
        if isinstance(dtype, ArrayType):
            return c.cast(ArrayType(StringType()))
        raise TypeError("skills is text; normalize it with functions.skills.normalize_skills")
    return F.to_json(c) if isinstance(dtype, ArrayType) else c.cast("string")


def conform(df: DataFrame, skills_as: str = "json", on_invalid: str = "error",
            ingested_at: Column | None = None, keep: dict[str, str] | None = None) -> DataFrame:
    """Project any frame onto the canonical columns, in canonical order and types.

    * Missing optional columns become NULL; extra columns are dropped, but for those in ``keep`` (new name -> column).
    * ``skills`` is stored as JSON text (``skills_as='json'``), kept as is
      (``'keep'``) or required to be a list (``'array'``).
    * ``ingested_at`` defaults to the local clock when absent.
    * Rows without ``source_id`` / ``source_name`` fail the job
      (``on_invalid='error'``) or are dropped (``'drop'``).
    """
    cols = set(df.columns)
    out = []
    for f in JOBS_SCHEMA.fields:
        if f.name == "skills":
            out.append(_skills_column(df, skills_as).alias("skills"))
        elif f.name == "ingested_at":
            src = F.col("ingested_at").cast(TimestampNTZType()) if "ingested_at" in cols else None
            default = ingested_at if ingested_at is not None else F.localtimestamp()
            out.append((F.coalesce(src, default) if src is not None else default).alias("ingested_at"))
        elif f.name in cols:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    projected = df.select(*out, *[F.col(c).alias(n) for n, c in (keep or {}).items()])
    missing = F.col("source_id").isNull() | F.col("source_name").isNull()
    if on_invalid == "drop":
        return projected.where(~missing)
    if on_invalid == "error":
        checked = F.when(missing, F.raise_error(F.lit("canonical row without source_id/source_name"))) \
            .otherwise(F.col("source_id"))
        return projected.withColumn("source_id", checked)
    return projected
