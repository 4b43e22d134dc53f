"""Master table: the union of all raw tables, plain or cleaned."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelake.functions.flags import is_complete_master
from hirelake.operators.silver import union_all
from hirelake.schema import JOBS_SCHEMA


def master_union(raw_frames: list[DataFrame]) -> DataFrame:
    """Plain UNION ALL of the present raw tables."""
    return union_all(raw_frames, skills_as="json")


def master_clean(raw_frames: list[DataFrame]) -> DataFrame:
    """Union with every column cast to its type, NULL salary -> '' and the
    master completeness flag (any non-NULL skills value counts)."""
    u = union_all(raw_frames, skills_as="json")
    cols = []
    for f in JOBS_SCHEMA.fields:
        if f.name == "salary_info":
            cols.append(F.coalesce(F.col("salary_info"), F.lit("")).cast("string").alias("salary_info"))
        elif f.name == "skills":
            cols.append(F.col("skills"))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    clean = u.select(*cols)
    return clean.withColumn("is_complete", is_complete_master())


def master_complete(raw_frames: list[DataFrame]) -> DataFrame:
    """Only complete rows of the clean master."""
    return master_clean(raw_frames).where(F.col("is_complete"))
