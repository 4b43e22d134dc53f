"""Gold layer: curated postings and the three marts."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelake.functions.dates import month_start
from hirelake.functions.flags import is_complete, is_complete_flags, quality_bucket


def curate(dedup: DataFrame, keep=()) -> DataFrame:
    """Deduplicated postings plus skill_count, is_complete and the quality bucket."""
    return dedup.select(*keep,
        "source_id", "source_name", "job_title", "job_description", "company_name", "location",
        "posted_date", "job_url", "job_url_normalized", "skills_normalized",
        F.size("skills_normalized").cast("long").alias("skill_count"),
        "salary_info", "ingested_at",
        is_complete().alias("is_complete"),
        quality_bucket().alias("content_quality_bucket"),
    )


def posting_volume(dedup: DataFrame) -> DataFrame:
    """Postings and complete postings per (source, month); undated rows excluded.

    Deduplicated rows carry their text flags, so the texts are not read again."""
    flagged = {"_has_title", "_has_description"} <= set(dedup.columns)
    complete = is_complete_flags("_has_title", "_has_description") if flagged else is_complete()
    return (dedup.where(F.col("posted_date").isNotNull())
                 .groupBy("source_id", month_start("posted_date").alias("posting_month"))
                 .agg(F.count(F.lit(1)).alias("job_postings"),
                      F.count_if(complete).alias("complete_postings")))


def skill_demand(skills_long: DataFrame) -> DataFrame:
    """Postings per skill (a skill listed twice counts twice) and its source count.

    Two hash aggregations, both with map-side partial aggregation: first per
    (skill, source), then per skill.  A skill held by a third of all postings
    is pre-aggregated before it is shuffled.
    """
    per_source = skills_long.groupBy("skill", "source_id").agg(F.count(F.lit(1)).alias("n"))
    return per_source.groupBy("skill").agg(F.sum("n").cast("long").alias("job_postings"),
                                           F.count(F.lit(1)).alias("source_count"))


def cross_source_urls(dedup: DataFrame) -> DataFrame:
    """Normalized URLs that appear in more than one source."""
    per_source = (dedup.where(F.col("job_url_normalized").isNotNull())
                       .groupBy("job_url_normalized", "source_id").agg(F.count(F.lit(1)).alias("n")))
    return (per_source.groupBy("job_url_normalized")
                      .agg(F.sum("n").cast("long").alias("row_count"),
                           F.count(F.lit(1)).alias("distinct_sources"))
                      .where(F.col("distinct_sources") > 1))


def source_row_counts(curated: DataFrame) -> DataFrame:
    """Rows per source, most first."""
    return (curated.groupBy("source_id").agg(F.count(F.lit(1)).alias("job_count"))
                   .orderBy(F.col("job_count").desc(), F.col("source_id").asc_nulls_last()))
