"""Completeness flags and the content-quality bucket."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from hirelake.functions.text import col_of, trim_ws


def has_text(c) -> Column:
    """True when the text is neither null nor blank."""
    return F.coalesce(trim_ws(c), F.lit("")) != F.lit("")


def is_complete(title="job_title", description="job_description",
                skills="skills_normalized") -> Column:
    """Curated-layer flag: a title and (a description or at least one skill)."""
    return is_complete_flags(has_text(title), has_text(description), skills)


def is_complete_flags(title, description, skills="skills_normalized") -> Column:
    """The same from flags taken earlier."""
    return col_of(title) & (col_of(description) | (F.size(col_of(skills)) > 0))


def is_complete_master(title="job_title", description="job_description", skills="skills") -> Column:
    """Master-table flag: like :func:`is_complete` but any non-NULL raw skills
    value counts (so '[]' or invalid text does)."""
    return has_text(title) & (has_text(description) | col_of(skills).isNotNull())


BUCKETS = ("missing_date", "missing_title", "thin_description", "ok")


def quality_bucket(posted_date="posted_date", title="job_title", description="job_description",
                   skills="skills_normalized") -> Column:
    """First failing check wins: missing_date > missing_title > thin_description > ok."""
    return (F.when(col_of(posted_date).isNull(), F.lit("missing_date"))
            .when(~has_text(title), F.lit("missing_title"))
            .when(~has_text(description) & (F.size(col_of(skills)) == 0), F.lit("thin_description"))
            .otherwise(F.lit("ok")))
