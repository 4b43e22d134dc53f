"""Deduplication key of a posting.

The key is ``source#url-or-_nourl_#title#company#date#location`` with trimmed
parts.  ``concat`` propagates NULL, so an undated posting has a NULL key and all
undated postings of a source fall into one group, as in the original models.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from hirelake.functions.text import blank_to_null, col_of, trim_ws


def dedup_key(source_id="source_id", job_url="job_url", job_title="job_title",
              company_name="company_name", posted_date="posted_date",
              location="location", standard: bool = False) -> Column:
    """``standard`` parts are trimmed already, and null where blank."""
    sep, blank, trim = F.lit("#"), (col_of if standard else blank_to_null), (col_of if standard else trim_ws)
    return F.concat(
        col_of(source_id).cast("string"), sep,
        F.coalesce(blank(job_url), F.lit("_nourl_")), sep,
        F.coalesce(trim(job_title), F.lit("")), sep,
        F.coalesce(trim(company_name), F.lit("")), sep,
        col_of(posted_date).cast("string"), sep,
        F.coalesce(trim(location), F.lit("")),
    )


def fingerprint(key) -> Column:
    """64-bit fingerprint of the key; NULL key -> NULL (xxhash64 alone would
    map NULL to its seed)."""
    k = col_of(key)
    return F.when(k.isNotNull(), F.xxhash64(k))
