"""Row predicates: recency window, data-domain test, explore filters."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hirelake.functions.dates import as_date_literal, cutoff
from hirelake.functions.text import col_of, not_blank, once, trim_ws
from hirelake.functions.vocab import DOMAIN_JOB_TITLES, DOMAIN_KEYWORDS, RECENT_DAYS


def is_recent(posted_date="posted_date", as_of=None, days: int = RECENT_DAYS) -> Column:
    """posted_date >= as_of - days (inclusive); NULL dates are not recent.

    ``as_of`` defaults to today (UTC); pin it for repeatable results.
    """
    from hirelake.functions.dates import today_utc
    return F.coalesce(col_of(posted_date) >= cutoff(as_of or today_utc(), days), F.lit(False))


def recent_postings(df: DataFrame, as_of=None, days: int = RECENT_DAYS) -> DataFrame:
    return df.where(is_recent("posted_date", as_of, days))


def domain_text(title="job_title", description="job_description", skills=None) -> Column:
    """Lowercased 'title description skill skill ...' of the non-empty parts.

    The skills array is passed straight to ``concat_ws`` so an empty list adds
    nothing (a nested join would leave a trailing space behind).
    """
    parts = [F.filter(F.array(col_of(title), col_of(description)), lambda x: x != F.lit(""))]
    if skills is not None:
        parts.append(col_of(skills))
    return F.lower(F.concat_ws(" ", *parts))


def any_substring(text: Column, words: list[str]) -> Column:
    """Whether any of the words occurs; those that begin alike are only looked for where their first part occurs."""
    groups: dict[str, list[str]] = {}
    for w in words:
        groups.setdefault(w[:w.find(" ") + 1] or w, []).append(w)
    tests = []
    for first, members in groups.items():
        hits = reduce(lambda a, b: a | b, [text.contains(w) for w in members])
        tests.append(text.contains(first) & hits if len(members) > 1 else hits)
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def is_data_domain(title="job_title", description="job_description", skills=None,
                   job_title_short=None, keywords=None, titles=None) -> Column:
    """Exact short title in the list, or any keyword as a substring of the text."""
    keywords = DOMAIN_KEYWORDS if keywords is None else keywords
    titles = DOMAIN_JOB_TITLES if titles is None else titles
    text = domain_text(title, description, skills)
    # Byte-level substring tests on the UTF-8 text.  (One regex alternation
    # over the same text measured slower: it converts every text to a Java
    # string and tries each alternative at every position.)
    by_kw = once(text, lambda t: any_substring(t, [k.lower() for k in keywords]))
    result = by_kw
    if job_title_short is not None and titles:
        by_title = F.coalesce(trim_ws(job_title_short).isin(list(titles)), F.lit(False))
        result = by_title | by_kw
    return F.coalesce(result, F.lit(False))


def search_pattern(search: str) -> str:
    """LIKE pattern of a search box value; '%' and '_' typed by the user stay wildcards."""
    return f"%{search.strip().lower()}%"


def search_predicate(search: str, title="job_title", description="job_description") -> Column:
    """lower(title || description) LIKE '%search%' (no separator between the two)."""
    hay = F.lower(F.concat(F.coalesce(col_of(title), F.lit("")), F.coalesce(col_of(description), F.lit(""))))
    return hay.like(search_pattern(search))


def explore_predicate(sources=None, date_from=None, date_to=None, search: str | None = None) -> Column:
    """Conjunction of the optional explore filters (all omitted -> TRUE)."""
    preds: list[Column] = []
    if sources:
        preds.append(F.col("source_id").isin(list(sources)))
    if date_from is not None:
        preds.append(F.col("posted_date") >= as_date_literal(date_from))
    if date_to is not None:
        preds.append(F.col("posted_date") <= as_date_literal(date_to))
    if search is not None and search.strip():
        preds.append(search_predicate(search))
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def explore_filter(df: DataFrame, sources=None, date_from=None, date_to=None,
                   search: str | None = None) -> DataFrame:
    return df.where(explore_predicate(sources, date_from, date_to, search))


def has_title_or_description(title="job_title", description="job_description") -> Column:
    return not_blank(title) | not_blank(description)
