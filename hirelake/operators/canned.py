"""Whitelisted canned queries.

A query is a function of the context's relations and of at most one whole
number, described by a :class:`Number`.  :func:`run_canned` reads and bounds
that number; the query functions themselves honour any value.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Callable

from pyspark.sql import DataFrame, functions as F

from hirelake.functions.dates import months_back_start, today_utc
from hirelake.functions.vocab import (RECENT_MONTHS_DEFAULT, RECENT_MONTHS_MAX, RECENT_MONTHS_MIN,
                                      TOP_SKILLS_DEFAULT, TOP_SKILLS_MAX, TOP_SKILLS_MIN)
from hirelake.operators.gold import source_row_counts
from hirelake.operators.quality import raw_table_health


@dataclass(frozen=True)
class Number:
    """A whole-number argument: what stands in for unreadable input, and its bounds."""
    name: str
    default: int
    least: int
    most: int

    def read(self, given: Any) -> int:
        text = str(given).strip() if isinstance(given, (str, int, float)) else ""
        try:
            number = int(given) if not isinstance(given, str) else int(text)
        except (TypeError, ValueError, OverflowError):
            number = self.default
        return min(max(number, self.least), self.most)


def top_skills(skill_demand: DataFrame, limit: int = TOP_SKILLS_DEFAULT) -> DataFrame:
    """Top skills by postings; ties by name.  Planned as a distributed top-k."""
    return skill_demand.orderBy(F.col("job_postings").desc(), F.col("skill").asc()).limit(int(limit)) \
        .select("skill", "job_postings", "source_count")


def recent_volume(posting_volume: DataFrame, months: int = RECENT_MONTHS_DEFAULT, as_of=None) -> DataFrame:
    """Volume rows from the month ``months`` before as_of's month onward
    (so ``months + 1`` calendar months), newest first."""
    start = months_back_start(as_of or today_utc(), int(months))
    return posting_volume.where(F.col("posting_month") >= start) \
        .orderBy(F.col("posting_month").desc(), F.col("source_id").asc())


@dataclass(frozen=True)
class Canned:
    build: Callable[..., DataFrame]
    needs: tuple[str, ...]
    wants: tuple[str, ...] = ()
    number: Number | None = None

    def run(self, context: dict, arguments: dict) -> DataFrame:
        """``needs`` are passed in order, ``wants`` by name where the context has them."""
        given = {k: context[k] for k in self.wants if k in context}
        if self.number:
            given[self.number.name] = self.number.read(arguments.get(self.number.name, self.number.default))
        return self.build(*(context[k] for k in self.needs), **given)


CANNED = {
    "source_row_counts": Canned(source_row_counts, ("curated",)),
    "top_skills": Canned(top_skills, ("skill_demand",),
                         number=Number("limit", TOP_SKILLS_DEFAULT, TOP_SKILLS_MIN, TOP_SKILLS_MAX)),
    "posting_volume": Canned(recent_volume, ("posting_volume",), ("as_of",),
                             Number("months", RECENT_MONTHS_DEFAULT, RECENT_MONTHS_MIN, RECENT_MONTHS_MAX)),
    "raw_table_health": Canned(raw_table_health, ("spark", "raw_tables"), ("database",)),
}


def run_canned(name: str, context: dict, **arguments) -> DataFrame:
    """Run one whitelisted query.  ``context`` holds the marts, the session and
    the raw table names; unknown names raise ValueError listing allowed ones."""
    if name not in CANNED:
        raise ValueError(f"unknown query {name!r}; allowed: {sorted(CANNED)}")
    return CANNED[name].run(context, arguments)


def try_canned(name: str, context: dict, **arguments) -> tuple[DataFrame | None, str | None]:
    """Like :func:`run_canned` but reports problems instead of raising:
    ``(frame, None)`` on success, ``(None, message)`` for an unknown name or a
    query that cannot be planned (e.g. a missing mart)."""
    try:
        df = run_canned(name, context, **arguments)
        df.schema  # forces analysis, so a missing table shows up here
        return df, None
    except Exception as e:  # noqa: BLE001 - the caller gets the message
        return None, f"{name}: {e}"
