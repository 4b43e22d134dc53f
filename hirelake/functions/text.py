"""Whitespace and blank handling.

Spark's one-argument ``trim`` removes spaces only, while the pipeline we match
strips every whitespace character (tabs, newlines, no-break spaces ...).  The
two-argument form of ``trim`` removes any character of a given set and stays a
plain codegen'd string function.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from hirelake.functions.vocab import WHITESPACE


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(c, fn) -> Column:
    """``fn(c)``, with ``c`` computed once however often ``fn`` names it.

    Spark inlines a column into a filter above it, and finds no common parts in
    filters and behind lambdas: there, each mention would be a computation.
    """
    return F.get(F.transform(F.array(col_of(c)), fn), F.lit(0))


def trim_ws(c) -> Column:
    """Strip leading/trailing whitespace of any kind.

    A column whose first and last byte are visible ASCII is its own trimmed
    text; ``trim`` with a set of characters would go through all of it.
    """
    trimmed = F.trim(col_of(c), F.lit(WHITESPACE))
    if not isinstance(c, str):
        return trimmed
    raw = F.col(c).cast("binary")
    visible = [F.substring(raw, at, 1).between(F.lit(b"!"), F.lit(b"~")) for at in (1, -1)]
    return F.when(visible[0] & visible[1], F.col(c).cast("string")).otherwise(trimmed)


def blank_to_null(c) -> Column:
    """``nullif(trim(c), '')`` with full-whitespace trimming.

    Written as CASE WHEN: Spark 4 rewrites ``nullif`` into extra projections,
    which would keep a top-k from being planned as one operator.
    """
    t = trim_ws(c)
    return F.when(t != F.lit(""), t)


def is_blank(c) -> Column:
    """True when NULL, empty or whitespace only."""
    return F.coalesce(trim_ws(c) == F.lit(""), F.lit(True))


def not_blank(c) -> Column:
    return ~is_blank(c)
