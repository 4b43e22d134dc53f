"""Why rows are left out: counters taken while rows are written, and a table of rejects with reasons.

``judged`` gives every row the list of its reject reasons.  ``write_checked``
writes the rows without a reason in one job; an ``Observation`` on the same job
counts what went in, what was defaulted and what was rejected for which reason,
so the counters cost no second pass.  The rejected rows are written by a second
job, and only if there are any.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType, StringType

from hirelake.schema import JOBS_SCHEMA, REQUIRED, conform

REASONS, DEFAULTED = "reject_reasons", "defaulted_fields"


def named(conditions: dict[str, Column]) -> Column:
    """The names, in order, of the conditions that are true (null counts as false)."""
    hits = F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]) if conditions else F.array()
    return F.filter(hits.cast(ArrayType(StringType())), lambda x: x.isNotNull())


def contract_reasons(df: DataFrame) -> dict[str, Column]:
    """What breaks the canonical row: a missing required id, or a value that is not of its column's type."""
    out = {f"missing_{c}": F.col(c).isNull() if c in df.columns else F.lit(True) for c in REQUIRED}
    for f in JOBS_SCHEMA.fields:
        if f.name in df.columns and f.dataType != StringType() and df.schema[f.name].dataType != f.dataType:
            out[f"bad_{f.name}"] = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
    return out


def judged(df: DataFrame, reasons: dict[str, Column] | None = None, defaulted: dict[str, Column] | None = None) -> DataFrame:
    """All columns, ``reject_reasons`` (the given ones, then breaks of the canonical contract) and ``defaulted_fields``."""
    return df.select("*", named({**(reasons or {}), **contract_reasons(df)}).alias(REASONS), named(defaulted or {}).alias(DEFAULTED))


def accepted(rows: DataFrame) -> DataFrame:
    """Judged rows without a reason, as canonical rows."""
    kept = rows.where(F.size(REASONS) == 0).drop(REASONS, DEFAULTED)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in kept.columns and f.dataType != StringType() else F.col(f.name)
             for f in JOBS_SCHEMA.fields if f.name in kept.columns]
    return conform(kept.select(*typed), skills_as="keep", on_invalid="keep")


@dataclass
class Written:
    path: str
    rejects: str | None
    counters: dict[str, int]


def write_checked(rows: DataFrame, path: str, rejects: str, reasons: list[str], defaulted: list[str] = ()) -> Written:
    """Write the accepted rows to ``path`` and the others, with their reasons, to ``rejects``.

    ``rows`` are judged; ``reasons`` and ``defaulted`` name what is counted
    (a row with several reasons counts for each).  Counters: ``rows_in``,
    ``rows_kept``, ``rows_rejected``, ``rejected_<reason>``, ``defaulted_<field>``.
    """
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    seen = Observation()
    watched = rows.observe(seen, F.count(F.lit(1)).alias("rows_in"), count(F.size(REASONS) == 0).alias("rows_kept"),
                           count(F.size(REASONS) > 0).alias("rows_rejected"),
                           *[count(F.array_contains(REASONS, r)).alias(f"rejected_{r}") for r in reasons],
                           *[count((F.size(REASONS) == 0) & F.array_contains(DEFAULTED, d)).alias(f"defaulted_{d}") for d in defaulted])
    accepted(watched).write.mode("overwrite").parquet(path)
    counters = {k: int(v) for k, v in seen.get.items()}
    if not counters["rows_rejected"]:
        return Written(path, None, counters)
    rows.where(F.size(REASONS) > 0).write.mode("overwrite").parquet(rejects)
    return Written(path, rejects, counters)
