"""The library's shared expressions as SQL functions, for callers who write SQL.

Every function has a SQL body, which Catalyst inlines like any other expression:
no Python runs, and predicates and columns are pruned through it.  Each equals
the Column function of the same name.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from hirelake.functions.skills import JSON_SCALAR_ARRAY
from hirelake.functions.vocab import WHITESPACE


def sql_literal(text: str) -> str:
    """A SQL string literal, other than printable ASCII as escapes."""
    return "'" + "".join(c if " " <= c <= "~" and c not in "'\\" else f"\\u{ord(c):04x}" for c in text) + "'"


#: name -> (parameters, result type, body); bodies use the functions above them.
BODIES = {
    "trim_ws": ("x STRING", "STRING", f"trim(BOTH {sql_literal(WHITESPACE)} FROM x)"),
    "blank_to_null": ("x STRING", "STRING", "CASE WHEN {p}trim_ws(x) != '' THEN {p}trim_ws(x) END"),
    "url_key": ("url STRING", "STRING", "lower({p}blank_to_null(url))"),
    "clean_list": ("items ARRAY<STRING>", "ARRAY<STRING>",
                   f"filter(transform(items, x -> trim(BOTH {sql_literal(WHITESPACE)} FROM x)), x -> x != '')"),
    "normalize_skills": ("skills STRING", "ARRAY<STRING>",
                         f"coalesce({{p}}clean_list(CASE WHEN {{p}}trim_ws(skills) RLIKE {sql_literal(JSON_SCALAR_ARRAY)} "
                         "THEN from_json({p}trim_ws(skills), 'array<string>') END), cast(array() AS ARRAY<STRING>))"),
    "dedup_key": ("source_id STRING, job_url STRING, job_title STRING, company_name STRING, posted_date DATE, location STRING", "STRING",
                  "concat(source_id, '#', coalesce({p}blank_to_null(job_url), '_nourl_'), '#', coalesce({p}trim_ws(job_title), ''), '#', "
                  "coalesce({p}trim_ws(company_name), ''), '#', cast(posted_date AS STRING), '#', coalesce({p}trim_ws(location), ''))"),
    "fingerprint": ("dedup_key STRING", "BIGINT", "CASE WHEN dedup_key IS NOT NULL THEN xxhash64(dedup_key) END"),
    "is_complete": ("job_title STRING, job_description STRING, skill_count INT", "BOOLEAN",
                    "coalesce({p}trim_ws(job_title), '') != '' AND (coalesce({p}trim_ws(job_description), '') != '' OR coalesce(skill_count, 0) > 0)"),
}


def register_sql_functions(spark: SparkSession, prefix: str = "job_", database: str | None = None) -> list[str]:
    """Create the functions, named ``<prefix><name>``; their names.

    Without ``database`` they belong to this session.  With it they are stored
    in the catalog, where other sessions and persistent views find them.
    """
    place = f"{database}.{prefix}" if database else prefix
    kind = "FUNCTION" if database else "TEMPORARY FUNCTION"
    for name, (params, result, body) in BODIES.items():
        spark.sql(f"CREATE OR REPLACE {kind} {place}{name}({params}) RETURNS {result} RETURN {body.replace('{p}', place)}")
    return [prefix + name for name in BODIES]
