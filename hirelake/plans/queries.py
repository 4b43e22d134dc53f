"""Registered queries: one Spark job per operator, each with its DuckDB oracle.

Every query reads the supplied tables (through the adapter) in full.  Outputs
are made engine-neutral for comparison: dates and timestamps as text, lists
joined with '|', every computed column aliased.
"""
from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake.functions import skills as SK
from hirelake.operators import compare as CMP
from hirelake.operators import explore as EX
from hirelake.operators import filters as FL
from hirelake.operators import gold as G
from hirelake.operators import master as M
from hirelake.operators import profile as PR
from hirelake.operators import quality as Q
from hirelake.operators import silver as S
from hirelake.operators.enrich import enrich, title_terms_in_description
from hirelake.plans import adapters as A
from hirelake.plans.oracles import (CANON_OUT, CLEAN, D, DOMAIN, J, JACCARD, NB, NORM, TAX, TRIM, TS,
                                    with_raw)
from hirelake.schema import JOBS_COLUMNS, conform

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---- output helpers -----------------------------------------------------------

def d2s(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def ts2s(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def canon_out(df: DataFrame, extra=()) -> DataFrame:
    return df.select(*[d2s(c).alias(c) if c == "posted_date" else ts2s(c).alias(c) if c == "ingested_at"
                       else F.col(c) for c in JOBS_COLUMNS], *extra)


# ---- shared pieces ------------------------------------------------------------

def raw_list(spark, sf_dir) -> list[DataFrame]:
    return list(A.raw_tables(spark, sf_dir).values())


def stg_k(spark, sf_dir) -> DataFrame:
    """Raw union keeping the adapter's row_key."""
    return reduce(lambda a, b: a.unionByName(b), A.raw_tables(spark, sf_dir, with_key=True).values())


def std_k(spark, sf_dir) -> DataFrame:
    return S.standardize(stg_k(spark, sf_dir), keep=("row_key",))


def dedup_k(spark, sf_dir) -> DataFrame:
    return S.deduplicate(std_k(spark, sf_dir), tie_breakers=("row_key",))


def curated_k(spark, sf_dir) -> DataFrame:
    return G.curate(dedup_k(spark, sf_dir), keep=("row_key",))


def skill_demand(spark, sf_dir) -> DataFrame:
    return G.skill_demand(S.skills_long(dedup_k(spark, sf_dir)))


# Explore settings used by the dashboard-style queries.
EXPLORE = dict(sources=["src_orders", "src_documents", "src_pages"], date_from="1996-01-01",
               date_to="2024-12-31")
EXPLORE_SQL = ("source_id IN ('src_orders', 'src_documents', 'src_pages') "
               "AND posted_date >= DATE '1996-01-01' AND posted_date <= DATE '2024-12-31'")
SEARCH = "  Ord_r%CUST "
SEARCH_SQL = "lower(coalesce(job_title, '') || coalesce(job_description, '')) LIKE '%ord_r%cust%'"


def explored(spark, sf_dir, search=None) -> DataFrame:
    return FL.explore_filter(M.master_clean(raw_list(spark, sf_dir)), search=search, **EXPLORE)


# =============================================================================
# Silver / gold chain
# =============================================================================

@query("stg_all_sources", with_raw(f"SELECT {CANON_OUT} FROM stg"))
def q_stg_all_sources(spark, sf_dir):
    return canon_out(S.union_all(raw_list(spark, sf_dir)))


@query("bronze_passthrough", with_raw(" UNION ALL ".join(f"SELECT 'brz_{t}' AS bronze_model, {CANON_OUT} FROM raw_{t}_k"
                                                         for t in ("orders", "events", "documents", "pages"))))
def q_bronze_passthrough(spark, sf_dir):
    from hirelake.sources.catalog import bronze_models
    A.register_raw_views(spark, sf_dir)
    models = bronze_models(spark, A.RAW_TABLES)
    parts = [canon_out(df, extra=(F.lit(name).alias("bronze_model"),)) for name, df in models.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("conform_jobs", with_raw(f"SELECT {CANON_OUT} FROM stg"))
def q_conform_jobs(spark, sf_dir):
    # Columns arrive shuffled, with an extra id and the date as text.
    raw = stg_k(spark, sf_dir)
    shuffled = raw.select("row_key", "ingested_at", "skills", F.col("posted_date").cast("string").alias("posted_date"),
                          *[c for c in JOBS_COLUMNS if c not in ("ingested_at", "skills", "posted_date")])
    return canon_out(conform(shuffled))


@query("jobs_standardized", with_raw(f"""
SELECT row_key, source_id, job_title, job_description, company_name, location, {D('posted_date')} AS posted_date,
  job_url, job_url_normalized, {J('skills_normalized')} AS skills_normalized,
  CAST(len(skills_normalized) AS BIGINT) AS n_skills, salary_info, {TS('ingested_at')} AS ingested_at, skills_raw
FROM std_k"""))
def q_jobs_standardized(spark, sf_dir):
    s = std_k(spark, sf_dir)
    return s.select("row_key", "source_id", "job_title", "job_description", "company_name", "location",
                    d2s("posted_date").alias("posted_date"), "job_url", "job_url_normalized",
                    SK.skills_text("skills_normalized").alias("skills_normalized"),
                    F.size("skills_normalized").cast("long").alias("n_skills"), "salary_info",
                    ts2s("ingested_at").alias("ingested_at"), "skills_raw")


@query("skills_normalized", with_raw(f"""
SELECT row_key, {J(NORM('skills'))} AS skills, CAST(len({NORM('skills')}) AS BIGINT) AS n_skills FROM stg_k
UNION ALL
SELECT row_key, {J(f"coalesce({CLEAN('skills')}, [])")}, CAST(len(coalesce({CLEAN('skills')}, [])) AS BIGINT)
FROM raw_documents_arr"""))
def q_skills_normalized(spark, sf_dir):
    text = stg_k(spark, sf_dir).select("row_key", SK.normalize_skills("skills").alias("s"))
    arr_src = A.raw_documents(spark, sf_dir, skills_as_array=True)
    arr = arr_src.select("row_key", SK.normalize_skills("skills", arr_src.schema["skills"].dataType).alias("s"))
    both = text.unionByName(arr)
    return both.select("row_key", SK.skills_text("s").alias("skills"), F.size("s").cast("long").alias("n_skills"))


@query("dedup_fingerprint", with_raw("""
SELECT row_key, dedup_key, dedup_key IS NULL AS fingerprint_is_null FROM keyed"""))
def q_dedup_fingerprint(spark, sf_dir):
    k = S.with_dedup_key(std_k(spark, sf_dir))
    return k.select("row_key", F.col("_dedup_key").alias("dedup_key"),
                    F.col("_dedup_fingerprint").isNull().alias("fingerprint_is_null"))


@query("jobs_deduplicated", with_raw(f"""
SELECT row_key, source_id, job_title, job_description, company_name, location, {D('posted_date')} AS posted_date,
  job_url, {J('skills_normalized')} AS skills_normalized, salary_info, {TS('ingested_at')} AS ingested_at
FROM dedup"""))
def q_jobs_deduplicated(spark, sf_dir):
    d = dedup_k(spark, sf_dir)
    return d.select("row_key", "source_id", "job_title", "job_description", "company_name", "location",
                    d2s("posted_date").alias("posted_date"), "job_url",
                    SK.skills_text("skills_normalized").alias("skills_normalized"), "salary_info",
                    ts2s("ingested_at").alias("ingested_at"))


@query("skills_long", with_raw(f"""
SELECT source_id, job_title, company_name, {D('posted_date')} AS posted_date, job_url,
  {TS('ingested_at')} AS ingested_at, skill FROM skills_long"""))
def q_skills_long(spark, sf_dir):
    sl = S.skills_long(dedup_k(spark, sf_dir))
    return sl.select("source_id", "job_title", "company_name", d2s("posted_date").alias("posted_date"), "job_url",
                     ts2s("ingested_at").alias("ingested_at"), "skill")


@query("skill_demand", with_raw("SELECT skill, job_postings, source_count FROM skill_demand"))
def q_skill_demand(spark, sf_dir):
    return skill_demand(spark, sf_dir)


@query("posting_volume", with_raw(f"""
SELECT source_id, {D('posting_month')} AS posting_month, job_postings, complete_postings FROM posting_volume"""))
def q_posting_volume(spark, sf_dir):
    v = G.posting_volume(dedup_k(spark, sf_dir))
    return v.select("source_id", d2s("posting_month").alias("posting_month"), "job_postings", "complete_postings")


@query("jobs_curated", with_raw(f"""
SELECT row_key, source_id, job_title, {D('posted_date')} AS posted_date, skill_count, is_complete,
  content_quality_bucket FROM curated"""))
def q_jobs_curated(spark, sf_dir):
    c = curated_k(spark, sf_dir)
    return c.select("row_key", "source_id", "job_title", d2s("posted_date").alias("posted_date"), "skill_count",
                    "is_complete", "content_quality_bucket")


@query("quality_buckets", with_raw("""
SELECT source_id, content_quality_bucket, CAST(count(*) AS BIGINT) AS job_count FROM curated GROUP BY ALL"""))
def q_quality_buckets(spark, sf_dir):
    return curated_k(spark, sf_dir).groupBy("source_id", "content_quality_bucket") \
        .agg(F.count(F.lit(1)).alias("job_count"))


@query("cross_source_urls", with_raw("""
SELECT job_url_normalized, CAST(count(*) AS BIGINT) AS row_count,
  CAST(count(DISTINCT source_id) AS BIGINT) AS distinct_sources
FROM dedup WHERE job_url_normalized IS NOT NULL GROUP BY job_url_normalized
HAVING count(DISTINCT source_id) > 1"""))
def q_cross_source_urls(spark, sf_dir):
    return G.cross_source_urls(dedup_k(spark, sf_dir))


@query("source_row_counts", with_raw("""
SELECT source_id, CAST(count(*) AS BIGINT) AS job_count FROM curated GROUP BY source_id"""))
def q_source_row_counts(spark, sf_dir):
    return G.source_row_counts(curated_k(spark, sf_dir))


# =============================================================================
# Master table
# =============================================================================

@query("master_union", with_raw(f"SELECT {CANON_OUT} FROM stg"))
def q_master_union(spark, sf_dir):
    return canon_out(M.master_union(raw_list(spark, sf_dir)))


@query("master_clean", with_raw(f"SELECT {CANON_OUT}, is_complete FROM master_clean"))
def q_master_clean(spark, sf_dir):
    return canon_out(M.master_clean(raw_list(spark, sf_dir)), extra=("is_complete",))


@query("master_complete", with_raw(f"SELECT {CANON_OUT} FROM master_clean WHERE is_complete"))
def q_master_complete(spark, sf_dir):
    return canon_out(M.master_complete(raw_list(spark, sf_dir)))


# =============================================================================
# Filters
# =============================================================================

@query("recent_postings", with_raw(f"""
SELECT source_id, job_title, {D('posted_date')} AS posted_date, job_url FROM stg
WHERE posted_date >= DATE '{A.AS_OF_ORDERS}' - 1095"""))
def q_recent_postings(spark, sf_dir):
    r = FL.recent_postings(M.master_union(raw_list(spark, sf_dir)), as_of=A.AS_OF_ORDERS)
    return r.select("source_id", "job_title", d2s("posted_date").alias("posted_date"), "job_url")


@query("domain_filter", with_raw(f"""
SELECT row_key, source_id FROM std_k WHERE {DOMAIN('job_title', 'job_description', 'skills_normalized')}"""))
def q_domain_filter(spark, sf_dir):
    s = std_k(spark, sf_dir)
    return s.where(FL.is_data_domain("job_title", "job_description", "skills_normalized")) \
            .select("row_key", "source_id")


# =============================================================================
# Explore (dashboard) queries
# =============================================================================

@query("explore_count", with_raw(f"""
SELECT CAST(count(*) AS BIGINT) AS total_postings FROM master_clean WHERE {EXPLORE_SQL}"""))
def q_explore_count(spark, sf_dir):
    return EX.explore_count(explored(spark, sf_dir))


@query("explore_by_source", with_raw(f"""
SELECT source_id, CAST(count(*) AS BIGINT) AS job_count FROM master_clean WHERE {EXPLORE_SQL} GROUP BY 1"""))
def q_explore_by_source(spark, sf_dir):
    return EX.explore_by_source(explored(spark, sf_dir))


@query("explore_monthly", with_raw(f"""
SELECT {D("CAST(date_trunc('month', posted_date) AS DATE)")} AS month, CAST(count(*) AS BIGINT) AS job_count
FROM master_clean WHERE {EXPLORE_SQL} AND posted_date IS NOT NULL GROUP BY 1"""))
def q_explore_monthly(spark, sf_dir):
    m = EX.explore_monthly(explored(spark, sf_dir))
    return m.select(d2s("month").alias("month"), "job_count")


@query("explore_complete", with_raw(f"""
SELECT CAST(coalesce(sum(CASE WHEN is_complete THEN 1 ELSE 0 END), 0) AS BIGINT) AS complete_rows
FROM master_clean WHERE {EXPLORE_SQL}"""))
def q_explore_complete(spark, sf_dir):
    return EX.explore_complete(explored(spark, sf_dir))


@query("text_search", with_raw(f"""
SELECT source_id, job_title, job_url, {D('posted_date')} AS posted_date FROM master_clean
WHERE {EXPLORE_SQL} AND {SEARCH_SQL}"""))
def q_text_search(spark, sf_dir):
    s = explored(spark, sf_dir, search=SEARCH)
    return s.select("source_id", "job_title", "job_url", d2s("posted_date").alias("posted_date"))


@query("top_companies", with_raw(f"""
SELECT {TRIM('company_name')} AS company_name, CAST(count(*) AS BIGINT) AS job_count FROM master_clean
WHERE {EXPLORE_SQL} AND company_name IS NOT NULL AND {TRIM('company_name')} <> ''
GROUP BY 1 ORDER BY job_count DESC, company_name ASC LIMIT 10"""))
def q_top_companies(spark, sf_dir):
    return EX.top_companies(explored(spark, sf_dir), 10)


@query("top_skills_by_year", with_raw(f"""
WITH skill_rows AS (
  SELECT CAST(year(posted_date) AS BIGINT) AS job_year, {TRIM('skill')} AS skill
  FROM (SELECT posted_date, unnest({NORM('skills')}) AS skill FROM master_clean
        WHERE {EXPLORE_SQL} AND posted_date IS NOT NULL)
  WHERE {TRIM('skill')} IS NOT NULL AND {TRIM('skill')} <> ''
), counts AS (
  SELECT job_year, skill, CAST(count(*) AS BIGINT) AS skill_count FROM skill_rows GROUP BY 1, 2
)
SELECT * FROM (
  SELECT job_year, skill, skill_count,
    CAST(row_number() OVER (PARTITION BY job_year ORDER BY skill_count DESC, skill ASC) AS BIGINT) AS rank_in_year
  FROM counts) WHERE rank_in_year <= 10"""))
def q_top_skills_by_year(spark, sf_dir):
    t = EX.top_skills_by_year(explored(spark, sf_dir), 10)
    return t.select(F.col("job_year").cast("long").alias("job_year"), "skill", "skill_count",
                    F.col("rank_in_year").cast("long").alias("rank_in_year"))


BROWSE_PRIORITY = "documents"


@query("browse_jobs", with_raw(f"""
SELECT job_title, company_name, location, {D('posted_date')} AS posted_date, source_id, job_url,
  description_preview FROM (
  SELECT *, substr(coalesce(job_description, ''), 1, 400) AS description_preview FROM master_clean
  WHERE {EXPLORE_SQL})
ORDER BY CASE WHEN contains(lower(coalesce(source_id, '')), '{BROWSE_PRIORITY}') THEN 0 ELSE 1 END,
  posted_date DESC NULLS LAST, job_title ASC NULLS LAST, source_id ASC NULLS LAST, job_url ASC NULLS LAST,
  company_name ASC NULLS LAST, location ASC NULLS LAST, description_preview ASC NULLS LAST
LIMIT 200"""))
def q_browse_jobs(spark, sf_dir):
    b = EX.browse_jobs(explored(spark, sf_dir), 200, priority=BROWSE_PRIORITY)
    return b.select("job_title", "company_name", "location", d2s("posted_date").alias("posted_date"), "source_id",
                    "job_url", "description_preview")


@query("sources_priority", with_raw(f"""
SELECT source_id, CAST(row_number() OVER (ORDER BY CASE WHEN contains(lower(source_id), '{BROWSE_PRIORITY}')
  THEN 0 ELSE 1 END, source_id) AS BIGINT) AS position
FROM (SELECT DISTINCT source_id FROM master_clean WHERE source_id IS NOT NULL)"""))
def q_sources_priority(spark, sf_dir):
    s = EX.sources_priority(M.master_clean(raw_list(spark, sf_dir)), priority=BROWSE_PRIORITY)
    return s.select("source_id", F.col("position").cast("long").alias("position"))


# =============================================================================
# Canned queries
# =============================================================================

@query("top_skills", with_raw("""
SELECT skill, job_postings, source_count FROM skill_demand ORDER BY job_postings DESC, skill ASC LIMIT 15"""))
def q_top_skills(spark, sf_dir):
    from hirelake.operators.canned import top_skills
    return top_skills(skill_demand(spark, sf_dir), limit=15)


RECENT_MONTHS = 6


@query("recent_volume", with_raw(f"""
SELECT source_id, {D('posting_month')} AS posting_month, job_postings, complete_postings FROM posting_volume
WHERE posting_month >= DATE_TRUNC('month', DATE '{A.AS_OF_EVENTS}') - INTERVAL {RECENT_MONTHS} MONTH"""))
def q_recent_volume(spark, sf_dir):
    from hirelake.operators.canned import recent_volume
    v = recent_volume(G.posting_volume(dedup_k(spark, sf_dir)), months=RECENT_MONTHS, as_of=A.AS_OF_EVENTS)
    return v.select("source_id", d2s("posting_month").alias("posting_month"), "job_postings", "complete_postings")


@query("canned_top_skills", with_raw("""
SELECT skill, job_postings, source_count FROM skill_demand ORDER BY job_postings DESC, skill ASC LIMIT 100"""))
def q_canned_top_skills(spark, sf_dir):
    """Through the whitelist: the number comes as text and is bounded."""
    from hirelake.operators.canned import run_canned
    return run_canned("top_skills", {"skill_demand": skill_demand(spark, sf_dir)}, limit=" 5000 ")


@query("canned_posting_volume", with_raw(f"""
SELECT source_id, {D('posting_month')} AS posting_month, job_postings, complete_postings FROM posting_volume
WHERE posting_month >= DATE_TRUNC('month', DATE '{A.AS_OF_EVENTS}') - INTERVAL 3 MONTH"""))
def q_canned_posting_volume(spark, sf_dir):
    from hirelake.operators.canned import run_canned
    v = run_canned("posting_volume", {"posting_volume": G.posting_volume(dedup_k(spark, sf_dir)), "as_of": A.AS_OF_EVENTS}, months="3")
    return v.select("source_id", d2s("posting_month").alias("posting_month"), "job_postings", "complete_postings")


HEALTH_TABLES = (*A.RAW_TABLES, "raw_archive", "raw_legacy")
HEALTH_SQL = f"""
SELECT 'raw_orders' AS table_name, CAST(count(*) AS BIGINT) AS row_count, max(ingested_at) AS last_ingested,
  CAST(NULL AS VARCHAR) AS error FROM raw_orders_k
UNION ALL SELECT 'raw_events', count(*), max(ingested_at), NULL FROM raw_events_k
UNION ALL SELECT 'raw_documents', count(*), max(ingested_at), NULL FROM raw_documents_k
UNION ALL SELECT 'raw_pages', count(*), max(ingested_at), NULL FROM raw_pages_k
UNION ALL SELECT 'raw_archive', NULL, NULL, 'not_found'
UNION ALL SELECT 'raw_legacy', NULL, NULL, 'not_found'"""


@query("raw_table_health", with_raw(f"""
SELECT table_name, row_count, {TS('last_ingested')} AS last_ingested, error FROM ({HEALTH_SQL})"""))
def q_raw_table_health(spark, sf_dir):
    A.register_raw_views(spark, sf_dir)
    h = Q.raw_table_health(spark, HEALTH_TABLES)
    return h.select("table_name", "row_count", ts2s("last_ingested").alias("last_ingested"), "error")


GATE_NOW = f"{A.AS_OF_EVENTS} 00:00:00"
GATE_MAX_AGE = 72.0


@query("quality_gate", with_raw(f"""
WITH h AS ({HEALTH_SQL}),
f AS (
  SELECT table_name, 'missing' AS failure, CAST(NULL AS DOUBLE) AS age_hours FROM h
  WHERE error = 'not_found' AND table_name <> 'raw_legacy'
  UNION ALL
  SELECT table_name, 'zero_rows', NULL FROM h WHERE error IS NULL AND coalesce(row_count = 0, true)
  UNION ALL
  SELECT table_name, 'stale',
    round_even(date_diff('microsecond', last_ingested, TIMESTAMP '{GATE_NOW}') / 3.6e9, 1)
  FROM h WHERE error IS NULL AND last_ingested IS NOT NULL
    AND date_diff('microsecond', last_ingested, TIMESTAMP '{GATE_NOW}') / 3.6e9 > {GATE_MAX_AGE}
)
SELECT * FROM f"""))
def q_quality_gate(spark, sf_dir):
    A.register_raw_views(spark, sf_dir)
    h = Q.raw_table_health(spark, HEALTH_TABLES)
    return Q.quality_gate(h, as_of=GATE_NOW, max_age_hours=GATE_MAX_AGE, optional=("raw_legacy",))


NOT_NULL_COLS = ("source_id", "job_title", "posted_date", "company_name", "job_url")


@query("not_null_check", with_raw(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_rows FROM curated"
    for c in NOT_NULL_COLS)))
def q_not_null_check(spark, sf_dir):
    return Q.not_null_counts(curated_k(spark, sf_dir), NOT_NULL_COLS)


# =============================================================================
# Skill extraction, parsing and comparison
# =============================================================================

@query("taxonomy_skills", with_raw(f"""
SELECT row_key, {J(TAX('job_title', 'job_description'))} AS taxonomy_skills FROM std_k"""))
def q_taxonomy_skills(spark, sf_dir):
    s = std_k(spark, sf_dir)
    return s.select("row_key", SK.skills_text(SK.extract_taxonomy("job_title", "job_description"))
                    .alias("taxonomy_skills"))


@query("skill_jaccard", with_raw(f"""
SELECT row_key, round_even({JACCARD('skills_normalized', TAX('job_title', 'job_description'))}, 4) AS jaccard
FROM std_k"""))
def q_skill_jaccard(spark, sf_dir):
    s = SK.with_taxonomy(std_k(spark, sf_dir))
    return s.select("row_key", F.bround(SK.jaccard("skills_normalized", "skills_taxonomy"), 4).alias("jaccard"))


def _list_sql(expr: str, name: str) -> str:
    return f"{J(expr)} AS {name}, CAST(len({expr}) AS BIGINT) AS n_{name}"


def _rule_b_sql(x: str) -> str:
    listy = f"(starts_with({x}, '[') OR contains({x}, ';') OR contains({x}, '|'))"
    split = CLEAN(f"regexp_split_to_array(regexp_replace({x}, '[\\[\\]]', '', 'g'), '[;|]')")
    single = f"CASE WHEN {NB(x)} IS NOT NULL THEN [{NB(x)}] END"
    return f"CASE WHEN {listy} THEN {split} ELSE {single} END"


def _rule_c_sql(x: str) -> str:
    listy = f"(contains({x}, ';') OR contains({x}, '|') OR contains({x}, ','))"
    split = CLEAN(f"regexp_split_to_array({x}, '[;|,]')")
    single = f"CASE WHEN {NB(x)} IS NOT NULL THEN [{NB(x)}] END"
    return f"CASE WHEN {listy} THEN {split} ELSE {single} END"


@query("parse_skill_list", with_raw(f"""
WITH inputs AS (
  SELECT row_key, skills AS v FROM stg_k
  UNION ALL SELECT 'text:' || CAST(doc_id AS VARCHAR), text FROM documents
)
SELECT row_key, {_list_sql(_rule_b_sql('v'), 'list_b')}, {_list_sql(_rule_c_sql('v'), 'list_c')},
  {_list_sql(f"CASE WHEN {NB('v')} IS NOT NULL THEN [{NB('v')}] END", 'list_a')}
FROM inputs"""))
def q_parse_skill_list(spark, sf_dir):
    docs = A.read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("text:"), F.col("doc_id").cast("string")).alias("row_key"), F.col("text").alias("v"))
    inputs = stg_k(spark, sf_dir).select("row_key", F.col("skills").alias("v")).unionByName(docs)
    out = [F.col("row_key")]
    for name, expr in (("list_b", SK.skill_list_bracketed("v")), ("list_c", SK.skill_list_separated("v")),
                       ("list_a", SK.skill_list_single("v"))):
        out += [SK.skills_text(expr).alias(name), SK.size_or_null(expr).cast("long").alias(f"n_{name}")]
    return inputs.select(*out)


@query("merge_skills", with_raw(f"""
SELECT row_key, {J("CASE WHEN len(m) > 0 THEN m END")} AS merged FROM (
  SELECT row_key, CASE WHEN len(skills_normalized) = 0 THEN t WHEN len(t) = 0 THEN skills_normalized
    ELSE list_distinct_ordered END AS m FROM (
    SELECT row_key, skills_normalized, {TAX('job_title', 'job_description')} AS t,
      list_filter(list_concat(skills_normalized, {TAX('job_title', 'job_description')}), lambda x, i:
        list_position(list_concat(skills_normalized, {TAX('job_title', 'job_description')}), x) = i)
        AS list_distinct_ordered
    FROM std_k))"""))
def q_merge_skills(spark, sf_dir):
    s = SK.with_taxonomy(std_k(spark, sf_dir))
    merged = SK.merge_skills("skills_normalized", "skills_taxonomy")
    return s.select("row_key", SK.skills_text(merged).alias("merged"))


def _responses(spark, sf_dir) -> DataFrame:
    """Model-reply-like texts: every conversation turn, and each order's skills
    JSON once bare and once inside a markdown fence."""
    conv = A.read_table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c:"), F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
        .alias("reply_id"), F.col("text").alias("reply"))
    o = A.raw_tables(spark, sf_dir, with_key=True)["raw_orders"].select("row_key", "skills")
    forms = {"bare": F.col("skills"), "fenced": F.concat(F.lit("```json\n"), F.col("skills"), F.lit("\n```")),
             "mixed": F.concat(F.lit('["Go", {"in":'), F.col("skills"), F.lit('}, 0, false, true, [], 7]'))}
    # all forms of an order in one pass over the joined orders
    replies = o.select(F.explode(F.array(*[F.struct(F.concat(F.col("row_key"), F.lit(f":{n}")).alias("reply_id"), c.alias("reply"))
                                           for n, c in forms.items()])).alias("r")).select("r.*")
    return conv.unionByName(replies)


def _fence_sql(x: str) -> str:
    t = TRIM(x)
    body = (f"regexp_replace(regexp_replace({t}, '\\n[ \\t\\r\\f\\x0b]*```[ \\t\\r\\f\\x0b]*$', ''), "
            f"'^```[^\\n]*(\\n|$)', '')")
    return f"CASE WHEN starts_with({t}, '```') THEN {body} ELSE {t} END"


# What Python's truth test keeps of a parsed reply, as text.
REPLY_ITEMS = """list_transform(items, lambda x: CASE json_type(x) WHEN 'NULL' THEN NULL
  WHEN 'BOOLEAN' THEN CASE WHEN CAST(x AS VARCHAR) = 'true' THEN 'True' END WHEN 'VARCHAR' THEN x->>'$'
  WHEN 'OBJECT' THEN nullif(CAST(x AS VARCHAR), '{}') WHEN 'ARRAY' THEN nullif(CAST(x AS VARCHAR), '[]')
  ELSE CASE WHEN TRY_CAST(CAST(x AS VARCHAR) AS DOUBLE) <> 0 THEN CAST(x AS VARCHAR) END END)"""


@query("parse_response_skills", with_raw(f"""
WITH replies AS (
  SELECT 'c:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS reply_id, text AS reply
  FROM conversations
  UNION ALL SELECT row_key || ':bare', skills FROM raw_orders_k
  UNION ALL SELECT row_key || ':fenced', '```json' || chr(10) || skills || chr(10) || '```' FROM raw_orders_k
  UNION ALL SELECT row_key || ':mixed', '["Go", {{"in":' || skills || '}}, 0, false, true, [], 7]' FROM raw_orders_k
)
SELECT reply_id, coalesce({J(CLEAN(REPLY_ITEMS))}, '') AS skills FROM (
  SELECT reply_id, CASE WHEN json_valid(body) AND json_type(body) = 'ARRAY' THEN json_extract(body, '$[*]') END AS items FROM (
    SELECT reply_id, {TRIM(_fence_sql('reply'))} AS body FROM replies))"""))
def q_parse_response_skills(spark, sf_dir):
    r = _responses(spark, sf_dir)
    return r.select("reply_id", SK.skills_text(SK.parse_response_skills("reply")).alias("skills"))


COMPARE_N = 300


def _compare(spark, sf_dir) -> DataFrame:
    s = CMP.sample_nonblank(std_k(spark, sf_dir), None)
    return CMP.compare_skills(s, row_id="row_key", other="skills_normalized")


def _compare_sql() -> str:
    tax = TAX("job_title", "job_description")
    desc = "coalesce(job_description, '')"
    return f"""
sample AS (
  SELECT * FROM std_k WHERE coalesce({TRIM('job_title')}, '') <> '' OR coalesce({TRIM('job_description')}, '') <> ''
), cmp AS (
  SELECT row_key AS row_id, coalesce(job_title, '') AS job_title,
    CASE WHEN length({desc}) > 200 THEN substr({desc}, 1, 200) || '...' ELSE {desc} END AS description_snippet,
    {J(tax)} AS skills_taxonomy, {J('skills_normalized')} AS skills_llm,
    printf('%.4f', round_even({JACCARD(tax, 'skills_normalized')}, 4)) AS jaccard_similarity
  FROM sample
)"""


@query("compare_skills", with_raw(", " + _compare_sql().strip() + "\nSELECT * FROM cmp"))
def q_compare_skills(spark, sf_dir):
    return _compare(spark, sf_dir)


@query("compare_summary", with_raw(", " + _compare_sql().strip() + """
SELECT CAST(count(*) AS BIGINT) AS rows,
  round_even(avg(CAST(jaccard_similarity AS DOUBLE)), 4) AS mean_jaccard,
  CAST(count_if(skills_taxonomy <> '') AS BIGINT) AS taxonomy_nonempty,
  CAST(count_if(skills_llm <> '') AS BIGINT) AS llm_nonempty,
  round_even(count_if(skills_taxonomy <> '') * 100.0 / count(*), 1) AS taxonomy_nonempty_pct,
  round_even(count_if(skills_llm <> '') * 100.0 / count(*), 1) AS llm_nonempty_pct,
  round_even(avg(CASE WHEN skills_taxonomy <> '' THEN len(string_split(skills_taxonomy, '|')) END), 2)
    AS taxonomy_mean_size,
  round_even(avg(CASE WHEN skills_llm <> '' THEN len(string_split(skills_llm, '|')) END), 2) AS llm_mean_size
FROM cmp"""))
def q_compare_summary(spark, sf_dir):
    return CMP.compare_summary(_compare(spark, sf_dir))


@query("hybrid_skills", with_raw(f"""
SELECT row_key, {J(f"CASE WHEN len(skills_normalized) > 0 THEN skills_normalized ELSE {TAX('job_title', 'job_description')} END")}
  AS skills_hybrid FROM std_k"""))
def q_hybrid_skills(spark, sf_dir):
    h = CMP.hybrid_fill(std_k(spark, sf_dir))
    return h.select("row_key", SK.skills_text("skills_hybrid").alias("skills_hybrid"))


@query("sample_nonblank", with_raw(f"""
SELECT row_key, job_title FROM std_k
WHERE coalesce({TRIM('job_title')}, '') <> '' OR coalesce({TRIM('job_description')}, '') <> ''
ORDER BY row_key LIMIT {COMPARE_N}"""))
def q_sample_nonblank(spark, sf_dir):
    return CMP.sample_nonblank(std_k(spark, sf_dir), COMPARE_N, order_by=("row_key",)).select("row_key", "job_title")


# =============================================================================
# Profile and enrichment
# =============================================================================

def _profile_sql() -> str:
    parts = []
    for i, c in enumerate(JOBS_COLUMNS):
        mn, mx = f"min({c})", f"max({c})"
        if c == "posted_date":
            mn, mx = D(mn), D(mx)
        elif c == "ingested_at":
            mn, mx = TS(mn), TS(mx)
        parts.append(f"SELECT {i + 1} AS position, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null, "
                     f"CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, {mn} AS min_value, {mx} AS max_value FROM stg")
    return "\nUNION ALL ".join(parts)


@query("column_profile", with_raw(_profile_sql()))
def q_column_profile(spark, sf_dir):
    p = PR.column_profile(S.union_all(raw_list(spark, sf_dir)))
    return p.select(F.col("position").cast("int").alias("position"), "column_name", "non_null", "nulls",
                    "min_value", "max_value")


@query("enrich_batches", with_raw(f"""
SELECT row_key, {J("list_filter(w, lambda x, i: length(x) >= 3 AND contains(d, x) AND list_position(w, x) = i)")} AS skills_enriched,
  false AS enrich_failed
FROM (SELECT row_key, lower(coalesce(job_description, '')) AS d, list_transform(
        regexp_split_to_array(lower(coalesce(job_title, '')), '\\s+'), lambda x: trim(x, '.,;:!?()[]{{}}"''')) AS w FROM std_k)"""))
def q_enrich_batches(spark, sf_dir):
    s = std_k(spark, sf_dir).select("row_key", "job_title", "job_description")
    e = enrich(s, title_terms_in_description, batch_size=10)
    return e.select("row_key", SK.skills_text("skills_enriched").alias("skills_enriched"), "enrich_failed")


# =============================================================================
# Ingestion: mapping file-shaped rows onto the canonical row
# =============================================================================

INGEST_AS_OF = A.AS_OF_EVENTS
INGESTED_AT = "2024-02-01 06:00:00"
ISO_SQL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def _iso_date_sql(x: str) -> str:
    t = TRIM(x)
    return f"CASE WHEN regexp_matches({t}, '{ISO_SQL}') THEN TRY_CAST(substr({t}, 1, 10) AS DATE) END"


def _ingest_ts():
    return F.lit(INGESTED_AT).cast("timestamp_ntz")


def _mapped_out(df: DataFrame) -> DataFrame:
    return df.select("source_id", "job_title", "job_description", "company_name", "location",
                     d2s("posted_date").alias("posted_date"), "job_url",
                     SK.skills_text("skills").alias("skills"), SK.size_or_null("skills").cast("long").alias("n_skills"),
                     "salary_info", ts2s("ingested_at").alias("ingested_at"))


LINKEDIN_LIKE_SQL = """
li AS (
  SELECT CAST(doc_id AS VARCHAR) AS job_id, source AS company_name, 'Document ' || source AS title,
    text AS description, lang || ' ' AS location,
    CASE WHEN doc_id % 3 = 0 THEN 'YEARLY' END AS pay_period,
    CASE WHEN doc_id % 41 = 0 THEN '2019-05-01' WHEN doc_id % 37 = 0 THEN 'junk'
         ELSE strftime(DATE '2023-01-01' + CAST(doc_id % 900 AS INTEGER), '%Y-%m-%d') END AS posted_date,
    'https://docs.example.com/' || CAST(doc_id AS VARCHAR) AS job_link,
    CASE WHEN doc_id % 5 = 0 THEN 'ai ' || w1 END AS skills_desc,
    CASE WHEN doc_id % 4 = 0 THEN '[' || w1 || '; ' || w2 || ']'
         WHEN doc_id % 4 = 1 THEN w1 || ', ' || w2
         WHEN doc_id % 4 = 2 THEN ';;' END AS skills,
    CASE WHEN doc_id % 2 = 0 THEN 'C' || CAST(doc_id % 100 AS VARCHAR) END AS company_id
  FROM doc_words
)"""


def _li_mapped_cte(name: str, variant: str = "postings", src: str = "li", title: str = "title") -> str:
    """Canonical rows of the LinkedIn mapper over ``li`` (recent, data domain)."""
    sid = "kaggle_linkedin_postings" if variant == "postings" else "kaggle_linkedin_jobs_skills_2024"
    sname = "Kaggle LinkedIn Job Postings 2023-2024" if variant == "postings" \
        else "Kaggle 1.3M LinkedIn Jobs & Skills 2024"
    default = "2023-06-01" if variant == "postings" else "2024-01-01"
    rule = _rule_b_sql("skills") if variant == "postings" else _rule_c_sql("skills")
    return f"""{name}_all AS (
  SELECT '{sid}' AS source_id, '{sname}' AS source_name, {NB(title)} AS job_title,
    {NB('coalesce(skills_desc, description)')} AS job_description,
    {TRIM('coalesce(company_id, company_name)')} AS company_name, {TRIM('location')} AS location,
    coalesce({_iso_date_sql('posted_date')}, DATE '{default}') AS posted_date,
    {TRIM('job_link')} AS job_url, {rule} AS skills, {TRIM('pay_period')} AS salary_info,
    TIMESTAMP '{INGESTED_AT}' AS ingested_at
  FROM {src}
), {name} AS (
  SELECT * FROM {name}_all
  WHERE posted_date >= DATE '{INGEST_AS_OF}' - 1095 AND {DOMAIN('job_title', 'job_description', 'skills')}
)"""


MAPPED_OUT_SQL = (f"source_id, job_title, job_description, company_name, location, {D('posted_date')} AS posted_date, "
                  f"job_url, {J('skills')} AS skills, CAST(len(skills) AS BIGINT) AS n_skills, salary_info, "
                  f"{TS('ingested_at')} AS ingested_at")


def _linkedin_sql() -> str:
    return with_raw(f""", {LINKEDIN_LIKE_SQL.strip()}, {_li_mapped_cte('lp')}
SELECT {MAPPED_OUT_SQL} FROM lp""")


@query("map_linkedin_postings", _linkedin_sql())
def q_map_linkedin_postings(spark, sf_dir):
    from hirelake.operators.mapping import map_linkedin
    m = map_linkedin(A.linkedin_like(spark, sf_dir), "postings", as_of=INGEST_AS_OF, ingested_at=_ingest_ts())
    return _mapped_out(m)


def _with_job_header(df: DataFrame) -> DataFrame:
    """The 1.3M-jobs layout also has a bare 'job' header, which counts as a title."""
    k = F.col("job_id").cast("long")
    return df.withColumn("job", F.when(k % 3 == 0, F.concat(F.lit("Data engineer "), F.col("location"))))


@query("map_linkedin_skills", with_raw(f""", {LINKEDIN_LIKE_SQL.strip()},
li_job AS (
  SELECT *, CASE WHEN CAST(job_id AS BIGINT) % 3 = 0 THEN 'Data engineer ' || location END AS job FROM li
), {_li_mapped_cte('ls', 'skills', src='li_job', title='coalesce(job, title)')}
SELECT {MAPPED_OUT_SQL} FROM ls"""))
def q_map_linkedin_skills(spark, sf_dir):
    from hirelake.operators.mapping import map_linkedin
    src = _with_job_header(A.linkedin_like(spark, sf_dir))
    m = map_linkedin(src, "skills", as_of=INGEST_AS_OF, ingested_at=_ingest_ts())
    return _mapped_out(m)


@query("ingest_csv_roundtrip", _linkedin_sql())
def q_ingest_csv_roundtrip(spark, sf_dir):
    """Write the LinkedIn-shaped rows as real multi-line CSV files, then run
    the file path: scan of the folder -> header map -> mapping -> filters."""
    from hirelake.operators.mapping import map_linkedin
    from hirelake.session import scratch_path
    from hirelake.sources.files import read_csv_source
    folder = scratch_path(spark, "linkedin_csv")
    A.linkedin_like(spark, sf_dir).write.option("header", True).option("escape", '"').csv(folder)
    m = map_linkedin(read_csv_source(spark, folder), "postings", as_of=INGEST_AS_OF, ingested_at=_ingest_ts())
    return _mapped_out(m)


DE_LIKE_SQL = """
de AS (
  SELECT o.o_orderpriority || ' data engineer' AS "Job_details",
    CASE WHEN o.o_orderkey % 5 = 0 THEN '   '
         ELSE o.o_orderstatus || ' pipeline with python and sql for ' || c.c_name END AS "Job_details.1",
    c.c_name AS "Company_info",
    CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE c.c_mktsegment END AS "Job_details.4",
    CASE WHEN o.o_orderkey % 4 = 0 THEN '' ELSE 'CA' END AS "Job_details.5",
    n.n_name AS "Job_details.6",
    CAST(CAST(floor(o.o_totalprice / 10) AS BIGINT) AS VARCHAR) AS "Salary.2",
    CASE WHEN o.o_orderkey % 2 = 0 THEN 'USD' END AS "Salary.3",
    CASE WHEN o.o_orderkey % 7 = 0 THEN 'Remote' END AS "Office location"
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def _de_mapped_cte(name: str) -> str:
    loc = (f"coalesce({NB('\"Office location\"')}, nullif(concat_ws(', ', {NB('\"Job_details.4\"')}, "
           f"{NB('\"Job_details.5\"')}, {NB('\"Job_details.6\"')}), ''))")
    tax = TAX("job_title", "job_description")
    return f"""{name}_m AS (
  SELECT {NB('"Job_details"')} AS job_title, {NB('"Job_details.1"')} AS job_description,
    {NB('"Company_info"')} AS company_name, {loc} AS location,
    nullif(concat_ws(' ', {NB('"Salary.2"')}, {NB('"Salary.3"')}), '') AS salary_info
  FROM de
), {name} AS (
  SELECT 'kaggle_data_engineer_2023' AS source_id, 'Kaggle Data Engineer Job Postings 2023' AS source_name,
    job_title, job_description, company_name, location, DATE '2023-04-01' AS posted_date,
    CAST(NULL AS VARCHAR) AS job_url, CASE WHEN len({tax}) > 0 THEN {tax} END AS skills, salary_info,
    TIMESTAMP '{INGESTED_AT}' AS ingested_at
  FROM {name}_m
)"""


def _de_sql() -> str:
    return with_raw(f""", {DE_LIKE_SQL.strip()}, {_de_mapped_cte('dm')}
SELECT source_id, job_title, job_description, company_name, location, {D('posted_date')} AS posted_date,
  salary_info, {J('skills')} AS skills FROM dm""")


@query("map_de_2023", _de_sql())
def q_map_de_2023(spark, sf_dir):
    from hirelake.operators.mapping import map_de_2023
    m = map_de_2023(A.de_like(spark, sf_dir), as_of=INGEST_AS_OF, extract_skills=True, ingested_at=_ingest_ts())
    return m.select("source_id", "job_title", "job_description", "company_name", "location",
                    d2s("posted_date").alias("posted_date"), "salary_info", SK.skills_text("skills").alias("skills"))


HF_LIKE_SQL = """
hf AS (
  SELECT
    CASE WHEN doc_id % 4 = 0 THEN strftime(DATE '2023-01-01' + CAST(doc_id % 900 AS INTEGER), '%Y-%m-%d') || 'T23:30:00-05:00'
         WHEN doc_id % 4 = 1 THEN strftime(DATE '2023-01-01' + CAST(doc_id % 900 AS INTEGER), '%Y-%m-%d') || ' 08:00:00'
         WHEN doc_id % 4 = 2 THEN strftime(DATE '2023-01-01' + CAST(doc_id % 900 AS INTEGER), '%Y-%m-%d') || ' x'
         ELSE strftime(DATE '2023-01-01' + CAST(doc_id % 900 AS INTEGER), '%Y-%m-%d') END AS job_posted_date,
    source || ' role' AS job_title,
    ['Data Engineer', 'Data Scientist', 'Software Engineer', 'Data Analyst', 'Cloud Engineer'][doc_id % 5 + 1]
      AS job_title_short,
    [text, ' ', NULL] AS job_type_skills,
    CASE WHEN doc_id % 3 = 0 THEN [w1, '  ', w2] WHEN doc_id % 3 = 1 THEN CAST([] AS VARCHAR[]) END AS job_skills,
    source AS company_name, lang AS job_location,
    CASE WHEN doc_id % 6 <> 0 THEN n_chars * 37.5 END AS salary_year_avg
  FROM doc_words
)"""


def _hf_mapped_cte(name: str) -> str:
    given = f"CASE WHEN len({CLEAN('job_skills')}) > 0 THEN {CLEAN('job_skills')} END"
    desc = f"CASE WHEN len({CLEAN('job_type_skills')}) > 0 THEN array_to_string({CLEAN('job_type_skills')}, chr(10)) END"
    return f"""{name}_m AS (
  SELECT job_title, {desc} AS job_description, company_name, job_location AS location,
    {_iso_date_sql('job_posted_date')} AS posted_date, {given} AS given, job_title_short,
    CAST(salary_year_avg AS VARCHAR) AS salary_info
  FROM hf
), {name}_t AS (
  SELECT *, {TAX('job_title', 'job_description')} AS tax FROM {name}_m
), {name}_x AS (
  SELECT *, CASE WHEN given IS NULL THEN tax WHEN len(tax) = 0 THEN given
    ELSE list_filter(list_concat(given, tax), lambda x, i: list_position(list_concat(given, tax), x) = i) END AS mm
  FROM {name}_t
), {name} AS (
  SELECT 'huggingface_data_jobs' AS source_id, 'Hugging Face data_jobs' AS source_name, job_title,
    job_description, company_name, location, posted_date, CAST(NULL AS VARCHAR) AS job_url,
    CASE WHEN len(mm) > 0 THEN mm END AS skills, salary_info, TIMESTAMP '{INGESTED_AT}' AS ingested_at
  FROM {name}_x
  WHERE posted_date >= DATE '{INGEST_AS_OF}' - 1095
    AND (coalesce({TRIM('job_title_short')} IN ('Data Engineer', 'Data Scientist', 'Data Analyst',
         'Analytics Engineer', 'Business Analyst', 'Machine Learning Engineer'), false)
         OR {DOMAIN('job_title', 'job_description', 'coalesce(given, CAST([] AS VARCHAR[]))')})
)"""


def _hf_sql() -> str:
    return with_raw(f""", {HF_LIKE_SQL.strip()}, {_hf_mapped_cte('hm')}
SELECT source_id, job_title, job_description, company_name, location, {D('posted_date')} AS posted_date,
  {J('skills')} AS skills, salary_info FROM hm""")


@query("map_hf_jobs", _hf_sql())
def q_map_hf_jobs(spark, sf_dir):
    from hirelake.operators.mapping import map_hf
    m = map_hf(A.hf_like(spark, sf_dir), as_of=INGEST_AS_OF, extract_skills=True, ingested_at=_ingest_ts())
    return m.select("source_id", "job_title", "job_description", "company_name", "location",
                    d2s("posted_date").alias("posted_date"), SK.skills_text("skills").alias("skills"), "salary_info")


# =============================================================================
# Partitioned mart layout and the pruned reader
# =============================================================================

SCAN_FROM, SCAN_TO = "1997-03-15", "1998-06-30"


@query("curated_partition_scan", with_raw(f"""
SELECT row_key, source_id, {D('posted_date')} AS posted_date, content_quality_bucket FROM curated
WHERE posted_date >= DATE '{SCAN_FROM}' AND posted_date <= DATE '{SCAN_TO}'"""))
def q_curated_partition_scan(spark, sf_dir):
    from hirelake.session import scratch_path
    from hirelake.sources.sinks import read_partitioned, write_partitioned
    path = scratch_path(spark, "mart_jobs_curated")
    write_partitioned(curated_k(spark, sf_dir), path, "posted_date", ("source_id", "content_quality_bucket"))
    scan = read_partitioned(spark, path, "posted_date", SCAN_FROM, SCAN_TO)
    return scan.select("row_key", "source_id", d2s("posted_date").alias("posted_date"), "content_quality_bucket")


@query("explore_relation", with_raw(f"SELECT {CANON_OUT}, 'raw_pick' AS relation_mode FROM raw_orders_k"))
def q_explore_relation(spark, sf_dir):
    from hirelake.sources.catalog import jobs_relation
    A.register_raw_views(spark, sf_dir)
    rows, mode = jobs_relation(spark, table="raw_orders")
    return canon_out(rows, extra=(F.lit(mode).alias("relation_mode"),))


@query("parquet_source_scan", with_raw(f"SELECT {CANON_OUT} FROM raw_orders_k"))
def q_parquet_source_scan(spark, sf_dir):
    """Rows in nested folders, found again by the recursive scan."""
    from hirelake.session import scratch_path
    from hirelake.sources.files import read_parquet_source
    folder = scratch_path(spark, "parquet_source")
    rows = A.raw_tables(spark, sf_dir)["raw_orders"]
    rows.where("posted_date IS NULL").write.parquet(f"{folder}/undated")
    rows.where("posted_date IS NOT NULL").write.parquet(f"{folder}/dated/part")
    return canon_out(read_parquet_source(spark, folder))


@query("csv_export_roundtrip", with_raw("SELECT skill, job_postings, source_count FROM skill_demand"))
def q_csv_export_roundtrip(spark, sf_dir):
    from hirelake.session import scratch_path
    from hirelake.sources.files import read_csv_source
    from hirelake.sources.sinks import export_csv
    back = read_csv_source(spark, export_csv(skill_demand(spark, sf_dir), scratch_path(spark, "export")))
    return back.select("skill", F.col("job_postings").cast("long").alias("job_postings"),
                       F.col("source_count").cast("long").alias("source_count"))


@query("master_modes", with_raw(f"""
SELECT 'view' AS master_mode, {CANON_OUT}, is_complete FROM master_clean
UNION ALL SELECT 'refreshed', {CANON_OUT}, is_complete FROM master_clean"""))
def q_master_modes(spark, sf_dir):
    """The master as a view, as an empty table (it adds no rows) and as a refreshed one."""
    import uuid
    from hirelake.sources import sinks
    rows = M.master_clean(raw_list(spark, sf_dir))
    names = {m: f"master_{m}_{uuid.uuid4().hex[:12]}" for m in ("view", "empty", "refreshed")}
    sinks.create_master_view(spark, rows, names["view"])
    for m in ("empty", "refreshed"):
        sinks.create_master_table(spark, rows, names[m])
    sinks.refresh_master_table(spark, rows, names["refreshed"])
    parts = [canon_out(spark.table(n), extra=("is_complete", F.lit(m).alias("master_mode"))) for m, n in names.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("map_de_variant", f"""
SELECT 'kaggle_data_engineer_2023' AS source_id, {NB("o_orderpriority || ' data engineer'")} AS job_title,
  'keys ' || CAST(o_custkey AS VARCHAR) AS job_description,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'company ' || CAST(o_custkey % 100 AS VARCHAR) END AS company_name,
  {NB('o_orderstatus')} AS location, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS salary_info FROM orders""")
def q_map_de_variant(spark, sf_dir):
    """Headers without an exact match: placed by their normalized names."""
    from hirelake.operators.mapping import map_de_2023
    k = F.col("o_orderkey")
    rows = A.read_table(spark, sf_dir, "orders").select(
        F.concat("o_orderpriority", F.lit(" data engineer")).alias("Job Title"),
        F.concat(F.lit(" keys "), F.col("o_custkey").cast("string")).alias("Description"),
        F.col("o_orderstatus").alias("Location"),
        F.when(k % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("company "), (F.col("o_custkey") % 100).cast("string"))).alias("Company-Name"),
        F.floor("o_totalprice").cast("long").cast("string").alias("Salary"))
    return map_de_2023(rows, as_of=INGEST_AS_OF, ingested_at=_ingest_ts()).select(
        "source_id", "job_title", "job_description", "company_name", "location", "salary_info")


@query("date_parse", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 6 THEN {D('CAST(o_orderdate AS DATE)')} END AS parsed FROM orders""")
def q_date_parse(spark, sf_dir):
    """Order dates written in layouts that sources use; every seventh is no date."""
    from hirelake.functions.dates import parse_date_general
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    layouts = ["MM/dd/yyyy hh:mm a", "yyyy-MM-dd HH:mm:ss 'UTC'", "d MMMM yyyy", "MMM d yyyy", "yyyy-M-d"]
    text = F.concat((F.unix_date(d).cast("long") * 86400000).cast("string"), F.lit(".0"))
    for i, layout in enumerate(layouts):
        text = F.when(k % 7 == i, F.date_format(d, layout)).otherwise(text)
    text = F.when(k % 7 == 6, F.lit("soon")).otherwise(text)
    rows = A.read_table(spark, sf_dir, "orders").select("o_orderkey", text.alias("posted"))
    return rows.select("o_orderkey", d2s(parse_date_general("posted", "ms")).alias("parsed"))


# =============================================================================
# The whole batch chain: ingest four file-shaped sources -> lake -> raw tables
# -> master view -> silver -> gold
# =============================================================================

def batch_sources(sf_dir: str):
    from hirelake.operators.mapping import map_de_2023, map_hf, map_linkedin
    from hirelake.plans.pipeline import SourceSpec
    kw = dict(as_of=INGEST_AS_OF)
    return [
        SourceSpec("huggingface", "huggingface_data_jobs", "raw_huggingface_data_jobs",
                   lambda s: map_hf(A.hf_like(s, sf_dir), extract_skills=True, ingested_at=_ingest_ts(), **kw)),
        SourceSpec("kaggle_data_engineer", "kaggle_data_engineer_2023", "raw_kaggle_data_engineer_2023",
                   lambda s: map_de_2023(A.de_like(s, sf_dir), extract_skills=True, ingested_at=_ingest_ts(), **kw)),
        SourceSpec("kaggle_linkedin", "kaggle_linkedin_postings", "raw_kaggle_linkedin_postings",
                   lambda s: map_linkedin(A.linkedin_like(s, sf_dir), "postings", ingested_at=_ingest_ts(), **kw)),
        SourceSpec("kaggle_linkedin_skills", "kaggle_linkedin_jobs_skills_2024",
                   "raw_kaggle_linkedin_jobs_skills_2024",
                   lambda s: map_linkedin(A.linkedin_like(s, sf_dir), "skills", ingested_at=_ingest_ts(), **kw)),
    ]


def _batch_sql() -> str:
    std = f"""b_std AS (
  SELECT source_id, source_name, {NB('job_title')} AS job_title, {NB('job_description')} AS job_description,
    {NB('company_name')} AS company_name, {NB('location')} AS location, posted_date,
    {NB('job_url')} AS job_url, coalesce({CLEAN('skills')}, []) AS skills_normalized, salary_info, ingested_at,
    CAST(to_json(skills) AS VARCHAR) AS skills_raw
  FROM b_union
), b_keyed AS (
  SELECT *, source_id || '#' || coalesce({NB('job_url')}, '_nourl_') || '#' || coalesce({TRIM('job_title')}, '')
    || '#' || coalesce({TRIM('company_name')}, '') || '#' || CAST(posted_date AS VARCHAR) || '#'
    || coalesce({TRIM('location')}, '') AS dedup_key
  FROM b_std
), b_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id, dedup_key ORDER BY ingested_at DESC NULLS LAST,
      job_url ASC NULLS LAST, md5(concat_ws(chr(31), coalesce(source_name, chr(1)), coalesce(job_title, chr(1)),
        coalesce(job_description, chr(1)), coalesce(company_name, chr(1)), coalesce(location, chr(1)),
        coalesce(skills_raw, chr(1)), coalesce(salary_info, chr(1)))) ASC) AS rn
    FROM b_keyed) WHERE rn = 1
), b_long AS (
  SELECT source_id, {TRIM('skill')} AS skill FROM (SELECT source_id, unnest(skills_normalized) AS skill FROM b_dedup)
  WHERE {TRIM('skill')} IS NOT NULL AND {TRIM('skill')} <> ''
)"""
    return with_raw(f""", {LINKEDIN_LIKE_SQL.strip()}, {_li_mapped_cte('lp')}, {_li_mapped_cte('ls', 'skills')},
{DE_LIKE_SQL.strip()}, {_de_mapped_cte('dm')}, {HF_LIKE_SQL.strip()}, {_hf_mapped_cte('hm')},
b_union AS (SELECT * FROM hm UNION ALL SELECT * FROM dm UNION ALL SELECT * FROM lp UNION ALL SELECT * FROM ls),
{std}
SELECT skill, CAST(count(*) AS BIGINT) AS job_postings, CAST(count(DISTINCT source_id) AS BIGINT) AS source_count
FROM b_long GROUP BY skill""")


@query("batch_pipeline", _batch_sql())
def q_batch_pipeline(spark, sf_dir):
    """Run the batch chain end to end into scratch storage; return the skill mart."""
    from hirelake.plans.pipeline import run_batch
    from hirelake.session import scratch_path
    base = scratch_path(spark, "batch")
    marts = run_batch(spark, batch_sources(sf_dir), base, out=f"{base}/marts", table_root=f"{base}/tables")
    return marts.skill_demand


from hirelake.plans import lake_queries  # noqa: E402,F401 - registers its queries
