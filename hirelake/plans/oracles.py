"""Independent DuckDB SQL for every registered query.

The supplied tables are views in DuckDB; ``RAW_CTES`` rebuilds the four raw
posting tables from them with the same rules as ``adapters`` and the rest
restates each layer in plain SQL.  Helpers below only expand text.
"""
from __future__ import annotations

from hirelake.functions.skills import default_taxonomy, taxonomy_groups
from hirelake.functions.vocab import DOMAIN_KEYWORDS, WHITESPACE
from hirelake.plans import adapters as A

WS = "(" + "||".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def TRIM(x: str) -> str:
    return f"trim({x}, {WS})"


def NB(x: str) -> str:
    return f"nullif({TRIM(x)}, '')"


def D(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def TS(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def J(x: str) -> str:
    return f"array_to_string({x}, '|')"


def CLEAN(x: str) -> str:
    return f"list_filter(list_transform({x}, lambda s: {TRIM('s')}), lambda s: s <> '')"


def JSON_ARR(x: str) -> str:
    t = TRIM(x)
    return (f"CASE WHEN {t} LIKE '[%' AND json_valid({t}) AND json_type({t}) = 'ARRAY' "
            f"AND NOT list_has_any(json_type({t}, '$[*]'), ['OBJECT', 'ARRAY']) "
            f"THEN from_json({t}, '[\"VARCHAR\"]') END")


def NORM(x: str) -> str:
    return f"coalesce({CLEAN(JSON_ARR(x))}, [])"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WORDCH = r"[^\p{L}\p{N}_]"


def TAX(title: str, desc: str) -> str:
    text = f"lower(concat_ws(' ', {NB(title)}, {NB(desc)}))"
    cases = []
    for canon, pats in taxonomy_groups(default_taxonomy()):
        alts = "|".join(p.lower() for p in pats)
        rx = f"(^|{WORDCH})(?:{alts})($|{WORDCH})"
        cases.append(f"CASE WHEN regexp_matches({text}, {_sql_str(rx)}) THEN {_sql_str(canon)} END")
    return f"list_sort(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))"


def SKILL_SET(x: str) -> str:
    return f"list_distinct(list_filter(list_transform(coalesce({x}, []), lambda s: lower({TRIM('s')})), lambda s: s <> ''))"


def JACCARD(a: str, b: str) -> str:
    sa, sb = SKILL_SET(a), SKILL_SET(b)
    return (f"CASE WHEN len({sa}) = 0 AND len({sb}) = 0 THEN 1.0 "
            f"WHEN len({sa}) = 0 OR len({sb}) = 0 THEN 0.0 "
            f"ELSE len(list_intersect({sa}, {sb}))::DOUBLE / len(list_distinct(list_concat({sa}, {sb}))) END")


def DOMAIN(title: str, desc: str, skills: str) -> str:
    text = (f"lower(concat_ws(' ', nullif({title}, ''), nullif({desc}, ''), "
            f"CASE WHEN len({skills}) > 0 THEN array_to_string({skills}, ' ') END))")
    return "(" + " OR ".join(f"contains({text}, {_sql_str(k.lower())})" for k in DOMAIN_KEYWORDS) + ")"


CANON = ("source_id, source_name, job_title, job_description, company_name, location, posted_date, "
         "job_url, skills, salary_info, ingested_at")

RAW_CTES = f"""
order_names AS (
  SELECT l.l_orderkey, list_sort(list_distinct(list(p.p_name))) AS names
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey
),
orders_rows AS (
  SELECT o.o_orderkey AS k,
    'o:' || CAST(o.o_orderkey AS VARCHAR) AS row_key,
    'src_orders' AS source_id, 'Orders feed' AS source_name,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 23 = 0 THEN '  '
         ELSE o.o_orderpriority END AS job_title,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderstatus || ' order by ' || c.c_name END AS job_description,
    '  ' || c.c_name || chr(9) AS company_name,
    n.n_name AS location,
    CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS posted_date,
    'HTTPS://Jobs.Example.com/' || CAST(o.o_orderkey % 4000 AS VARCHAR) || ' ' AS job_url,
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL
         WHEN nm.names IS NULL OR len(nm.names) = 0 THEN NULL
         WHEN o.o_orderkey % 17 = 0 THEN 'not json'
         WHEN o.o_orderkey % 19 = 0 THEN '[" ", null, ' || CAST(o.o_orderkey % 97 + 1 AS VARCHAR) || ', "'
              || array_to_string(nm.names, '","') || '"]'
         ELSE '["' || array_to_string(nm.names, '","') || '"]' END AS skills,
    CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS VARCHAR) AS salary_info,
    o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS BIGINT)) AS ingested_at
  FROM orders o
  LEFT JOIN order_names nm ON o.o_orderkey = nm.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_orders_k AS (
  SELECT row_key, {CANON} FROM orders_rows
  UNION ALL
  SELECT row_key || ':u', source_id, source_name, job_title, 'updated', company_name, location, posted_date,
         job_url, skills, salary_info, ingested_at + INTERVAL 1 DAY FROM orders_rows WHERE k % 10 = 0
  UNION ALL
  SELECT row_key || ':t', source_id, source_name, job_title, 'duplicate load', company_name, location,
         posted_date, job_url, skills, salary_info, ingested_at FROM orders_rows WHERE k % 29 = 0
),
raw_events_k AS (
  SELECT 'e:' || CAST(event_id AS VARCHAR) AS row_key, 'src_events' AS source_id, 'Events feed' AS source_name,
    event_type AS job_title, CAST(NULL AS VARCHAR) AS job_description,
    'user-' || CAST(user_id % 50 AS VARCHAR) AS company_name, CAST(NULL AS VARCHAR) AS location,
    CAST(ts AS DATE) AS posted_date, 'https://jobs.example.com/' || CAST(event_id % 4000 AS VARCHAR) AS job_url,
    props AS skills, CAST(NULL AS VARCHAR) AS salary_info, ts AS ingested_at
  FROM events
),
doc_words AS (
  SELECT *, regexp_extract(text, '{A.WORD}', 0) AS w1,
         reverse(regexp_extract(reverse(text), '{A.WORD}', 0)) AS w2
  FROM documents
),
raw_documents_k AS (
  SELECT 'd:' || CAST(doc_id AS VARCHAR) AS row_key, 'src_documents' AS source_id, 'Documents feed' AS source_name,
    upper(lang) || ' document ' || source AS job_title, text AS job_description,
    source AS company_name, lang AS location,
    DATE '2023-01-01' + CAST(doc_id % 900 AS INTEGER) AS posted_date, CAST(NULL AS VARCHAR) AS job_url,
    CASE WHEN w1 <> '' THEN '["' || w1 || '","' || w2 || '"]' ELSE '[]' END AS skills,
    CAST(NULL AS VARCHAR) AS salary_info,
    TIMESTAMP '2024-06-01 00:00:00' + to_minutes(doc_id) AS ingested_at
  FROM doc_words
),
raw_documents_arr AS (
  SELECT 'da:' || CAST(doc_id AS VARCHAR) AS row_key,
    CASE WHEN w1 <> '' THEN [w1, w2] ELSE CAST([] AS VARCHAR[]) END AS skills
  FROM doc_words
),
raw_pages_k AS (
  SELECT 'p:' || CAST(page_id AS VARCHAR) AS row_key, 'src_pages' AS source_id, 'Pages feed' AS source_name,
    regexp_extract(url, '{A.URL_PATH}', 1) AS job_title, html AS job_description,
    CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS VARCHAR) AS location,
    DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER) AS posted_date, url AS job_url,
    '[]' AS skills, CAST(NULL AS VARCHAR) AS salary_info,
    TIMESTAMP '2024-06-01 00:00:00' + to_minutes(page_id) AS ingested_at
  FROM pages
),
stg_k AS (
  SELECT * FROM raw_orders_k UNION ALL SELECT * FROM raw_events_k
  UNION ALL SELECT * FROM raw_documents_k UNION ALL SELECT * FROM raw_pages_k
),
stg AS (SELECT {CANON} FROM stg_k),
std_k AS (
  SELECT row_key, source_id, source_name, {NB('job_title')} AS job_title, {NB('job_description')} AS job_description,
    {NB('company_name')} AS company_name, {NB('location')} AS location, posted_date,
    {NB('job_url')} AS job_url, lower({NB('job_url')}) AS job_url_normalized,
    {NORM('skills')} AS skills_normalized, salary_info, ingested_at, skills AS skills_raw
  FROM stg_k
),
keyed AS (
  SELECT *, source_id || '#' || coalesce({NB('job_url')}, '_nourl_') || '#' || coalesce({TRIM('job_title')}, '')
    || '#' || coalesce({TRIM('company_name')}, '') || '#' || CAST(posted_date AS VARCHAR) || '#'
    || coalesce({TRIM('location')}, '') AS dedup_key
  FROM std_k
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id, dedup_key ORDER BY ingested_at DESC NULLS LAST,
      job_url ASC NULLS LAST, md5(concat_ws(chr(31), coalesce(source_name, chr(1)), coalesce(job_title, chr(1)),
        coalesce(job_description, chr(1)), coalesce(company_name, chr(1)), coalesce(location, chr(1)),
        coalesce(skills_raw, chr(1)), coalesce(salary_info, chr(1)), coalesce(row_key, chr(1)))) ASC) AS rn
    FROM keyed) WHERE rn = 1
),
skills_long AS (
  SELECT source_id, source_name, job_title, company_name, posted_date, job_url, ingested_at,
         {TRIM('skill')} AS skill
  FROM (SELECT *, unnest(skills_normalized) AS skill FROM dedup)
  WHERE {TRIM('skill')} IS NOT NULL AND {TRIM('skill')} <> ''
),
curated AS (
  SELECT *, CAST(len(skills_normalized) AS BIGINT) AS skill_count,
    (coalesce({TRIM('job_title')}, '') <> '' AND (coalesce({TRIM('job_description')}, '') <> ''
      OR len(skills_normalized) > 0)) AS is_complete,
    CASE WHEN posted_date IS NULL THEN 'missing_date'
         WHEN coalesce({TRIM('job_title')}, '') = '' THEN 'missing_title'
         WHEN coalesce({TRIM('job_description')}, '') = '' AND len(skills_normalized) = 0 THEN 'thin_description'
         ELSE 'ok' END AS content_quality_bucket
  FROM dedup
),
skill_demand AS (
  SELECT skill, CAST(count(*) AS BIGINT) AS job_postings, CAST(count(DISTINCT source_id) AS BIGINT) AS source_count
  FROM skills_long GROUP BY skill
),
posting_volume AS (
  SELECT source_id, CAST(date_trunc('month', posted_date) AS DATE) AS posting_month,
    CAST(count(*) AS BIGINT) AS job_postings,
    CAST(count_if(coalesce({TRIM('job_title')}, '') <> '' AND (coalesce({TRIM('job_description')}, '') <> ''
      OR len(skills_normalized) > 0)) AS BIGINT) AS complete_postings
  FROM dedup WHERE posted_date IS NOT NULL GROUP BY ALL
),
master_clean AS (
  SELECT source_id, source_name, job_title, job_description, company_name, location, posted_date, job_url,
    skills, coalesce(salary_info, '') AS salary_info, ingested_at,
    ({TRIM("coalesce(job_title, '')")} <> '' AND ({TRIM("coalesce(job_description, '')")} <> ''
      OR skills IS NOT NULL)) AS is_complete
  FROM stg
)
"""


def with_raw(body: str) -> str:
    body = body.strip()
    if body[:5].upper() == "WITH ":
        body = ", " + body[5:]
    return f"WITH {RAW_CTES.strip()}\n{body}"


CANON_OUT = (f"source_id, source_name, job_title, job_description, company_name, location, "
             f"{D('posted_date')} AS posted_date, job_url, skills, salary_info, {TS('ingested_at')} AS ingested_at")
