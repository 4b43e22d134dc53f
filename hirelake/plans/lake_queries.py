"""Registered queries of the storage, ingest-control and SQL operators (imported by ``plans.queries``)."""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hirelake.functions import skills as SK
from hirelake.operators import taxonomy as TX
from hirelake.plans import adapters as A
from hirelake.plans.oracles import CANON_OUT, D, DOMAIN, J, TAX, TS, with_raw
from hirelake.plans.queries import (INGEST_AS_OF, LINKEDIN_LIKE_SQL, MAPPED_OUT_SQL, _ingest_ts, _li_mapped_cte, _mapped_out, canon_out,
                                    query, std_k, stg_k)
from hirelake.session import scratch_path


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# =============================================================================
# Files: splittable CSV, the picked input file
# =============================================================================

#: Every sixteenth document goes to one file; the seventh file's descriptions are written eight times over.
FILES, LARGEST = 16, 7


def _picked_sql(how: str, number: int, description: str) -> str:
    return with_raw(f""", {LINKEDIN_LIKE_SQL.strip()},
li_file AS (SELECT * REPLACE ({description} AS description) FROM li WHERE CAST(job_id AS BIGINT) % {FILES} = {number}),
{_li_mapped_cte('lp', src='li_file')}
SELECT '{how}' AS picked, {MAPPED_OUT_SQL} FROM lp""")


@query("picked_input_file", f"{_picked_sql('largest', LARGEST, 'repeat(description, 8)')}\nUNION ALL SELECT * FROM ({_picked_sql('first', 0, 'description')})")
def q_picked_input_file(spark, sf_dir):
    """Files of different size and header in one tree: the rows of the largest one and of the first one."""
    from hirelake.operators.mapping import map_linkedin
    from hirelake.sources.files import pick_input_file, read_csv_source
    folder = scratch_path(spark, "picked_csv")
    rows = A.linkedin_like(spark, sf_dir)
    number = F.col("job_id").cast("long") % FILES
    rows = rows.withColumn("file", F.lpad(number.cast("string"), 3, "0"))
    repeated = F.when(number == LARGEST, F.repeat("description", 8)).otherwise(F.col("description"))  # behind the shuffle: one task reads a file's rows
    write = lambda df: df.repartition(FILES, "file").withColumns({"description": repeated} if "description" in df.columns else {}).write.mode("append").partitionBy("file").option("header", True).option("escape", '"').csv(folder)
    write(rows.where(number != 3))
    write(rows.where(number == 3).select("file", "job_id", F.col("description").alias("notes")))  # another header
    parts = []
    for how in ("largest", "first"):
        read = read_csv_source(spark, pick_input_file(spark, folder, how))
        parts.append(_mapped_out(map_linkedin(read, "postings", as_of=INGEST_AS_OF, ingested_at=_ingest_ts())).withColumn("picked", F.lit(how)))
    return _union(parts)


@query("csv_multiline_scan", "SELECT doc_id, text, text || chr(13) || chr(10) || '\"' || source || '\",' AS quoted FROM documents")
def q_csv_multiline_scan(spark, sf_dir):
    """Texts with quotes, commas and both kinds of line breaks, written as CSV and cut into records in parallel."""
    from hirelake.sources.files import read_csv_source
    folder = scratch_path(spark, "multiline_csv")
    docs = A.read_table(spark, sf_dir, "documents")
    docs.select("doc_id", "text", F.concat("text", F.lit('\r\n"'), "source", F.lit('",')).alias("quoted")).write.option(
        "header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(folder)
    back = read_csv_source(spark, folder, na_values=[])
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "quoted")


# =============================================================================
# Taxonomies as tables
# =============================================================================

@query("taxonomy_table_skills", with_raw(f"SELECT row_key, {J(TAX('job_title', 'job_description'))} AS taxonomy_skills FROM std_k"))
def q_taxonomy_table_skills(spark, sf_dir):
    """The built-in taxonomy, found by the n-gram join."""
    s = std_k(spark, sf_dir).select("row_key", "job_title", "job_description")
    found = TX.with_taxonomy_table(s, "row_key", TX.taxonomy_table(spark))
    return found.select("row_key", SK.skills_text("skills_taxonomy").alias("taxonomy_skills"))


WORD_SQL = "[\\p{L}\\p{M}\\p{N}_]+"
PAIRS_SQL = f"""
pieces AS (SELECT id, kind, regexp_extract_all(lower(text), '{WORD_SQL}[^\\p{{L}}\\p{{M}}\\p{{N}}_]*') AS w
  FROM (SELECT item_id AS id, 'term' AS kind, text FROM benchmark UNION ALL SELECT doc_id, 'doc', text FROM documents)),
pairs AS (SELECT id, kind, unnest(list_transform(range(1, len(w)), lambda i: w[i] || regexp_extract(w[i + 1], '^{WORD_SQL}'))) AS pair FROM pieces)"""


@query("taxonomy_large", f"""WITH {PAIRS_SQL.strip()},
terms AS (SELECT DISTINCT pair FROM pairs WHERE kind = 'term'),
hits AS (SELECT DISTINCT id, pair FROM pairs JOIN terms USING (pair) WHERE kind = 'doc')
SELECT id AS doc_id, CAST(count(*) AS BIGINT) AS n_terms, md5(string_agg('t:' || pair, chr(10) ORDER BY 't:' || pair)) AS terms_md5 FROM hits GROUP BY id""")
def q_taxonomy_large(spark, sf_dir):
    """Every pair of neighbouring words of the benchmark texts as a term: tens of thousands, found in all documents by one join."""
    bench = A.read_table(spark, sf_dir, "benchmark").select(F.lower("text").alias("t"))
    words, gaps = TX.words_and_gaps(F.col("t"))
    cut = bench.select(words.alias("w"), gaps.alias("g"))
    pair = F.transform(F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: i < F.size("w")),
                       lambda i: F.concat(F.get("w", i - 1), F.get("g", i), F.get("w", i)))
    terms = cut.select(F.explode(pair).alias("pattern")).distinct().select("pattern", F.concat(F.lit("t:"), "pattern").alias("canonical"))
    docs = A.read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("job_description"), F.lit(None).cast("string").alias("job_title"))
    found = TX.taxonomy_matches(docs, "doc_id", terms)
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"),
                                       F.md5(F.array_join(F.sort_array(F.collect_list("canonical")), "\n").cast("binary")).alias("terms_md5"))


# =============================================================================
# Rejects and counters, drifted files, atomic loads, resumable ingest
# =============================================================================

@query("ingest_quality", with_raw(f""", {LINKEDIN_LIKE_SQL.strip()}, {_li_mapped_cte('lp')},
judged AS (
  SELECT posted_date < DATE '{INGEST_AS_OF}' - 1095 AS old, NOT coalesce({DOMAIN('job_title', 'job_description', 'skills')}, false) AS other,
    job_url IN (SELECT job_link FROM li WHERE posted_date = 'junk') AS undated FROM lp_all)
SELECT 'observed' AS taken, 'rows_in' AS measure, CAST(count(*) AS BIGINT) AS n FROM judged
UNION ALL SELECT 'observed', 'rows_kept', count_if(NOT old AND NOT other) FROM judged
UNION ALL SELECT 'observed', 'rows_rejected', count_if(old OR other) FROM judged
UNION ALL SELECT 'observed', 'rejected_not_recent', count_if(old) FROM judged
UNION ALL SELECT 'observed', 'rejected_not_data_domain', count_if(other) FROM judged
UNION ALL SELECT 'observed', 'defaulted_posted_date', count_if(undated AND NOT old AND NOT other) FROM judged
UNION ALL SELECT 'reject table', 'not_recent', count_if(old) FROM judged HAVING count_if(old) > 0
UNION ALL SELECT 'reject table', 'not_data_domain', count_if(other) FROM judged HAVING count_if(other) > 0"""))
def q_ingest_quality(spark, sf_dir):
    """What the mapper left out and why: counters of the write itself, and the reject table's reasons."""
    from hirelake.operators.checks import REASONS, write_checked
    from hirelake.operators.mapping import map_linkedin
    folder = scratch_path(spark, "checked")
    rows = map_linkedin(A.linkedin_like(spark, sf_dir), "postings", as_of=INGEST_AS_OF, ingested_at=_ingest_ts(), judge=True)
    done = write_checked(rows, f"{folder}/rows", f"{folder}/rejects", ["not_recent", "not_data_domain"], ["posted_date"])
    observed = spark.createDataFrame([("observed", k, n) for k, n in done.counters.items()], "taken string, measure string, n long")
    if not done.rejects:
        return observed
    rejects = (spark.read.parquet(done.rejects).select(F.explode(REASONS).alias("measure")).groupBy("measure").agg(F.count(F.lit(1)).alias("n"))
               .select(F.lit("reject table").alias("taken"), "measure", "n"))
    return observed.unionByName(rejects)


@query("load_drifted_files", """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 2 THEN 'c' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS VARCHAR) AS customer,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS priority FROM orders""")
def q_load_drifted_files(spark, sf_dir):
    """Three loads of a dataset with other columns and types each: all rows and columns arrive in the raw table."""
    from hirelake.sources import sinks
    base = scratch_path(spark, "drifted")
    o, k = A.read_table(spark, sf_dir, "orders"), F.col("o_orderkey")
    folder = f"{base}/raw/orders"
    o.where(k % 3 == 0).select(k, F.col("o_custkey").cast("int").alias("customer"), F.col("o_orderstatus").alias("status")).write.parquet(f"{folder}/a")
    o.where(k % 3 == 1).select(k, F.col("o_custkey").cast("long").alias("customer"), F.col("o_orderpriority").alias("priority")).write.parquet(f"{folder}/b")
    o.where(k % 3 == 2).select(k, F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("customer"),
                               F.col("o_orderpriority").alias("priority")).write.parquet(f"{folder}/c")
    table = f"raw_drifted_{uuid.uuid4().hex[:12]}"
    sinks.load_raw_table(spark, base, "orders", table, f"{base}/tables")
    return spark.table(table).select("o_orderkey", "customer", "status", "priority")


@query("ingest_resumed", with_raw(f""", {LINKEDIN_LIKE_SQL.strip()}, {_li_mapped_cte('lp')}
SELECT 'lake' AS part, source_id, CAST(count(*) AS BIGINT) AS n FROM lp GROUP BY 2
UNION ALL SELECT 'lake', source_id, count(*) FROM raw_orders_k GROUP BY 2
UNION ALL SELECT 'lake', source_id, count(*) FROM raw_pages_k GROUP BY 2
UNION ALL SELECT 'mapped', 'li', 1 UNION ALL SELECT 'mapped', 'orders', 1 UNION ALL SELECT 'mapped', 'pages', 2"""))
def q_ingest_resumed(spark, sf_dir):
    """A run that fails at its third source publishes nothing; resumed, it maps only what was missing."""
    from hirelake.operators.mapping import map_linkedin
    from hirelake.plans.pipeline import SourceSpec, ingest
    from hirelake.sources.versions import Lake
    base, run_id, mapped = scratch_path(spark, "resumed"), uuid.uuid4().hex[:12], []
    raw = A.raw_tables(spark, sf_dir)

    def source(name, build):
        def counted(s):
            mapped.append(name)
            rows = build()
            return rows.withColumn("job_title", F.raise_error(F.lit("lost the source"))) if mapped.count("pages") == 1 and name == "pages" else rows
        return SourceSpec(name, name, f"raw_{name}", counted)

    specs = [source("li", lambda: map_linkedin(A.linkedin_like(spark, sf_dir), "postings", as_of=INGEST_AS_OF, ingested_at=_ingest_ts())),
             source("orders", lambda: raw["raw_orders"]), source("pages", lambda: raw["raw_pages"])]
    try:
        ingest(spark, specs, base, run_id=run_id)
        raise AssertionError("the run should have failed")
    except Exception as e:  # noqa: BLE001
        if "lost the source" not in str(e):
            raise
    lake = Lake(spark, base)
    assert lake.published() == {}
    ingest(spark, specs, base, run_id=run_id)
    rows = _union([spark.read.parquet(lake.path(s.dataset)).groupBy("source_id").agg(F.count(F.lit(1)).alias("n")) for s in specs])
    counts = spark.createDataFrame([("mapped", s.name, mapped.count(s.name)) for s in specs], "part string, source_id string, n long")
    return rows.select(F.lit("lake").alias("part"), "source_id", "n").unionByName(counts)


# =============================================================================
# Relations, views and functions of the catalog
# =============================================================================

def _stored(spark, df: DataFrame, name: str) -> None:
    """Rows as Parquet in the scratch folder and a stored view of that name over them."""
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    spark.sql(f"CREATE VIEW {name} AS SELECT * FROM parquet.`{path}`")


@query("explore_relation_modes", with_raw(f"""
SELECT 'raw_single' AS relation_mode, {CANON_OUT} FROM raw_orders_k
UNION ALL SELECT 'raw_pick', {CANON_OUT} FROM raw_pages_k
UNION ALL SELECT 'master_jobs', {CANON_OUT} FROM master_clean"""))
def q_explore_relation_modes(spark, sf_dir):
    """The relation to explore: the only raw table, the named one of two, the master once there is one."""
    from hirelake.sources.catalog import jobs_relation
    from hirelake.sources.sinks import create_persistent_master_view
    db = f"explore_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db}")
    raw = A.raw_tables(spark, sf_dir)
    parts = []

    def relation(table=None):
        rows, mode = jobs_relation(spark, table, db)
        parts.append(canon_out(rows, extra=(F.lit(mode).alias("relation_mode"),)))

    _stored(spark, raw["raw_orders"], f"{db}.raw_orders")
    relation()
    _stored(spark, raw["raw_pages"], f"{db}.raw_pages")
    relation("raw_pages")
    for name in ("raw_events", "raw_documents"):
        _stored(spark, raw[name], f"{db}.{name}")
    create_persistent_master_view(spark, [f"{db}.{n}" for n in A.RAW_TABLES], f"{db}.master_jobs")
    relation()
    return _union(parts)


@query("master_view_stored", with_raw(f"SELECT {CANON_OUT}, is_complete FROM master_clean"))
def q_master_view_stored(spark, sf_dir):
    """The master as a stored view over stored raw tables, read by another session."""
    from hirelake.sources.sinks import create_persistent_master_view
    run = uuid.uuid4().hex[:12]
    names = []
    for name, df in A.raw_tables(spark, sf_dir).items():
        names.append(f"{name}_{run}")
        _stored(spark, df, names[-1])
    create_persistent_master_view(spark, names, f"master_jobs_{run}")
    return canon_out(spark.newSession().table(f"master_jobs_{run}"), extra=("is_complete",))


@query("sql_functions", with_raw(f"""
SELECT row_key, {J('skills_normalized')} AS skills_normalized, job_url_normalized, dedup_key,
  coalesce(nullif(job_title, ''), '') <> '' AND (coalesce(job_description, '') <> '' OR len(skills_normalized) > 0) AS is_complete FROM keyed"""))
def q_sql_functions(spark, sf_dir):
    """The shared expressions called from SQL, over the untrimmed raw rows."""
    from hirelake.functions.sql import register_sql_functions
    register_sql_functions(spark, "job_")
    return spark.sql("""
        SELECT row_key, array_join(job_normalize_skills(skills), '|') AS skills_normalized, job_url_key(job_url) AS job_url_normalized,
          job_dedup_key(source_id, job_url, job_title, company_name, posted_date, location) AS dedup_key,
          job_is_complete(job_title, job_description, size(job_normalize_skills(skills))) AS is_complete
        FROM {raw}""", raw=stg_k(spark, sf_dir))


@query("enrich_ledger", with_raw(f"""
SELECT row_key, {J("list_filter(w, lambda x, i: length(x) >= 3 AND contains(d, x) AND list_position(w, x) = i)")} AS skills_enriched,
  false AS enrich_failed
FROM (SELECT row_key, lower(coalesce(job_description, '')) AS d, list_transform(
        regexp_split_to_array(lower(coalesce(job_title, '')), '\\s+'), lambda x: trim(x, '.,;:!?()[]{{}}"''')) AS w FROM std_k)"""))
def q_enrich_ledger(spark, sf_dir):
    """Enrichment with one call a distinct text: half of the rows first, then all of them with the same ledger."""
    from hirelake.operators.enrich import enrich_once, title_terms_in_description
    from hirelake.plans.pipeline import persist_point
    ledger = scratch_path(spark, "ledger")
    s = std_k(spark, sf_dir).select("row_key", "job_title", "job_description")
    s = persist_point(s, scratch_path(spark, "to_enrich"))  # read four times
    enrich_once(s.where(F.pmod(F.xxhash64("row_key"), F.lit(2)) == 0), title_terms_in_description, ledger, batch_size=10)
    e = enrich_once(s, title_terms_in_description, ledger, batch_size=10, rounds=2)
    return e.select("row_key", SK.skills_text("skills_enriched").alias("skills_enriched"), "enrich_failed")


@query("health_from_footers", with_raw("""
SELECT 'raw_orders' AS table_name, CAST(count(*) AS BIGINT) AS row_count, strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S.%f') AS last_ingested,
  CAST(NULL AS VARCHAR) AS error FROM raw_orders_k
UNION ALL SELECT 'raw_documents', count(*), strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S.%f'), NULL FROM raw_documents_k
UNION ALL SELECT 'raw_empty', 0, NULL, NULL UNION ALL SELECT 'raw_legacy', NULL, NULL, 'not_found'"""))
def q_health_from_footers(spark, sf_dir):
    """Counts and latest load times of stored raw tables, taken from the files' statistics."""
    from hirelake.operators.quality import stored_health
    from hirelake.plans.queries import ts2s
    folder, raw = scratch_path(spark, "health"), A.raw_tables(spark, sf_dir)
    for name, df in (("raw_orders", raw["raw_orders"]), ("raw_documents", raw["raw_documents"]), ("raw_empty", raw["raw_pages"].where("false"))):
        df.write.parquet(f"{folder}/{name}")
    h = stored_health(spark, {n: f"{folder}/{n}" for n in ("raw_orders", "raw_documents", "raw_empty", "raw_legacy")})
    return h.select("table_name", "row_count", ts2s("last_ingested").alias("last_ingested"), "error")


@query("jobs_deduplicated_late", with_raw(f"""
SELECT row_key, source_id, job_title, job_description, company_name, location, {D('posted_date')} AS posted_date,
  job_url, {J('skills_normalized')} AS skills_normalized, salary_info, {TS('ingested_at')} AS ingested_at
FROM dedup"""))
def q_jobs_deduplicated_late(spark, sf_dir):
    """Deduplicated rows of stored raw tables, ranked without texts and fetched by their places in the files."""
    from hirelake.operators import silver as S
    from hirelake.plans.queries import d2s, ts2s
    stored = _union([S.located(df) for df in A.raw_tables(spark, sf_dir, with_key=True).values()])
    _, whole = S.deduplicate_late(stored, tie_breakers=("row_key",), carry=(), make=lambda rows: S.standardize(rows, keep=("row_key", *S.LOCATOR)))
    return whole.select("row_key", "source_id", "job_title", "job_description", "company_name", "location", d2s("posted_date").alias("posted_date"), "job_url",
                        SK.skills_text("skills_normalized").alias("skills_normalized"), "salary_info", ts2s("ingested_at").alias("ingested_at"))
