import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, canon_frame, one
from hirelake.functions.dates import parse_iso_date
from hirelake.operators import canned, explore
from hirelake.operators import quality as Q
from hirelake.operators.enrich import enrich
from hirelake.operators.mapping import de_column_map, linkedin_column_map
from hirelake.schema import JOBS_COLUMNS, conform


@pytest.mark.parametrize("value,expected", [
    ("2024-01-05", dt.date(2024, 1, 5)), ("2024-01-05T23:30:00-05:00", dt.date(2024, 1, 5)),
    ("2024-01-05T10:00:00Z", dt.date(2024, 1, 5)), ("2024-01-05 x", None), ("junk", None), ("2024-01", None),
])
def test_iso_dates(spark, value, expected):
    assert one(spark, parse_iso_date, value) == expected


@pytest.mark.parametrize("value,expected", [(0, 1), (101, 100), ("abc", 15), (None, 15), ("7", 7)])
def test_coerce(value, expected):
    assert canned.Number("limit", 15, 1, 100).read(value) == expected


def test_canned_registry(spark):
    assert set(canned.CANNED) == {"source_row_counts", "top_skills", "posting_volume", "raw_table_health"}
    with pytest.raises(ValueError, match="allowed"):
        canned.run_canned("arbitrary_sql", {})


def test_conform_contract(spark):
    df = spark.createDataFrame([("s", "S", ["Python", "SQL"], "2024-01-15", "x")],
                               "source_id string, source_name string, skills array<string>, posted_date string, "
                               "extra string")
    out = conform(df)
    assert tuple(out.columns) == JOBS_COLUMNS
    r = out.first()
    assert r.skills == '["Python","SQL"]' and r.posted_date == dt.date(2024, 1, 15)
    bad = spark.createDataFrame([("s", None)], "source_id string, source_name string")
    with pytest.raises(Exception):
        conform(bad).collect()
    assert conform(bad, on_invalid="drop").count() == 0


def test_quality_gate(spark):
    from hirelake.plans import adapters as A
    A.register_raw_views(spark, SF_SMALL)
    spark.range(0).select(F.lit("s").alias("source_id"), F.current_timestamp().alias("ingested_at")) \
        .createOrReplaceTempView("raw_empty")
    h = Q.raw_table_health(spark, ["raw_events", "raw_empty", "raw_gone", "raw_kaggle_linkedin_postings"])
    last = h.where("table_name = 'raw_events'").first().last_ingested
    fails = {(r.table_name, r.failure) for r in Q.quality_gate(h, as_of=last + dt.timedelta(hours=72),
                                                                max_age_hours=72).collect()}
    assert fails == {("raw_empty", "zero_rows"), ("raw_gone", "missing")}
    stale = Q.quality_gate(h, as_of=last + dt.timedelta(hours=73), max_age_hours=72).collect()
    assert ("raw_events", "stale") in {(r.table_name, r.failure) for r in stale}
    ignored = Q.quality_gate(h, as_of=last + dt.timedelta(hours=73), max_age_hours=72, ignore_stale=True).collect()
    assert "stale" not in {r.failure for r in ignored}


def test_not_null_counts(spark):
    df = canon_frame(spark, [dict(job_title=None), dict(job_title="x")])
    got = {r.column_name: r.null_rows for r in Q.not_null_counts(df, ["source_id", "job_title"]).collect()}
    assert got == {"source_id": 0, "job_title": 1}


def test_linkedin_map_rules():
    m = linkedin_column_map(["job_id", "company_name", "title", "description", "location", "pay_period",
                             "posted_date", "job_link", "skills_desc", "company_id", "skills"])
    assert m["company_name"] == ["company_name", "company_id"]
    assert m["job_description"] == ["description", "skills_desc"]
    assert m["skills"] == ["skills"] and "job_id" not in sum(m.values(), [])
    assert linkedin_column_map(["job"], "skills") == {"job_title": ["job"]}


def test_de_map_rules():
    cols = ["Job_details", "Job_details.1", "Company_info", "Job_details.4", "Salary.2", "location", "Salary raw"]
    pairs = de_column_map(cols)
    assert ("location", "location") in pairs and ("Salary raw", "salary_info") in pairs
    assert de_column_map(["Job Title", "Description", "Company-Name"]) == [
        ("Job Title", "job_title"), ("Description", "job_description"), ("Company-Name", "company_name")]


def test_de_and_linkedin_blank_overwrite(spark):
    from hirelake.operators.mapping import map_de_2023, map_linkedin
    de = spark.createDataFrame([("T", "desc", "Acme", "   ")],
                               "`Job Title` string, description string, company string, company_name string")
    assert map_de_2023(de, as_of="2024-01-01").first().company_name == "Acme"
    li = spark.createDataFrame([("Data engineer", "Acme", " ", "2024-01-02")],
                               "title string, company_name string, company_id string, posted_date string")
    r = map_linkedin(li, as_of="2024-01-05").first()
    assert r.company_name == "" and r.posted_date == dt.date(2024, 1, 2)


def test_enrich_failures(spark):
    df = spark.range(25).select(F.col("id").cast("string").alias("job_title"),
                                F.lit("d").alias("job_description")).coalesce(1)

    def fn(rows):
        if rows[0][0] == "10":
            raise RuntimeError("boom")
        if rows[0][0] == "20":
            return [["x"]]
        return [[f" {t} ", None, ""] for t, _ in rows]
    rows = enrich(df, fn, batch_size=10).collect()
    out = {r.job_title: r.skills_enriched for r in rows}
    assert out["0"] == ["0"] and out["15"] == [] and out["21"] == [] and out["9"] == ["9"]
    assert {r.job_title for r in rows if r.enrich_failed} == {str(i) for i in range(10, 25)}


def test_enrich_passes_other_columns_exactly_and_drops_falsy_items(spark):
    df = spark.createDataFrame([(9007199254740993, "a", None), (None, "b", "d")], "big long, job_title string, job_description string")
    rows = enrich(df.coalesce(1), lambda rows: [[0, False, "", None, " x ", 7] for _ in rows]).collect()
    assert [r.big for r in rows] == [9007199254740993, None]
    assert rows[0].skills_enriched == ["x", "7"] and not rows[0].enrich_failed


def test_enrich_groups_run_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(25).selectExpr("cast(id AS string) AS job_title", "'d' AS job_description").coalesce(1)
        sizes = [r.skills_enriched[0] for r in enrich(df, lambda rows: [[str(len(rows))] for _ in rows], 10).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sizes == ["10"] * 20 + ["5"] * 5


def test_browse_honours_any_limit(spark):
    df = spark.range(6000).selectExpr("cast(id AS string) AS job_title", "'c' AS company_name", "'l' AS location", "DATE'2024-01-01' AS posted_date",
                                      "'s' AS source_id", "'u' AS job_url", "'d' AS job_description")
    assert explore.browse_jobs(df, 10).count() == 10 and explore.browse_jobs(df, 5000).count() == 5000


def test_dedup_winner_does_not_depend_on_input_order(spark):
    from hirelake.operators import silver as S
    rows = [dict(job_title="t", posted_date=dt.date(2024, 1, 5), source_name=n) for n in ("A", "B", "C")]
    winners = {S.deduplicate(S.standardize(canon_frame(spark, rs))).first().source_name for rs in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert len(winners) == 1


@pytest.mark.parametrize("value", ["04/18/2024 10:30 AM", "2024-04-18 10:30:00 UTC", "18 April 2024", "Apr 18 2024", "2024-4-18"])
def test_general_dates(spark, value):
    from hirelake.functions.dates import parse_date_general
    assert one(spark, parse_date_general, value) == dt.date(2024, 4, 18)


@pytest.mark.parametrize("value", ["1713397508000.0", "1.713397508e+12", "1713397508000"])
def test_epoch_text(spark, value):
    from hirelake.functions.dates import parse_date_general
    assert one(spark, lambda c: parse_date_general(c, "ms"), value) == dt.date(2024, 4, 17)
    assert one(spark, parse_date_general, "1713397508000.0") is None


def test_health_reports_a_table_without_the_column(spark):
    spark.range(3).createOrReplaceTempView("raw_odd")
    h = Q.raw_table_health(spark, ["raw_odd", "raw_none"])
    errors = {r.table_name: r.error for r in h.collect()}
    spark.catalog.dropTempView("raw_odd")
    assert errors["raw_odd"].startswith("UNRESOLVED_COLUMN") and errors["raw_none"] == "not_found"
    assert {(r.table_name, r.failure) for r in Q.quality_gate(h, "2024-01-01").collect()} == {("raw_odd", "error"), ("raw_none", "missing")}


def test_sinks_roundtrip(spark, tmpdir_path):
    from hirelake.sources import sinks
    from hirelake.sources.files import pick_input_file, read_csv_source
    df = canon_frame(spark, [dict(job_title="a", posted_date=dt.date(2024, 1, 5)),
                             dict(job_title="b", posted_date=None)])
    sinks.write_lake(df, tmpdir_path, "ds")
    assert sinks.load_raw_table(spark, tmpdir_path, "ds", "raw_ds_test")
    assert spark.table("raw_ds_test").count() == 2
    assert not sinks.load_raw_table(spark, tmpdir_path, "missing", "raw_ds_test")
    assert spark.table("raw_ds_test").count() == 2
    with pytest.raises(ValueError):
        sinks.refresh_master_table(spark, df, "master_jobs_t")
    assert sinks.create_master_table(spark, df, "master_jobs_t")
    assert spark.table("master_jobs_t").count() == 0
    sinks.refresh_master_table(spark, df, "master_jobs_t")
    assert spark.table("master_jobs_t").count() == 2
    p = sinks.write_partitioned(df, os.path.join(tmpdir_path, "mart"), "posted_date", ("source_id",))
    scan = sinks.read_partitioned(spark, p, "posted_date", "2024-01-01", "2024-01-31")
    assert scan.count() == 1
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(posted_date_month" in plan
    csv_dir = os.path.join(tmpdir_path, "csvs")
    os.makedirs(os.path.join(csv_dir, "sub"))
    with open(os.path.join(csv_dir, "small.csv"), "w") as f:
        f.write("a\n1\n")
    with open(os.path.join(csv_dir, "sub", "big.csv"), "w") as f:
        f.write('title,title,notes\n"Data\nEngineer",NA,"say ""hi"""\nx,,null\n')
    assert pick_input_file(spark, csv_dir).endswith("big.csv")
    rows = read_csv_source(spark, os.path.join(csv_dir, "sub", "big.csv"))
    assert rows.columns == ["title", "title.1", "notes"]
    got = [tuple(r) for r in rows.collect()]
    assert got == [("Data\nEngineer", None, 'say "hi"'), ("x", None, None)]
    with pytest.raises(FileNotFoundError):
        pick_input_file(spark, os.path.join(csv_dir, "sub", "none"))


def test_catalog_and_relation(spark, tmpdir_path):
    from hirelake.sources import catalog, sinks
    df = canon_frame(spark, [dict(job_title="a")])
    for v in ("raw_zz_one", "raw_zz_two", "master_jobs"):
        spark.catalog.dropTempView(v)
    df.createOrReplaceTempView("raw_zz_one")
    assert catalog.present_sources(spark, ["raw_zz_two", "raw_zz_one"]) == ["raw_zz_one"]
    rel, mode = catalog.jobs_relation(spark, table="raw_zz_one")
    assert mode == "raw_pick" and rel.count() == 1
    with pytest.raises(ValueError):
        catalog.jobs_relation(spark, table="Robert'); drop")
    df.createOrReplaceTempView("raw_zz_two")
    assert {"raw_zz_one", "raw_zz_two"} <= set(catalog.list_raw_tables(spark))
    sinks.create_master_view(spark, df, "master_jobs")
    assert catalog.jobs_relation(spark)[1] == "master_jobs"
    models = catalog.bronze_models(spark, ["raw_zz_one", "raw_zz_missing"])
    assert list(models) == ["brz_zz_one"]
    out = sinks.export_csv(df.select("source_id", "job_title"), os.path.join(tmpdir_path, "export"),
                           single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    assert open(os.path.join(out, files[0])).read().splitlines() == ["source_id,job_title", "s1,a"]


def test_try_canned(spark):
    df, err = canned.try_canned("nope", {})
    assert df is None and "nope" in err
    sd = spark.createDataFrame([("SQL", 3, 1), ("Go", 3, 2), ("AWS", 1, 1)],
                               "skill string, job_postings long, source_count long")
    df, err = canned.try_canned("top_skills", {"skill_demand": sd}, limit="2")
    assert err is None and [r.skill for r in df.collect()] == ["Go", "SQL"]
    df, err = canned.try_canned("source_row_counts", {"curated": spark.range(1)})
    assert df is None and err.startswith("source_row_counts")


def test_de_second_salary_header_overwrites(spark):
    from hirelake.operators.mapping import map_de_2023
    df = spark.createDataFrame([("T", "D", "90000", "USD", "120k", "Austin", "TX", "")],
                               "Job_details string, `Job_details.1` string, `Salary.2` string, `Salary.3` string, "
                               "`Salary raw` string, `Job_details.4` string, `Job_details.5` string, "
                               "`Job_details.6` string")
    r = map_de_2023(df, as_of="2024-01-01").first()
    assert r.salary_info == "120k USD" and r.location == "Austin, TX"


@pytest.mark.parametrize("value,expected", [(89000.5, "89000.5"), (144975.0, "144975.0"),
                                            (15000000.0, "15000000.0"), (12345678.5, "12345678.5"),
                                            (0.0001, "0.0001"), (0.00012345, "0.00012345"), (1e30, "1e+30"),
                                            (1.5e-7, "1.5e-07"), (float("nan"), "nan"), (-2.5e17, "-2.5e+17"),
                                            (None, None)])
def test_python_float_text(spark, value, expected):
    from hirelake.operators.mapping import python_float_text
    assert one(spark, python_float_text, value, "double") == expected


def test_hf_timestamp_dates_and_domain_before_merge(spark):
    from hirelake.operators.mapping import map_hf
    rows = [(dt.datetime(2024, 1, 5, 23, 30), "Cook", "Chef", ["sql"], None, "x"),
            (dt.datetime(2024, 1, 6, 1, 0), "Cook", "Chef", None, "we use python", "y"),
            (dt.datetime(2019, 1, 6), "Data engineer", "Data Engineer", None, None, "z")]
    df = spark.createDataFrame(rows, "job_posted_date timestamp_ntz, job_title string, job_title_short string, "
                                     "job_skills array<string>, job_type_skills string, company_name string")
    out = {r.company_name: r for r in map_hf(df, as_of="2024-02-01", extract_skills=True).collect()}
    # 'x' passes on its given skills text ("sql" has no domain keyword) -> dropped; 'y' has no
    # domain keyword either (the taxonomy hit 'Python' does not count for the domain test).
    assert set(out) == set()
    df2 = df.withColumn("job_title_short", F.lit("Data Analyst"))
    out = {r.company_name: r for r in map_hf(df2, as_of="2024-02-01", extract_skills=True).collect()}
    assert set(out) == {"x", "y"}
    assert out["x"].posted_date == dt.date(2024, 1, 5) and out["x"].skills == ["sql"]
    assert out["y"].skills == ["Python"]


def test_read_parquet_source_recursive(spark, tmpdir_path):
    from hirelake.sources.files import read_parquet_source
    spark.range(3).write.parquet(os.path.join(tmpdir_path, "hf", "a"))
    spark.range(2).write.parquet(os.path.join(tmpdir_path, "hf", "b", "c"))
    assert read_parquet_source(spark, os.path.join(tmpdir_path, "hf")).count() == 5


@pytest.mark.parametrize("reply,expected", [
    ('["Python", {"name": "SQL"}]', ["Python", '{"name":"SQL"}']), ('["Python", ["a"]]', ["Python", '["a"]']),
    ('[0, false, null, "", "SQL", 0.0, {}, [], true, 3]', ["SQL", "True", "3"]), ('["0", " Go "]', ["0", "Go"]),
    ('["a"] tail', []), ('["a"],["b"]', []), ('["a"]],[', []), ('{"a": 1}', []), ("['a']", []), ("", []), (None, []),
    ('```json\n["a"]\n```', ["a"]),
])
def test_reply_items(spark, reply, expected):
    from hirelake.functions.skills import parse_response_skills
    assert one(spark, parse_response_skills, reply) == expected
