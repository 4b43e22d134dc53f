"""Versions, resumable ingest, drifted files, rejects and counters, stored views, SQL functions, the ledger, taxonomy tables."""
import datetime as dt
import os
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, canon_frame
from hirelake.functions import fingerprint as FP
from hirelake.functions import skills as SK
from hirelake.functions.sql import register_sql_functions
from hirelake.functions.text import blank_to_null, trim_ws
from hirelake.operators import checks, taxonomy
from hirelake.operators.enrich import enrich_once, read_ledger
from hirelake.plans import pipeline as P
from hirelake.sources import sinks
from hirelake.sources.versions import Lake, VersionedTable, read_drifted, wider


def broken(df):
    """The rows, until the job reaches them."""
    return df.withColumn(df.columns[0], F.when(F.rand() < 2, F.raise_error(F.lit("disk on fire"))).otherwise(F.col(df.columns[0])))


def test_a_failed_write_leaves_the_old_version(spark, tmpdir_path):
    t = VersionedTable(spark, os.path.join(tmpdir_path, "t"))
    assert t.current() is None
    with pytest.raises(ValueError):
        t.read()
    first = t.replace(spark.range(3))
    reader = t.read()
    with pytest.raises(Exception, match="disk on fire"):
        t.replace(broken(spark.range(9).withColumn("id", F.col("id").cast("string"))))
    assert t.current() == first and t.read().count() == 3
    t.replace(spark.range(5).select((F.col("id") * 2).alias("id"), F.lit("x").alias("more")))
    assert t.read().count() == 5 and "more" in t.read().columns
    assert reader.count() == 3  # a reader that began earlier keeps its rows
    with pytest.raises(ValueError):
        t.publish("v-unknown")
    assert len(t.vacuum()) >= 1 and t.read().count() == 5 and t.vacuum() == []


def test_load_raw_table_keeps_old_rows_when_the_load_fails(spark, tmpdir_path, monkeypatch):
    df = canon_frame(spark, [dict(job_title="a"), dict(job_title="b")])
    sinks.write_lake(df, tmpdir_path, "ds")
    name, root = f"raw_t_{uuid.uuid4().hex[:8]}", os.path.join(tmpdir_path, "tables")
    for where in (root, None):
        assert sinks.load_raw_table(spark, tmpdir_path, "ds", name, where)
        with monkeypatch.context() as m:
            m.setattr(sinks, "read_drifted", lambda s, p: broken(read_drifted(s, p)))
            with pytest.raises(Exception, match="disk on fire"):
                sinks.load_raw_table(spark, tmpdir_path, "ds", name, where)
        assert spark.table(name).count() == 2
        if where:
            spark.catalog.dropTempView(name)
    assert spark.newSession().table(name).count() == 2
    sinks.write_lake(df.limit(1), tmpdir_path, "ds")
    assert sinks.load_raw_table(spark, tmpdir_path, "ds", name) and spark.table(name).count() == 1


def test_a_failed_run_leaves_the_lake_and_resumes(spark, tmpdir_path):
    calls, state = [], {"fail": False}

    def spec(name):
        def build(s):
            calls.append(name)
            df = canon_frame(s, [dict(source_id=name, job_title=f"t{calls.count(name)}")])
            return broken(df) if state["fail"] and name == "c" else df
        return P.SourceSpec(name, f"ds_{name}", f"raw_{name}", build)

    specs, lake = [spec(n) for n in "abcd"], Lake(spark, tmpdir_path)
    P.ingest(spark, specs, tmpdir_path)
    before = lake.published()
    calls.clear()
    state["fail"] = True
    with pytest.raises(Exception, match="disk on fire"):
        P.ingest(spark, specs, tmpdir_path, run_id="r2")
    assert calls == ["a", "b", "c"] and lake.published() == before
    assert spark.read.parquet(lake.path("ds_a")).count() == 1
    state["fail"] = False
    assert P.ingest(spark, specs, tmpdir_path, run_id="r2") == list("abcd")
    assert calls == ["a", "b", "c", "c", "d"]
    assert all(lake.published()[k] != v for k, v in before.items())


def test_drifted_files(spark, tmpdir_path):
    assert wider(T.IntegerType(), T.LongType()) == T.LongType() and wider(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType() and wider(T.BooleanType(), T.IntegerType()) == T.StringType()
    p = os.path.join(tmpdir_path, "d")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(p + "/1")
    spark.sql("SELECT CAST(2 AS BIGINT) AS a, 0.5D AS c").write.parquet(p + "/2")
    spark.sql("SELECT 3 AS a, array(1, 2) AS b").write.parquet(p + "/sub/3")
    df = read_drifted(spark, p)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert sorted([(r.a, r.b, r.c) for r in df.collect()]) == [(1, "x", None), (2, None, 0.5), (3, "[1,2]", None)]
    spark.sql("SELECT 'four' AS a").write.parquet(p + "/4")
    assert sorted(r.a for r in read_drifted(spark, p).collect()) == ["1", "2", "3", "four"]


def test_rejects_have_reasons_and_counters_agree(spark, tmpdir_path):
    df = spark.createDataFrame([("s", "S", "2024-01-05", "t"), (None, "S", "2024-01-05", "t"), ("s", None, "nope", "t"), ("s", "S", "nope", "t"), ("s", "S", None, "old")],
                               "source_id string, source_name string, posted_date string, job_title string")
    rows = checks.judged(df, {"old": F.col("job_title") == "old"}, {"posted_date": F.col("posted_date").isNull()})
    got = checks.write_checked(rows, os.path.join(tmpdir_path, "ok"), os.path.join(tmpdir_path, "bad"), ["old", "missing_source_id", "missing_source_name", "bad_posted_date"],
                               ["posted_date"])
    assert got.counters == {"rows_in": 5, "rows_kept": 1, "rows_rejected": 4, "rejected_old": 1, "rejected_missing_source_id": 1,
                            "rejected_missing_source_name": 1, "rejected_bad_posted_date": 2, "defaulted_posted_date": 0}
    kept = spark.read.parquet(got.path).collect()
    assert len(kept) == 1 and kept[0].posted_date == dt.date(2024, 1, 5)
    bad = spark.read.parquet(got.rejects).collect()
    assert sorted(r.reject_reasons for r in bad) == [["bad_posted_date"], ["missing_source_id"], ["missing_source_name", "bad_posted_date"], ["old"]]
    clean = checks.write_checked(rows.where("job_title = 't' AND source_id IS NOT NULL AND posted_date = '2024-01-05'"), os.path.join(tmpdir_path, "o2"),
                                 os.path.join(tmpdir_path, "b2"), [])
    assert clean.rejects is None and clean.counters["rows_kept"] == 1


def test_judged_mappers_keep_the_same_rows(spark):
    from hirelake.operators.mapping import map_hf, map_linkedin
    from hirelake.plans import adapters as A
    for rows, fn, kw in ((A.linkedin_like(spark, SF_SMALL), map_linkedin, {}), (A.hf_like(spark, SF_SMALL), map_hf, {"extract_skills": True})):
        kw = dict(kw, as_of="2024-02-01", ingested_at=F.lit("2024-02-01 06:00:00").cast("timestamp_ntz"))
        plain, seen = fn(rows, **kw), fn(rows, judge=True, **kw)
        assert seen.count() == rows.count()
        kept = checks.accepted(seen)
        assert kept.schema.simpleString() == plain.schema.simpleString()
        assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))


def test_stored_master_view_is_seen_by_another_session(spark, tmpdir_path):
    from hirelake.operators.master import master_clean
    run = uuid.uuid4().hex[:8]
    frames = {"a": canon_frame(spark, [dict(job_title="x", skills='["a"]'), dict(job_title=" \u00a0", skills="[]")]),
              "b": spark.createDataFrame([("s2", "S2", "y", ["q"], 5)], "source_id string, source_name string, job_title string, skills array<string>, extra int")}
    names = []
    for k, df in frames.items():
        df.write.parquet(os.path.join(tmpdir_path, k))
        names.append(f"raw_{k}_{run}")
        spark.sql(f"CREATE VIEW {names[-1]} AS SELECT * FROM parquet.`{os.path.join(tmpdir_path, k)}`")
    sinks.create_persistent_master_view(spark, names, f"m_{run}")
    got = spark.newSession().table(f"m_{run}")
    stored = {k: spark.read.parquet(os.path.join(tmpdir_path, k)) for k in frames}
    stored["b"] = stored["b"].withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))
    cols = [c for c in got.columns if c != "ingested_at"]
    want = master_clean(list(stored.values())).select(*cols)
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        sinks.create_persistent_master_view(spark, [], "m_none")


def test_sql_functions_equal_the_column_functions(spark):
    texts = [None, "", " ", "\u00a0 x\t", '["a", " b ", null, "", 1, true]', '["a"', '{"a": 1}', "['a']", '["it''s \\"q\\""]', "[[1]]", "[]", "HTTP://X.y/Z ", "\\d'\u2003"]
    df = spark.createDataFrame([(t, dt.date(2024, 1, 2) if i % 2 else None) for i, t in enumerate(texts)], "x string, d date")
    want = df.select(trim_ws("x").alias("t"), blank_to_null("x").alias("b"), F.lower(blank_to_null("x")).alias("u"), SK.normalize_skills("x").alias("n"),
                     FP.dedup_key("x", "x", "x", "x", "d", "x").alias("k"), FP.fingerprint(FP.dedup_key("x", "x", "x", "x", "d", "x")).alias("f")).collect()
    db = f"fn_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    register_sql_functions(spark, "job_")
    register_sql_functions(spark, "job_", db)
    for session, p in ((spark, "job_"), (spark.newSession(), f"{db}.job_")):
        df2 = session.createDataFrame([tuple(r) for r in df.collect()], df.schema)
        got = session.sql(f"SELECT {p}trim_ws(x) AS t, {p}blank_to_null(x) AS b, {p}url_key(x) AS u, {p}normalize_skills(x) AS n, "
                          f"{p}dedup_key(x, x, x, x, d, x) AS k, {p}fingerprint({p}dedup_key(x, x, x, x, d, x)) AS f FROM {{df}}", df=df2)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want]
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    one = spark.sql("SELECT job_is_complete(:t, :d, :n) AS c, job_is_complete(:t, NULL, 0) AS e", args={"t": " x", "d": "", "n": 2}).first()
    assert (one.c, one.e) == (True, False)


def test_one_call_a_distinct_text_over_two_runs(spark, tmpdir_path):
    log = os.path.join(tmpdir_path, "calls")
    os.makedirs(log)

    def fn(rows, where=log):
        import uuid as u
        with open(os.path.join(where, u.uuid4().hex), "w") as f:
            f.write("\n".join(repr(r) for r in rows))
        if any(r[0] == "bad" for r in rows):
            raise RuntimeError("no reply")
        return [[r[0], len(r[1] or "")] for r in rows]

    def calls():
        return [line for name in os.listdir(log) for line in open(os.path.join(log, name)).read().split("\n") if line]

    data = [("a", "x"), ("a", "x"), ("b", None), ("b", "null"), ("a", "x"), ("c", "")] * 20
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, job_title string, job_description string").repartition(4)
    ledger = os.path.join(tmpdir_path, "ledger")
    first = enrich_once(df.where("id < 6"), fn, ledger, batch_size=1).collect()
    assert sorted(calls()) == sorted(repr(r) for r in [("a", "x"), ("b", None), ("b", "null"), ("c", "")])
    out = enrich_once(df, fn, ledger, batch_size=3, rounds=3)
    assert out.columns == ["id", "job_title", "job_description", "skills_enriched", "enrich_failed"]
    assert len(calls()) == 4 and out.count() == len(data) and len(first) == 6
    assert all(r.skills_enriched == [r.job_title, str(len(r.job_description))] if r.job_description else r.skills_enriched == [r.job_title] for r in out.collect())
    more = df.limit(0).unionByName(spark.createDataFrame([(1, "bad", "x")], df.schema))
    for n in (5, 6):  # a failed text is marked, not recorded, and sent again by the next run
        r = enrich_once(more, fn, ledger, batch_size=1).first()
        assert r.enrich_failed and r.skills_enriched == [] and len(calls()) == n
    assert read_ledger(spark, ledger).count() == 4


def test_taxonomy_table_equals_the_expression(spark):
    r = random.Random(4)
    terms = [("Python", "Python"), ("python", "Py"), ("c++", "C++"), ("c", "C"), (".net", ".NET"), ("asp.net", "ASP"), ("google cloud", "GCP"), ("google cloud storage", "GCS"),
             ("ci/cd", "CI"), ("++", "PP"), ("naïve  bayes", "NB"), ("r", "R"), ("node.js", "Node"), ("#", "Hash"), ("a-b c", "ABC"), ("été", "E"), ("_x", "X"), ("--flag", "F")]
    bits = ["Python", "c", "c++", "C++x", ".net", "asp.net", "google", "cloud", "storage", "ci/cd", "++", "naïve", " ", "  ", ",", "bayes", "R", "node.js", "#", "a-b", "été", "_x", "x_", "--flag", "9"]
    rows = [(i, "".join(r.choice(bits) + r.choice(["", " ", " ", "-"]) for _ in range(r.randrange(1, 9))) if r.random() < 0.9 else None,
             "".join(r.choice(bits) + r.choice([" ", ""]) for _ in range(r.randrange(0, 12)))) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, job_title string, job_description string")
    table = taxonomy.taxonomy_table(spark, terms + [("python", "Python")])
    got = {x.id: x.skills_taxonomy for x in taxonomy.with_taxonomy_table(df, "id", table).collect()}
    want = {x.id: x.s for x in df.select("id", SK.extract_taxonomy("job_title", "job_description", terms).alias("s")).collect()}
    assert got == want and sum(map(len, want.values())) > 400
    nothing = taxonomy.with_taxonomy_table(df, "id", table.where("false")).collect()
    assert len(nothing) == 400 and all(x.skills_taxonomy == [] for x in nothing)


def test_taxonomy_plan_does_not_grow_with_the_terms(spark):
    df = spark.createDataFrame([(1, "data engineer", "knows term 7 and term 49999")], "id int, job_title string, job_description string")
    plans = []
    for n in (63, 50_000):
        big = spark.range(n).select(F.concat(F.lit("term "), F.col("id").cast("string")).alias("pattern"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("canonical"))
        out = taxonomy.with_taxonomy_table(df, "id", big)
        assert out.first().skills_taxonomy == (["T7"] if n == 63 else ["T49999", "T7"])
        plans.append(len(out._jdf.queryExecution().optimizedPlan().toString().split("\n")))
    assert plans[0] == plans[1]


def late_plans(spark, tmpdir_path, threshold):
    from hirelake.operators import silver as S
    rows = [dict(source_id=f"s{i % 3}", job_title=f"t{i % 40}", job_description="text " * (i % 7), posted_date=dt.date(2024, 1, 1 + i % 5) if i % 4 else None,
                 job_url=f"u{i % 11}" if i % 2 else None, skills='["a", "b"]', ingested_at=dt.datetime(2024, 1, 1 + i % 3)) for i in range(600)]
    path = os.path.join(tmpdir_path, "rows")
    canon_frame(spark, rows).repartition(5).write.parquet(path)
    raw = spark.read.parquet(path)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        winners, whole = S.deduplicate_late(S.standardize(S.union_all([raw], locate=True), keep=S.LOCATOR))
        want = S.deduplicate(S.standardize(S.union_all([raw])))
        cols = ["source_id", "job_title", "job_description", "posted_date", "job_url", "skills_normalized", "ingested_at"]
        assert sorted(map(str, whole.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
        assert winners.count() == want.count() < 600 and not {"job_title", "job_description"} & set(winners.columns)
        return whole._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


@pytest.mark.parametrize("threshold,join", [("10m", "BroadcastHashJoin"), ("1", "ShuffledHashJoin")])
def test_late_rows_are_joined_without_sorting_texts(spark, tmpdir_path, threshold, join):
    plan = late_plans(spark, tmpdir_path, threshold)
    assert join in plan and "Sort " not in plan and "Window" not in plan and "SortMergeJoin" not in plan
    assert (threshold == "10m") == ("Exchange hashpartitioning" not in plan)


def test_rows_that_are_no_bare_scan_are_stored_before_they_are_located(spark):
    from hirelake.operators import silver as S
    doubled = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    got = S.located(doubled)
    assert got.select(*S.LOCATOR).distinct().count() == doubled.count()


def test_health_is_read_from_footers(spark, tmpdir_path):
    from hirelake.operators.quality import stored_health
    path = os.path.join(tmpdir_path, "t")
    canon_frame(spark, [dict(job_title=str(i), ingested_at=dt.datetime(2024, 1, 1 + i)) for i in range(9)]).repartition(3).write.parquet(path)
    h = stored_health(spark, {"t": path, "gone": path + "-none"})
    assert sorted(map(tuple, h.collect())) == [("gone", None, None, "not_found"), ("t", 9, dt.datetime(2024, 1, 9), None)]
    plan = stored_health(spark, {"t": path})._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(ingested_at)]" in plan


def test_late_rows_are_made_standard_behind_the_join(spark):
    """Losers are not parsed a second time; what ranks rows is small enough to be compiled by the JVM."""
    from hirelake.operators import silver as S
    rows = [("s", "S", " A ", None, "c\t", "l", None, f"HTTPS://u/{i % 4} ", '["x", " "]', None, f"2024-01-0{1 + i % 5}", i) for i in range(40)]
    raw = spark.createDataFrame(rows, "source_id string, source_name string, job_title string, job_description string, company_name string, location string,"
                                "posted_date string, job_url string, skills string, salary_info string, ingested_at string, id int")
    raw = raw.withColumns({"posted_date": F.to_date(F.lit("2024-01-01")), "ingested_at": F.col("ingested_at").cast("timestamp_ntz")})
    stored = S.located(raw)
    make = lambda d: S.standardize(d, keep=("id", *S.LOCATOR))
    winners, whole = S.deduplicate_late(stored, tie_breakers=("id",), carry=(), make=make)
    plain = S.deduplicate(S.standardize(raw, keep=("id",)), tie_breakers=("id",)).select("id", "skills_normalized", "job_title", "job_url")
    assert sorted(whole.select(plain.columns).collect()) == sorted(plain.collect()) and plain.count() == 4
    assert "skills_normalized" not in winners.columns and winners.count() == 4
    assert {(r._has_title, r._has_description) for r in winners.collect()} == {(True, False)}
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.index("Join LeftAnti")  # printed from the top
    keys = S.ranking_keys(make(stored), tie_breakers=("id",), carry=(), standard=True)
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
    code = debug.codegenString(keys._jdf.queryExecution().executedPlan())
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000
