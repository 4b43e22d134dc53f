"""Physical-plan assertions: the strategies we rely on are the ones Spark picks."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hirelake.plans.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_groups_before_the_shuffle(spark):
    p = plan(QUERIES["jobs_deduplicated"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_topk_is_per_partition(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_skills"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan(QUERIES["sample_nonblank"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan(QUERIES["browse_jobs"](spark, SF_SMALL))


def test_aggregates_are_partial(spark):
    p = plan(QUERIES["skill_demand"](spark, SF_SMALL))
    assert "partial_count" in p


def test_no_python_in_plans_except_enrichment(spark):
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        if name == "enrich_batches":
            assert "MapInPandas" in p or "PythonMapInArrow" in p or "MapInArrow" in p
        else:
            assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p, name


def test_scans_are_pruned(spark):
    p = plan(QUERIES["posting_volume"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," in p
    assert "o_totalprice" in p  # salary text is part of the posting row


def test_domain_text_is_built_once_in_a_filter(spark):
    """Also where its columns are expressions below the filter."""
    from hirelake.operators import filters as FL, silver as S
    from hirelake.schema import JOBS_SCHEMA
    rows = S.standardize(spark.createDataFrame([], JOBS_SCHEMA).withColumn("job_description", F.reverse("job_description")))
    text = str(rows.where(FL.is_data_domain("job_title", "job_description", "skills_normalized")).select("source_id")._jdf.queryExecution().optimizedPlan())
    assert text.count("concat_ws(") == 1 and text.count("from_json(") + text.count("from_json,") <= 1


def test_words_that_begin_alike_share_a_guard(spark):
    from hirelake.operators.filters import any_substring
    words = ["data a", "data b", "big data", "etl", "data", "ai "]
    texts = ["data a", "xdata bx", "data c", "big  data", "an etl", "dat a", "ai", "ai x", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", any_substring(F.col("t"), words).alias("hit")).collect()
    assert [r.hit for r in rows] == [any(w in r.t for w in words) for r in rows]


def test_reply_is_parsed_twice_at_most(spark):
    """Once inside a list, once inside an object."""
    from hirelake.functions.skills import parse_response_skills
    df = spark.createDataFrame([("[1]",)], "reply string").select(parse_response_skills("reply").alias("s"))
    assert df._jdf.queryExecution().analyzed().toString().count("try_parse_json(") == 2


def test_trim_of_visible_ends(spark):
    from hirelake.functions.text import trim_ws
    texts = [None, "", " ", "a", " a", "a ", "\u00a0a\u2003", "\u00e9", "a\u3000", "~!", "!~ ", "\x7f", "\t\n", "a b", "\u2028x y\x85"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", trim_ws("t").alias("s")).collect()
    assert [r.s for r in rows] == [None if r.t is None else r.t.strip() for r in rows]
