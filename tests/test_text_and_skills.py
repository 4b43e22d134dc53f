import pytest
from pyspark.sql import functions as F

from conftest import one
from hirelake.functions import skills as SK
from hirelake.functions.text import blank_to_null, trim_ws


@pytest.mark.parametrize("value,expected", [
    ("\t a \n", "a"), ("   ", None), ("\xa0", None), ("", None), (None, None), (" x　", "x"),
])
def test_blank_to_null(spark, value, expected):
    assert one(spark, blank_to_null, value) == expected


def test_trim_keeps_inner_space(spark):
    assert one(spark, trim_ws, "  a  b \r\n") == "a  b"


@pytest.mark.parametrize("value,expected", [
    ('["a"," b ","",null,1,true]', ["a", "b", "1", "true"]),
    ("[]", []),
    ('{"a":1}', []),
    ('"x"', []),
    ("abc", []),
    ("['a']", []),
    ('["a"] zz', []),
    ('["a","a"]', ["a", "a"]),
    (None, []),
    ('   ["a"]', ["a"]),
    ('[["a"]]', []),
    ('[{"a":1}, "b"]', []),
    ('[1,]', []),
    ('["a\\"b"]', ['a"b']),
])
def test_normalize_skills_text(spark, value, expected):
    assert one(spark, lambda c: SK.normalize_skills(c), value) == expected


def test_normalize_skills_array(spark):
    df = spark.createDataFrame([([" a ", "", None, "b"],), (None,)], "v array<string>")
    out = [r.r for r in df.select(SK.normalize_skills("v", df.schema["v"].dataType).alias("r")).collect()]
    assert out == [["a", "b"], []]


@pytest.mark.parametrize("title,desc,expected", [
    (None, "we use google cloud storage daily", ["Cloud Storage", "GCP"]),
    ("PySpark developer", None, ["Spark"]),
    (None, "python3 and mysql", ["MySQL", "Python"]),
    (None, "éspark only", []),
    (None, "events via pub/sub", ["Pub/Sub"]),
    ("dbt, Airflow and AWS", None, ["AWS", "Airflow", "dbt"]),
    ("   ", None, []),
    (None, None, []),
])
def test_taxonomy(spark, title, desc, expected):
    df = spark.createDataFrame([(title, desc)], "t string, d string")
    assert df.select(SK.extract_taxonomy("t", "d").alias("r")).first().r == expected


def test_taxonomy_dataframe_form(spark):
    df = spark.createDataFrame([("SQL and Kafka", None)], "job_title string, job_description string")
    assert SK.with_taxonomy(df).first().skills_taxonomy == ["Kafka", "SQL"]


@pytest.mark.parametrize("value,b,c", [
    ("a;b|c", ["a", "b", "c"], ["a", "b", "c"]),
    ("[x, y]", ["x, y"], ["[x", "y]"]),
    (";;", [], []),
    ("x", ["x"], ["x"]),
    ("  ", None, None),
    ("a; ;b", ["a", "b"], ["a", "b"]),
])
def test_skill_list_rules(spark, value, b, c):
    assert one(spark, SK.skill_list_bracketed, value) == b
    assert one(spark, SK.skill_list_separated, value) == c


@pytest.mark.parametrize("a,b,expected", [
    ([], [], 1.0), (["x"], [], 0.0), ([" A"], ["a "], 1.0), (["a"], ["b"], 0.0),
    (["a", "b"], ["b", "c"], 1 / 3), (["a", ""], ["a"], 1.0),
])
def test_jaccard(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    got = df.select(SK.jaccard("a", "b").alias("j"), SK.jaccard("b", "a").alias("k")).first()
    assert got.j == pytest.approx(expected) and got.k == pytest.approx(expected)


@pytest.mark.parametrize("given,extracted,expected", [
    (["a", "b"], ["b", "c"], ["a", "b", "c"]), ([], ["c"], ["c"]), (None, [], None), (["a"], [], ["a"]),
    (["a", "a"], [], ["a", "a"]), (["a", "a"], ["b"], ["a", "b"]),
])
def test_merge_skills(spark, given, extracted, expected):
    df = spark.createDataFrame([(given, extracted)], "g array<string>, e array<string>")
    assert df.select(SK.merge_skills("g", "e").alias("m")).first().m == expected


@pytest.mark.parametrize("reply,expected", [
    ('["Python","SQL"]', ["Python", "SQL"]),
    ('```json\n["Python","SQL"]\n```', ["Python", "SQL"]),
    ('```\n["Go"]', ["Go"]),
    ("not JSON", []),
    ('{"a":1}', []),
    ("", []),
    (None, []),
])
def test_parse_response(spark, reply, expected):
    assert one(spark, SK.parse_response_skills, reply) == expected


def test_blob_text(spark):
    df = spark.createDataFrame([([" a ", None, "", "b"],), ([],)], "v array<string>")
    out = [r.r for r in df.select(SK.skills_blob_text("v", df.schema["v"].dataType).alias("r")).collect()]
    assert out == ["a\nb", None]
