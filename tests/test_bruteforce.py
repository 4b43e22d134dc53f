"""Spark expressions vs plain-Python brute force on small fixtures."""
import json
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hirelake.functions import skills as SK


def py_normalize(raw):
    if raw is None:
        return []
    s = raw.strip()
    if not s.startswith("["):
        return []
    try:
        val = json.loads(s)
    except ValueError:
        return []
    if not isinstance(val, list) or any(isinstance(x, (list, dict)) for x in val):
        return []
    out = []
    for x in val:
        if x is None:
            continue
        t = ("true" if x else "false") if isinstance(x, bool) else str(x)
        t = t.strip()
        if t:
            out.append(t)
    return out


TAXONOMY_CASES = {
    "google cloud storage and pub/sub": "GCP", "PySpark, python3; MySQL": "Spark", "k8s/kubernetes": "Kubernetes",
    "AWS Airflow": "AWS", "x.sql y": "SQL", "sql_server": None, "power bi_": None, "éspark": None, "": None,
}


def test_taxonomy_by_hand(spark):
    df = spark.createDataFrame(list(TAXONOMY_CASES.items()), "text string, one string")
    for r in df.select("text", "one", SK.extract_taxonomy(F.lit(None), "text").alias("tax")).collect():
        assert (r.one in r.tax) if r.one else r.tax == [], (r.text, r.tax)
        assert r.tax == sorted(set(r.tax))


def test_normalize_matches_python(spark):
    from hirelake.plans import adapters as A
    raw = [r.skills for r in A.raw_tables(spark, SF_SMALL)["raw_orders"].select("skills").collect()]
    rnd = random.Random(7)
    atoms = ['"a"', '" b "', '""', "null", "1", "true", "false", '{"k":1}', "[1]", '"x\\"y"', "-0.5", '"é"']
    for _ in range(200):
        k = rnd.randint(0, 4)
        body = ", ".join(rnd.choice(atoms) for _ in range(k))
        raw.append(rnd.choice(["[", " [", "{"]) + body + rnd.choice(["]", "] ", "]x", ""]))
    df = spark.createDataFrame([(i, s) for i, s in enumerate(raw)], "i long, s string")
    got = df.select("i", "s", SK.normalize_skills("s").alias("n")).collect()
    for r in got:
        assert r.n == py_normalize(r.s), r.s


JACCARD_CASES = [([], [], 1.0), (["a"], [], 0.0), (["Python", " python"], ["PYTHON"], 1.0), (["SQL", "Go"], ["sql ", "AWS"], 1 / 3),
                 (["", "  "], [], 1.0), (["x", "y", "z"], ["z"], 1 / 3), (["aws", "go"], ["Go", "AWS", "aws"], 1.0)]


def test_jaccard_by_hand(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(JACCARD_CASES)], "i long, a array<string>, b array<string>")
    for r in df.select("i", SK.jaccard("a", "b").alias("j"), SK.jaccard("b", "a").alias("k")).collect():
        assert r.j == r.k and abs(r.j - JACCARD_CASES[r.i][2]) < 1e-12
