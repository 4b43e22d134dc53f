"""Odd inputs for every operator and stage: clashing columns, ids that are no integers, empty tables."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm import alignment, cuckoo, language, mixing, packing, phrases, simhash, toxicity, url_graph

#: Columns that operators add or use inside, as a caller's own.
CLASH = ("__llm_digest", "__llm_severity", "__llm_rank", "__llm_rate", "__llm_raw", "__llm_posterior", "score", "lang_pred", "tokens", "rate",
         "posterior", "expected_severity", "digest", "part", "id", "rule_verdict")
TEXTS = [None, "", "Plain words of a short text.", "Plain words of a short text.", "plain words of a short text indeed", "der Hund und die Katze",
         "le chat et le chien. " * 400, "  ", "été 日本 🙂", "x" * 5000]


def docs_of(spark, kind, extra=True, n=40):
    rows = [(i, TEXTS[i % len(TEXTS)], ("en", "de", "fr", None)[i % 4]) for i in range(n)] + [(None, "no id", "en"), (None, "no id", "en"), (3, "again", "de")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("doc_id", F.col("doc_id").cast(kind))
    return df.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASH]) if extra else df


def labels_of(spark, kind):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)], "doc_id bigint, quality int, toxic int").withColumn("doc_id", F.col("doc_id").cast(kind))


STAGES = {
    "drop_toxic": lambda d, x: toxicity.drop_toxic(d, x),
    "exact": lambda d, x: cuckoo.drop_exact_duplicates(d),
    "near": lambda d, x: simhash.drop_near_duplicates(d),
    "mix": lambda d, x: mixing.mix(d, mixing.quality_domains(x), corpus_pipeline.MIX_TARGETS),
}
OPERATORS = {
    "mixture": lambda d, x: mixing.mixture(d, mixing.quality_domains(x))[0],
    "exact_duplicates": lambda d, x: cuckoo.exact_duplicates(d),
    "identify": lambda d, x: language.identify(d, language.train(d, F.lit(True))),
    "pack": lambda d, x: packing.pack(d),
    "severity": lambda d, x: toxicity.scores(d, toxicity.train(d, x)),
    "near_duplicates": lambda d, x: simhash.near_duplicates(d),
    "phrases": lambda d, x: phrases.collocations(d, 2),
    "align": lambda d, x: alignment.align(d),
}


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("name", list(STAGES))
def test_stages_keep_the_callers_columns(spark, name, kind):
    docs, labels = docs_of(spark, kind), labels_of(spark, kind)
    out = STAGES[name](docs, labels)
    assert out.columns == docs.columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    rows = out.collect()
    assert rows and all(r[c] == f"mine {c}" for r in rows for c in CLASH)
    assert {(r.doc_id, r.text) for r in rows} <= {(r.doc_id, r.text) for r in docs.collect()}
    assert STAGES[name](docs.where("false"), labels).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators_take_clashing_columns_and_any_ids(spark, name, kind):
    docs, labels = docs_of(spark, kind), labels_of(spark, kind)
    out = OPERATORS[name](docs, labels)
    assert len(set(c.lower() for c in out.columns)) == len(out.columns)
    rows = out.collect()
    if name not in ("phrases", "pack"):
        assert len(rows) == docs.count()
    plain = OPERATORS[name](docs.select("doc_id", "text", "lang"), labels)
    same = [c for c in plain.columns if c in out.columns]
    assert set(plain.columns) == set(same)
    assert sorted(map(str, out.select(same).collect())) == sorted(map(str, plain.collect()))
    assert OPERATORS[name](docs.where("false"), labels).collect() == []


def test_urls_keep_the_callers_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "<a href='http://b.net/'>b</a>", "mine"), (2, None, None, "mine"), (3, "http://b.net/", "", "mine")],
                                  "page_id int, url string, html string, rule_verdict string")
    rows = url_graph.filter_urls(pages).collect()
    assert len(rows) == 3 and all(r.rule_verdict == "mine" for r in rows)
    assert [r.verdict for r in sorted(rows, key=lambda r: r.page_id)] == ["allow", "allow", "allow"]


def test_index_of_text_ids(spark):
    rows = spark.createDataFrame([(b"a" * 32, "x", 1), (b"a" * 32, "y", 2), (b"b" * 32, None, 1)], "digest binary, best string, copies bigint")
    index = cuckoo.apply(None, rows, n_shards=2)
    index = cuckoo.apply(index, None, rows.where("best is null").select("digest"), n_shards=2)
    assert [(r.keep_id, r.group_size) for r in cuckoo.live(index).collect()] == [("y", 3)]


