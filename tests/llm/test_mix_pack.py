"""Toxicity, mixing, packing, URL rules and the pipeline."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm import mixing, packing, toxicity, url_graph

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOC)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    vocab = [f"plain{i}" for i in range(60)]
    texts, labels = [], []
    for i in range(240):
        words = list(rng.choice(vocab, 30))
        toxic = i % 6 == 0
        if toxic:
            words[3:3] = ["vile"] * (1 + i % 5)
        texts.append(" ".join(words))
        labels.append((i, int(i % 4 != 1), int(toxic)))
    texts += [None, "", "VILE, vile!", "plain1 plain2"]
    return docs_of(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    assert (np.diff(model["thresholds"]) > 0).all()
    got = {r.doc_id: r.expected_severity for r in toxicity.scores(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 6 == 0) for i in range(240))
    assert got[4 * 6] > got[0] - 1e-9  # more marking words, no lower severity
    assert got[240] < 0.5 and got[241] < 0.5 and got[242] >= 0.5 and got[243] < 0.5
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 244 - 40 - 1


def test_toxicity_without_labels(labelled):
    docs, labels = labelled
    assert toxicity.drop_toxic(docs, labels.where("false")).count() == 244
    assert toxicity.drop_toxic(docs, labels.where("toxic = 0")).count() == 244
    assert toxicity.drop_toxic(docs.where("false"), labels).count() == 0


def test_cumulative_link_gradient_finds_order():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, 500)
    grade = np.where(x == 0, 0, np.where(x < 3, 1, 2))
    rows = toxicity.Rows([[0]] * 500, [[float(v)] for v in x], 1)
    w, theta = toxicity.fit_cumulative_link(rows, grade, 3, steps=1500)
    s = rows.dot(w)
    assert (((s[:, None] > theta).sum(axis=1)) == grade).mean() > 0.98


def test_projected_gradient_matches_dense_solution(spark):
    rng = np.random.default_rng(4)
    post = rng.dirichlet([0.4, 0.3, 0.3], 80)
    tokens = rng.integers(1, 200, 80)
    df = spark.createDataFrame([(int(n), p.tolist()) for n, p in zip(tokens, post)], "tokens bigint, posterior array<double>")
    target = np.array([0.6, 0.3, 0.1])
    pulls, step, reached = mixing.fit_rates(df, target, steps=400, tol=1e-9, low=0.0, high=8.0)
    assert reached == pytest.approx(target, abs=2e-3)
    # the same problem, solved densely
    n, have = tokens.sum(), tokens @ post
    w = 1 / (have / n)
    r = np.ones(80)
    for _ in range(4000):
        r = np.clip(r - step * (post @ (w * ((tokens * r) @ post / n - target)) + 1e-3 * (r - 1)), 0, 8)
    got = mixing.replay(post, pulls, step, 1e-3, 0.0, 8.0)
    assert got == pytest.approx(r, abs=0.05)
    assert (got >= 0).all()


@pytest.mark.parametrize("low, high", [(0.0, 1e9), (1.0, 8.0)])
def test_default_fit_leaves_no_projected_gradient(spark, low, high):
    rng = np.random.default_rng(2)
    post, tokens = rng.dirichlet([3.0, 4.8, 2.1], 300), rng.integers(1, 200, 300)  # soft: totals creep
    df = spark.createDataFrame([(int(n), p.tolist()) for n, p in zip(tokens, post)], "tokens bigint, posterior array<double>")
    target = np.array([0.95, 0.04, 0.01])
    pulls, step, reached = mixing.fit_rates(df, target, low=low, high=high)
    r = mixing.replay(post, pulls, step, 1e-3, low, high)
    n = tokens.sum()
    assert reached == pytest.approx((tokens * r) @ post / n, abs=1e-9)
    gradient = post @ ((reached - target) * n / (tokens @ post)) + 1e-3 * (r - 1)
    assert np.abs(r - np.clip(r - gradient, low, high)).max() < 1e-6


def test_mix_keeps_every_document_and_raises_wanted_domains(labelled):
    docs, labels = labelled
    rated, model, reached = mixing.mixture(docs, mixing.quality_domains(labels))
    assert model["names"] == ["clean", "low", "toxic"]
    rows = rated.collect()
    assert len(rows) == 244 and all(abs(sum(r.posterior) - 1) < 1e-9 and r.rate >= 0 for r in rows)
    out = mixing.mix(docs, mixing.quality_domains(labels), {"toxic": 0.5, "clean": 0.5})
    assert out.columns == docs.columns
    times = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(times) == set(range(244)) and max(times.values()) <= 4
    assert np.mean([times[i] for i in range(0, 240, 6)]) > np.mean([times[i] for i in range(240) if i % 6])
    assert mixing.mix(docs.where("false"), mixing.quality_domains(labels)).count() == 0
    assert mixing.mix(docs, mixing.quality_domains(labels).where("false")).count() == 244


def test_mix_brings_an_over_represented_domain_down(spark):
    docs = docs_of(spark, [("fine good words here " if i % 10 < 6 else "cheap junk spam there ") * 5 for i in range(1000)])
    labels = spark.createDataFrame([(i, int(i % 10 < 6), 0) for i in range(1000)], "doc_id bigint, quality int, toxic int")
    out = mixing.mix(docs, mixing.quality_domains(labels), corpus_pipeline.MIX_TARGETS)
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(counts) == set(range(1000))
    low = sum(n for i, n in counts.items() if i % 10 >= 6)
    assert low / sum(counts.values()) == pytest.approx(0.04, abs=0.01)


def test_rare_wanted_domain_reaches_its_share(spark, caplog):
    docs = docs_of(spark, [("fine good words here " if i < 6 else "cheap junk spam there ") * 5 for i in range(300)])
    labels = spark.createDataFrame([(i, int(i < 6), 0) for i in range(300)], "doc_id bigint, quality int, toxic int")
    with caplog.at_level("INFO", logger="hirelake.llm.mixing"):
        rated, model, reached = mixing.mixture(docs, mixing.quality_domains(labels))
    assert model["names"] == ["clean", "low"]
    assert reached / reached.sum() == pytest.approx([0.96, 0.04], abs=0.02)
    assert max(r.rate for r in rated.collect()) > 16
    assert "shares reached" in caplog.text


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    texts = ["Hello wörld, it's  me", None, "", "a" * 30000, "tab\tnew\nline\u00a0nbsp\u3000wide", "word " * 9000, "<|endoftext|> x<|startoftext|>y",
             "ÀÉ e\u0301 ﬁ ΣΑΣ", "Hello wörld, it's  me"]
    docs = docs_of(spark, texts).repartition(3)
    rows = packing.pack(docs, length=512).collect()
    tok = Tokenizer.from_file(packing.default_tokenizer())
    whole, at = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        whole.setdefault(r.doc_id, {})[r.start] = (ids, r.doc_tokens)
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in enumerate(texts):
        ids = np.concatenate([x for _, (x, _) in sorted(whole[i].items())])
        assert ids.tolist() == tok.encode(t or "", add_special_tokens=False).ids + [2]
        assert all(n == len(ids) for _, n in whole[i].values())
    for seq, pieces in at.items():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces[:-1]]).tolist()
        assert sum(n for _, n in pieces) == 512 or seq == max(at)
    assert sorted(at) == list(range(len(at)))
    assert packing.pack(docs.where("false")).count() == 0


URLS = ["http://A.Example.ORG/es/x?q", "https://example.org/en/12", "http://www.example.org", "http://shop.com/fr/", "http://shop.com/de/1#top",
        "http://xcom/de/", None, "no scheme", "://host/p", "http://com/de/x://y", "HTTP://Ünï.ORG/", "", "http://far.net/a"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "old") for i, u in enumerate(URLS)], "page_id bigint, url string, html string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_graph.filter_urls(pages).collect()}
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2][:3] == ("www.example.org", "", None)
    assert got[3] == ("shop.com", "/fr/", "com/fr/", "allow")
    assert got[4] == ("shop.com", "/de/1", "com/de/", "block")
    assert got[5][2] is None and got[6][:3] == got[7][:3] == ("", "", None) and got[8][:2] == ("host", "/p")
    assert got[9] == ("com", "/de/x://y", "com/de/", "block")
    assert got[10] == ("Ünï.org", "/", "org/", "allow")
    assert got[11][3] == got[12][3] == "allow"
    assert url_graph.filter_urls(pages.where("false")).count() == 0


def dense_walk(n, edges, seed, damping, steps):
    m = np.zeros((n, n))
    for a, b in edges:
        m[a, b] += 1
    out = m.sum(axis=1, keepdims=True)
    p = np.divide(m, out, out=np.zeros_like(m), where=out > 0)
    r = seed.copy()
    for _ in range(steps):
        moved = damping * (r @ p)
        r = moved + seed * (1 - moved.sum())
    return r


def test_link_graph_matches_dense_walk(spark):
    rules = (("allow", "good.net", "/"), ("block", "bad.net", "/"))
    names = ["good.net", "bad.net", "near.net", "shady.net", "alone.net"]
    edges = [(0, 2), (0, 2), (2, 0), (3, 1), (3, 1), (3, 2), (1, 3), (2, 2)]
    html = {i: "".join(f'<a class="x" href="http://{names[b].upper()}/p?q">l</a>' if a != b else "<a href='/local'>l</a>" for a, b in edges if a == i)
            for i in range(5)}
    pages = spark.createDataFrame([(i, f"http://{n}/", html[i]) for i, n in enumerate(names)], "page_id bigint, url string, html string")
    got = sorted(url_graph.filter_urls(pages, rules, steps=6).collect(), key=lambda r: r.page_id)
    assert [r.trust for r in got] == pytest.approx(dense_walk(5, edges, np.eye(5)[0], 0.85, 6))
    assert [r.distrust for r in got] == pytest.approx(dense_walk(5, [(b, a) for a, b in edges], np.eye(5)[1], 0.85, 6))
    assert [r.verdict for r in got] == ["allow", "block", "allow", "block", "allow"]


def test_walk_settles_and_reaches_far_hosts(spark):
    rules = (("allow", "h0.net", "/"), ("block", "h13.net", "/"))
    edges = [(0, 0)] + [(i, i + 1) for i in range(1, 13)]
    far = "y" * 3000
    html = {a: f'<a title="{far}" href="http://h{b}.net/">l</a><a name="x"><a>' for a, b in edges}
    pages = spark.createDataFrame([(i, f"http://h{i}.net/", html.get(i)) for i in range(14)], "page_id bigint, url string, html string")
    got = sorted(url_graph.filter_urls(pages, rules).collect(), key=lambda r: r.page_id)
    want = dense_walk(14, [(b, a) for a, b in edges], np.eye(14)[13], 0.85, 400)
    assert [r.distrust for r in got] == pytest.approx(want, rel=1e-4)
    assert [r.verdict for r in got] == ["allow"] + ["block"] * 13


def test_url_graph_uses_no_python(spark):
    plan = url_graph.op2_url_graph(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.common.written(stage(spark, before, SF), name)
        assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString()
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        left = [r.doc_id for r in after.select("doc_id").collect()]
        assert set(left) <= ids
        if name == "exact_dedup":
            assert after.select("text").distinct().count() == before.select("text").distinct().count() == len(left)
        if name == "mixing":
            assert set(left) == ids
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert pieces.agg(F.sum("length")).first()[0] > 0
    ran = corpus_pipeline.run(spark, SF)
    assert ran.columns == pieces.columns and ran.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_packing_hands_python_small_batches(spark, monkeypatch):
    """Texts go to the tokenizer at most 1,000 at a time, and the session's own setting comes back."""
    from hirelake.llm import packing
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, real = spark.conf.get(key), [], packing.written
    monkeypatch.setattr(packing, "written", lambda df, name: seen.append(int(spark.conf.get(key))) or real(df, name))
    docs = spark.range(2500).selectExpr("id as doc_id", "concat('word ', id) as text")
    assert packing.tokenized(docs, packing.default_tokenizer()).count() == 2500
    assert seen == [1000] and spark.conf.get(key) == before


def test_packing_cuts_without_python(spark):
    """The ids, once written, go through Python no more: a batch of them may be 64 MB there and in the JVM."""
    docs = spark.range(5).selectExpr("id as doc_id", "repeat('word ', 3000) as text")
    pieces = packing.pack(docs)
    plan = pieces._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pieces.schema.simpleString() == ("struct<doc_id:bigint,start:bigint,length:bigint,ids:binary,ids_crc32:bigint,doc_tokens:bigint,"
                                            "sequence_id:bigint,offset:bigint>")


def test_tokenizer_asks_once_for_a_word_of_many_blocks():
    """Words in use stay remembered while new ones come, more than the tables hold."""
    import pyarrow as pa
    tok = packing.WordTokenizer(packing.default_tokenizer(), 2)
    asked, real = [], tok._words
    tok._words = lambda words: asked.extend(words) or real(words)
    letters = "abcdefghijklmnopqrstuvwxyz"
    def word(k):
        return "".join(letters[k // 26 ** e % 26] for e in range(5)) + "q"
    for block in range(60):
        fresh = " ".join(word(5000 * block + k) for k in range(5000))
        got = tok.ids(pa.array([f"Often, {fresh} OFTEN. \u00c9t\u00e9!".encode(), b""], pa.binary())).to_pylist()
        assert got[1] == np.uint32(2).tobytes()
    assert asked.count("often") == asked.count("\u00e9t\u00e9") == 1 and len(asked) == 60 * 5000 + 2
    assert len(tok.new) + len(tok.old) < 60 * 5000
    assert np.frombuffer(got[0], "<u4").tolist() == tok.tok.encode(f"Often, {fresh} OFTEN. \u00c9t\u00e9!", add_special_tokens=False).ids + [2]


def test_tokenizer_equals_its_library_on_odd_texts():
    import random

    import pyarrow as pa
    tok = packing.WordTokenizer(packing.default_tokenizer(), 2)
    rnd = random.Random(2)
    signs = "aAzZ \u00e9\u00c9\u00e8\u00df\u1e9e\u017f\u212a\u00c5\u0130\u0131\u01c5'\u2019.,;:!?*%$&#)(09\u03a3\u03c3\u0301\u0307\u0331H\u00a0\u3000\u00aa\u0149\u4e2d\ufb01\t\n\x1c\x85s"
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12))) + rnd.choice(["", "", "", "<|endoftext|>", "<|ENDOFTEXT|> x"]) for _ in range(5000)]
    got = tok.ids(pa.array([t.encode() for t in ["first", *texts]], pa.binary()).slice(1)).to_pylist()
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tok.tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert tok.ids(pa.array([b"ab\xff cd", b"ab"], pa.binary())).to_pylist()[0] == tok.ids(pa.array(["ab\ufffd cd".encode()], pa.binary())).to_pylist()[0]
    assert len(tok.ids(pa.array([], pa.binary()))) == 0
