"""Byte models, language identification, scoring and quality against brute force."""
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelake.llm import bytegrams as bg, kneser_ney, language, ppm_scoring
from hirelake.llm.common import crc_mod

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra int"


def docs_of(spark, texts, langs=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], "s", len(t or ""), 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def symbols(text: bytes) -> list[int]:
    return [*(b if b < 255 else 254 for b in text), 255]


def tree_of(texts, depth):
    tree = defaultdict(Counter)
    for t in texts:
        s = [255] * depth + symbols(t)
        for i in range(depth, len(s)):
            for o in range(depth + 1):
                tree[tuple(s[i - o:i])][s[i]] += 1
    return tree


def brute_ppm(tree, text, depth):
    """log10 probability, symbol by symbol, with explicit exclusion sets."""
    s, total = [255] * depth + symbols(text), 0.0
    for i in range(depth, len(s)):
        out = set()
        for o in range(depth, -1, -1):
            ctx = tree.get(tuple(s[i - o:i]))
            if not ctx:
                out = set()
                continue
            left = {k: c for k, c in ctx.items() if k not in out}
            whole = sum(left.values())
            if s[i] in left:
                total += math.log10((left[s[i]] - 0.5) / whole)
                break
            if left:
                total += math.log10(0.5 * len(left) / whole)
            out = set(ctx)
        else:
            total -= math.log10(256 - len(out))
    return total


TEXTS = ["the cat sat on the mat", "The cat sat.", "", None, "a dog\tand a cat", "éçà été", "\u0000zero", "the the the the",
         "x" * 400, "the cat sat on the mat", " lead and trail ", "…", "1234 5678", "mat cat", "qqq zzz", "on on on"]


@pytest.mark.parametrize("depth", [2, 5])
def test_ppm_matches_brute_force(spark, depth):
    docs = docs_of(spark, TEXTS)
    train = crc_mod("doc_id", 10) != 0
    got = {r.doc_id: r for r in ppm_scoring.score_documents(docs, train, depth=depth).collect()}
    raw = [(t or "").encode().lower() for t in TEXTS]
    learned = [i for i in range(len(TEXTS)) if zlib.crc32(str(i).encode()) % 10 != 0]
    tree = tree_of([raw[i] for i in learned], depth)
    counts = Counter(w for i in learned for w in raw[i].split())
    n, v = sum(counts.values()) + len(learned), len(counts) + 1
    for i, t in enumerate(raw):
        assert got[i].score == pytest.approx(brute_ppm(tree, t, depth), rel=1e-5)
        tokens = [counts[w] for w in t.split()] + [len(learned)]
        assert got[i].base_score == pytest.approx(sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in tokens))
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(tokens), sum(c > 0 for c in tokens), n)
        assert got[i].train == (i in learned)


def test_ppm_is_a_distribution():
    texts = [b"abracadabra", b"abra", b"cab"]
    uniq, inv, _ = bg.runs(bg.doc_grams(texts, 3))
    tree = bg.ppm_tree(bg.levels_from(uniq, np.bincount(inv).astype(float), range(4)))
    for context in (b"abr", b"zzz", b"\xff\xff\xff", b"cad"):
        grams = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert (10 ** bg.ppm_log10(tree, grams)).sum() == pytest.approx(1)


def test_kneser_ney_is_a_distribution():
    texts = [b"abracadabra abracadabra", b"abra cadabra", b"cab cab abc"]
    uniq, inv, _ = bg.runs(bg.doc_grams(texts, 3))
    levels = bg.kn_levels(uniq, np.bincount(inv).astype(float), 3, 0)
    d = [bg.kn_discounts(bg.count_of_counts(x["counts"])) for x in levels]
    for context in (b"abr", b"zzz", b"\xff\xff\xff", b"cad"):
        grams = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert (10 ** bg.kn_log10(levels, d, grams)).sum() == pytest.approx(1)


def test_sharded_kneser_ney_matches_one_table(spark):
    docs = docs_of(spark, TEXTS)
    got = {r.doc_id: r.perplexity for r in kneser_ney.perplexities(docs, F.col("doc_id") != 3, depth=4).collect()}
    raw = [(t or "").encode().lower() for t in TEXTS]
    uniq, inv, _ = bg.runs(bg.doc_grams([t for i, t in enumerate(raw) if i != 3], 4))
    levels = bg.kn_levels(uniq, np.bincount(inv).astype(float), 4, 0)
    d = [bg.kn_discounts(bg.count_of_counts(x["counts"])) for x in levels]
    for i, t in enumerate(raw):
        grams, at, _ = bg.runs(bg.doc_grams([t], 4))
        log = bg.kn_log10(levels, d, grams)[at].sum()
        assert got[i] == pytest.approx(10 ** (-log / (len(t) + 1)), rel=1e-5)


def test_scoring_without_training_or_rows(spark):
    docs = docs_of(spark, ["ab", ""])
    got = {r.doc_id: r for r in ppm_scoring.score_documents(docs, F.lit(False)).collect()}
    assert got[0].score == pytest.approx(-3 * math.log10(256), rel=1e-6)
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens) == (1, 0, 0)
    assert ppm_scoring.score_documents(docs.where("false"), F.lit(True)).count() == 0


def test_many_blocks_and_salts(spark):
    """Tiny blocks and several salts give the same scores as one block."""
    from hirelake.llm import blocks
    docs = docs_of(spark, TEXTS)
    train = F.col("doc_id") % 3 != 0
    one = {r.doc_id: r.score for r in ppm_scoring.score_documents(docs, train).collect()}
    packed = blocks.pack(docs.repartition(3), "doc_id", "text", train, block_bytes=30)
    assert packed.count() > 5
    many, _ = blocks.ngram_scores(packed, ppm_scoring.DEPTH, ppm_scoring.bigram_sums, ppm_scoring.ppm_shard(ppm_scoring.DEPTH), salted=2)
    assert {r.id: r.score for r in many.collect()} == pytest.approx(one)


def test_quality_keeps_good_and_drops_noise(spark):
    good = [f"the people of the town went to the market and bought {w} for the day" for w in "abcdefghijklmnopqrstuvwxyz" for _ in range(3)]
    bad = ["%%% $$$ ### @@@ " * 20, "zxq jkw vvq " * 30]
    docs = docs_of(spark, good + bad + [None], ["en"] * len(good) + ["en", None, "fr"])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(good))] + [(None, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.quality(docs, labels).collect()}
    assert len(got) == len(good) + 3
    assert sum(got[i].keep for i in range(len(good))) > 0.9 * len(good)
    assert not got[len(good)].keep and not got[len(good) + 1].keep
    assert kneser_ney.quality(docs.where("false"), labels).count() == 0
    assert all(r.keep for r in kneser_ney.quality(docs, labels.where("false")).collect())


def test_quality_thresholds_use_all_held_out_labels(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["town", "market", "people", "bought", "bread", "day"], 5 + i % 9)) for i in range(400)]
    langs = ["fr" if i % 10 == 0 else "en" for i in range(400)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    rows = kneser_ney.quality(docs_of(spark, texts, langs), labels, max_trusted=10).collect()
    for la in ("en", "fr"):
        held = [r.perplexity for r in rows if r.lang == la and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
        low, high = {(r.low, r.high) for r in rows if r.lang == la}.pop()
        assert low * 1.25 == pytest.approx(min(held)) and high / 1.25 == pytest.approx(max(held))


def test_quality_trains_on_all_trusted_documents(spark):
    """More of them than 50,000; two documents share an id, and one has none."""
    n = 66_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("ab"), F.pmod(F.xxhash64("id"), F.lit(29)).cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(1, "en", "zz"), (None, None, "ab7")], "doc_id long, lang string, text string"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = kneser_ney.quality(docs, labels).groupBy("doc_id", "n_bytes").agg(F.max("perplexity").alias("p"))
    want = kneser_ney.perplexities(docs, (crc_mod("doc_id", 5) != 0) & F.col("doc_id").isNotNull()).groupBy("doc_id", "n_bytes").agg(F.max("perplexity").alias("q"))
    both = got.join(want, got.doc_id.eqNullSafe(want.doc_id) & (got.n_bytes == want.n_bytes))
    assert got.count() == both.count() == n + 2 - (got.where("doc_id = 1").count() == 1)
    assert both.where(F.abs(F.col("p") / F.col("q") - 1) > 1e-9).count() == 0


def test_language(spark):
    words = {"en": "the and of people with that house water".split(), "de": "der und die nicht wasser haus über schön".split()}
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(words[la], 12)) for la in ("en", "de") * 60] + [None, "", "123 !!", "the water", "schön über"]
    langs = ["en", "de"] * 60 + [None, "en", "de", None, None]
    docs = docs_of(spark, texts, langs)
    trees = language.train(docs, crc_mod("doc_id", 5) != 0)
    assert list(trees) == ["de", "en"]
    got = {r.doc_id: r for r in language.identify(docs, trees).collect()}
    assert all(got[i].lang_pred == langs[i] for i in range(120))
    assert [got[i].lang_pred for i in range(120, 125)] == ["und", "und", "und", "en", "de"]
    assert got[0].extra == 1 and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.train(docs.where("false"), F.lit(True)) == {}


def test_over_large_documents_do_not_end_the_sample(spark):
    small = [f"the water and house {i}" for i in range(40)]
    docs = docs_of(spark, small + ["x" * 3000] * 20 + ["y" * 5000], ["en"] * 60 + ["de"])
    sizes = {"max_docs": 50, "max_bytes": 2000}
    trees = language.train(docs, F.lit(True), **sizes)
    alone = language.train(docs.where("doc_id < 40"), F.lit(True), **sizes)
    for got, want in zip(trees["en"], alone["en"]):
        assert set(got) == set(want) and all(np.array_equal(got[x], want[x]) for x in want)
    assert "de" in trees


def test_language_code_lengths_match_brute_force():
    trained = [b"the cat sat on the mat", b"a cat"]
    uniq, inv, _ = bg.runs(bg.doc_grams(trained, 3))
    trees = {"x": bg.ppm_tree(bg.levels_from(uniq, np.bincount(inv).astype(float), range(4)))}
    tree = tree_of(trained, 3)
    texts = [b"the mat", b"", b"zebra on a mat", "été".encode()]
    bits = language.code_lengths(texts, trees, 3)[:, 0]
    assert bits == pytest.approx([-brute_ppm(tree, t, 3) * math.log2(10) for t in texts])


def test_buckets_beyond_sixteen_bits_stay_whole():
    import numpy as np
    from hirelake.llm import blocks
    buckets = np.array([70_000, 4_464, 70_000, 1, 4_464, 799_999, 70_000])
    got = {b: at.tolist() for b, at in blocks.by_bucket(buckets)}
    assert got == {1: [3], 4_464: [1, 4], 70_000: [0, 2, 6], 799_999: [5]}
    assert blocks.by_bucket(np.zeros(0, np.int64)) == []
