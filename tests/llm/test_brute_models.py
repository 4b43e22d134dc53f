"""Models against plain versions: Kneser-Ney by dictionaries, the ordinal fit by Newton steps, the pipeline's stages by rules."""
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm import kneser_ney, toxicity
from hirelake.llm.common import written
from test_dedup import brute_groups, brute_simhash


def symbols(text):
    return [0xFE if b == 0xFF else b for b in (text or "").encode()] + [0xFF]


def grams_of(text, depth):
    s = [0xFF] * depth + symbols(text)
    return [tuple(s[i - depth:i + 1]) for i in range(depth, len(s))]


def brute_kneser_ney(trained, texts, depth):
    """Perplexity of a symbol of each text under the interpolated modified model of the trained ones."""
    tables = {depth: Counter(g for t in trained for g in grams_of(t, depth))}
    for order in range(depth - 1, -1, -1):
        tables[order] = Counter(g[1:] for g in tables[order + 1])  # each distinct longer gram counts once
    discounts, totals, held = {}, {}, {}
    for order, table in tables.items():
        n = [sum(c == j for c in table.values()) for j in (1, 2, 3, 4)]
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
            d = [min(max(x, lo), hi) for x, lo, hi in zip(d, (0.05, 0.1, 0.15), (0.95, 1.9, 2.9))]
        else:
            d = [0.5] * 3
        discounts[order] = d
        totals[order], held[order] = defaultdict(float), defaultdict(float)
        for g, c in table.items():
            totals[order][g[:-1]] += c
            held[order][g[:-1]] += d[min(c, 3) - 1]

    def log10(gram):
        p = 1 / 256
        for order in range(depth + 1):
            g = gram[depth - order:]
            total = totals[order].get(g[:-1])
            if total:
                c = tables[order].get(g, 0)
                p = (c - discounts[order][min(c, 3) - 1] if c else 0) / total + held[order][g[:-1]] / total * p
        return math.log10(p)

    return [10 ** (-sum(log10(g) for g in grams_of(t, depth)) / len(grams_of(t, depth))) for t in texts]


def test_kneser_ney_perplexities_equal_brute_force(spark):
    r = random.Random(2)
    words = "the people of a town été straße went to market and bought bread 12 ,. \x01".split(" ")
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 25))) for _ in range(90)] + [None, "", "the", "zzz qqq", "日本", "the people of a town" * 30]
    flags = [i % 3 != 0 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, f) for i, (t, f) in enumerate(zip(texts, flags))], "doc_id bigint, text string, f boolean").repartition(3)
    got = {x.doc_id: x.perplexity for x in kneser_ney.perplexities(docs, F.col("f")).collect()}
    want = brute_kneser_ney([t for t, f in zip(texts, flags) if f], texts, kneser_ney.DEPTH)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-4)


def ordinal_loss(w, theta, x, grade, l2):
    s = x @ w
    above = np.column_stack([np.ones(len(x)), *(1 / (1 + np.exp(-(s - b))) for b in theta), np.zeros(len(x))])
    k = np.arange(len(x))
    return -np.log(above[k, grade] - above[k, grade + 1]).mean() + l2 / 2 * w @ w


def test_ordinal_fit_reaches_the_dense_optimum():
    rng = np.random.default_rng(8)
    x = rng.poisson(1.0, size=(400, 5)).astype(float)
    hidden = x @ np.array([1.2, -0.7, 0.0, 0.4, 0.9]) + rng.logistic(size=400)
    grade = np.digitize(hidden, [1.5, 4.0])
    l2 = 1e-3
    w, theta = toxicity.fit_cumulative_link(toxicity.Rows([list(range(5)) for _ in x], x.tolist(), 5), grade, 3, l2=l2)
    assert theta[0] < theta[1]

    def loss(p):
        return ordinal_loss(p[:5], p[5:], x, grade, l2)

    p, h = np.array([0.0] * 5 + [0.0, 1.0]), 1e-4
    eye = np.eye(7) * h
    for _ in range(40):  # Newton's steps with differences for derivatives, halved until they help
        g = np.array([(loss(p + e) - loss(p - e)) / (2 * h) for e in eye])
        hess = np.array([[(loss(p + a + b) - loss(p + a - b) - loss(p - a + b) + loss(p - a - b)) / (4 * h * h) for b in eye] for a in eye])
        move = np.linalg.solve(hess + 1e-6 * np.eye(7), g)
        t = 1.0
        while t > 1e-6 and not loss(p - t * move) < loss(p):
            t /= 2
        p = p - t * move if t > 1e-6 else p
    assert loss(np.concatenate((w, theta))) <= loss(p) + 1e-4
    assert np.abs(np.concatenate((w, theta)) - p).max() < 0.05


WORDS = [f"w{a}{b}" for a in "aeiouy" for b in "bcdfghjklmnp"]


def small_corpus(spark, folder):
    """Clean, low and toxic documents (by their words), exact copies and near copies."""
    r = random.Random(6)
    rows, labels = [], []
    for i in range(240):
        kind = "toxic" if i % 6 == 0 else "low" if i % 6 == 1 else "clean"
        extra = {"toxic": ["vile", "vermin", "scum"], "low": ["click", "buynow", "winner"], "clean": ["therefore", "moreover", "chapter"]}[kind]
        text = " ".join(r.choice(WORDS) if r.random() < 0.8 else r.choice(extra) for _ in range(120))
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(kind == "clean"), int(kind == "toxic")))
    clean = [x for x in rows if x[0] % 6 > 1]
    for k in range(20):
        rows.append((1000 + k, clean[k][1], "en", "s", 1))             # exact copies with greater ids
        near = clean[30 + k][1].split(" ")
        near[60] = "changed"
        rows.append((2000 + k, " ".join(near), "en", "s", 1))
    rows += [(3000, None, "en", "s", 0), (3001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(os.path.join(folder, "labels.parquet"))
    return {x[0]: x[1] for x in rows}


def test_pipeline_keeps_the_rows_that_the_rules_say(spark, tmp_path):
    folder = str(tmp_path)
    texts = small_corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {i for i in texts if i >= 1000 or i % 6}                      # toxic documents go
    stages = dict(corpus_pipeline.STAGES)

    def ran(name, before):
        after = written(stages[name](spark, before, folder), name)
        assert after.columns == docs.columns
        return after, sorted(x.doc_id for x in after.collect())

    docs, got = ran("toxicity", docs)
    assert set(got) == left and len(got) == len(left)
    groups = defaultdict(list)
    for i in left:
        groups[texts[i] or ""].append(i)
    left = {max(ids) for ids in groups.values()}                         # of equal texts the greatest id stays
    docs, got = ran("exact_dedup", docs)
    assert got == sorted(left)
    ids = sorted(left)
    roots = brute_groups([brute_simhash(texts[i], corpus_pipeline.SHINGLE) for i in ids], corpus_pipeline.MAX_BITS)
    left = {ids[k] for k in roots}                                       # of near copies the least id stays
    docs, got = ran("simhash_near_dedup", docs)
    assert got == sorted(left) and len(left) < len(ids)
    docs, got = ran("mixing", docs)
    assert set(got) == left                                              # none is lost, wanted ones are repeated
    assert {(x.doc_id, x.text) for x in docs.collect()} == {(i, texts[i]) for i in left}
    words = Counter()
    for i in got:
        words["low" if i < 1000 and i % 6 == 1 else "clean"] += len((texts[i] or "").split())
    assert words["low"] / sum(words.values()) == pytest.approx(corpus_pipeline.MIX_TARGETS["low"], abs=0.01)
    pieces = stages["packing"](spark, docs, folder).collect()
    spans = defaultdict(int)
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        spans[p.doc_id] += p.length
    tokens = {p.doc_id: p.doc_tokens for p in pieces}
    times = Counter(got)
    assert spans == {i: tokens[i] * n for i, n in times.items()}
    assert sum(spans.values()) == 4096 * max(p.sequence_id for p in pieces) + max(p.offset + p.length for p in pieces if p.sequence_id == max(q.sequence_id for q in pieces))
