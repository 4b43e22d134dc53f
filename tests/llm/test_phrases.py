"""Phrase mining against brute force."""
import random
import re
from collections import Counter

import pytest

from hirelake.llm import phrases

DDL = "doc_id bigint, text string, lang string, rank int, phrase string"


def brute(rows, least, top=2000, percent=100):
    total, f = Counter(), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(w)
            for n in range(1, 6):
                for i in range(len(w) - n + 1):
                    f[lang or "und", tuple(w[i:i + n])] += 1
    out = []
    for lang in total:
        mine = {p: a for (x, p), a in f.items() if x == lang and a >= least}
        found = []
        for p, a in mine.items():
            if len(p) < 2 or any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                                 for q, b in mine.items()):
                continue
            score, k = min((1000 * a * total[lang] // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def corpus(seed, docs=120, vocab=25):
    r = random.Random(seed)
    words = ["the", "of", "x", "Über", "ÉTÉ", "a b", "NO", "\x01"] + [f"w{i}" for i in range(vocab)]
    stock = ["once upon a time there", "in the year of", "Terms and Conditions apply here now"]
    rows = []
    for _ in range(docs):
        parts = [r.choice(stock) if r.random() < 0.15 else r.choice(words) for _ in range(r.randrange(0, 60))]
        text = "".join(p + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ";", ","]) for p in parts)
        rows.append((text, r.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("...", "fr"), ("A", "fr"), rows[0], rows[0]]


def got(spark, rows, least, **more):
    df = phrases.collocations(spark.createDataFrame([(i, t, x, 7, "p") for i, (t, x) in enumerate(rows)], DDL).repartition(3), least, **more)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("more", [{}, {"bits": 9, "block_bytes": 900}, {"top": 5}])
def test_equals_brute_force(spark, more):
    rows = corpus(1)
    want = brute(rows, 6, more.get("top", 2000))
    assert len(want) > 10
    assert got(spark, rows, 6, **more) == want


def test_very_long_pieces_are_cut_without_loss(spark):
    r = random.Random(5)
    rows = [(" ".join(r.choice(["a", "b", "cc", "Dd"]) for _ in range(3000)), "en"), ("z" * 5000 + " b a cc", "en"), ("a b cc " * 200, "de")]
    assert got(spark, rows, 5, block_bytes=100) == brute(rows, 5)
    for text, _ in rows:
        parts = list(phrases.segments(text.lower().encode(), 100))
        assert b"".join(p[:own] for p, own in parts) == text.lower().encode()


def test_share_of_the_longer_phrase(spark):
    rows = corpus(2)
    assert got(spark, rows, 6, inside_percent=60) == brute(rows, 6, percent=60)


def test_scores_past_64_bits(spark):
    found = spark.createDataFrame([("en", 1, "a", 10**12), ("en", 1, "b", 2 * 10**12), ("en", 2, "a b", 9 * 10**11)], "lang string, n int, phrase string, f bigint")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, total bigint")
    keep = phrases.phrase_counts
    phrases.phrase_counts = lambda *a, **k: (found, totals)
    try:
        row = phrases.collocations(None).first()
    finally:
        phrases.phrase_counts = keep
    assert row.score == 1000 * 9 * 10**11 * 10**15 // (10**12 * 2 * 10**12)


def test_nothing(spark):
    assert got(spark, [], 1) == []
    assert got(spark, [(None, None)], 1) == []
