"""Cross-tokenizer alignment against a plain-Python version."""
import hashlib
import random
from collections import Counter

import pytest

from hirelake.llm import alignment
from hirelake.llm.packing import byte_letters

DDL = "doc_id bigint, text string, n_a string, pair int"


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    path_a, path_b = alignment.default_paths()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=path_b)


def brute(rows):
    a, b = tokenizers()
    byte = {c: x for x, c in byte_letters().items()}
    docs, held = [], Counter()
    for i, text in rows:
        ta, tb = [], []
        if text:
            ta = [(t, bytes(byte[c] for c in a.id_to_token(t))) for t in a.encode(" " + text, add_special_tokens=False).ids]
            tb = [(t, bytes([t - 3]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode()) for t in b.encode(text)]
            raw = b" " + text.encode()
            if b"".join(x for _, x in ta) != raw or b"".join(x for _, x in tb) != raw:
                ta, tb = [], []
        spans = []
        for side in (ta, tb):
            at, out = 0, []
            for t, x in side:
                out.append((t, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]]
        held.update(links)
        both = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, lo = [], 0
        for hi in both:
            groups.append("|".join(",".join(str(t) for t, _, e in side if lo < e <= hi) for side in spans))
            lo = hi
        docs.append((i, len(ta), len(tb), len(groups), links, ";".join(groups)))
    most = Counter()
    for (_, y), n in held.items():
        most[y] = max(most[y], n)
    return sorted([(i, na, nb, g, len(k), sum(held[p] == most[p[1]] for p in k), sum(held[p] for p in k),
                    hashlib.sha256(s.encode()).hexdigest() if s else "") for i, na, nb, g, k, s in docs], key=str)


ODD = [None, "", " ", "  ", "a", "Hello world, hello", "  lead and trail  ", "tab\tand\nline\r\n end", "été ÉTÉ é", "ﬁ ligature", "日本語 テキスト",
       "▁under", "<s> </s> <unk> <0x41> <|endoftext|>", "x\x00y\x01", "🙂🙂 👩‍👩‍👧", " nbsp　wide", "don't we'll I'm 12345 ...!!!", "aaaa" * 500,
       " " * 700 + "x" + "\n" * 300, "dup text", "dup text", "é combining", "﻿bom", "a▁b"]


def got(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("limits", [(2 << 20, 16 << 20), (50, 120)])
def test_equals_brute_force(spark, monkeypatch, limits):
    monkeypatch.setattr(alignment, "BATCH_BYTES", limits[0])
    r = random.Random(1)
    rows = list(enumerate(ODD)) + [(100 + i, "".join(r.choice("ab é▁\t.1日Z") for _ in range(r.randrange(40)))) for i in range(60)] + [(3, "again"), (None, "lone")]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], DDL).repartition(3)
    assert got(alignment.align(docs, spans=False, block_bytes=limits[1])) == brute(rows)


def test_spans_cut_the_same_bytes(spark):
    a, b = alignment.ByteBpe(alignment.default_paths()[0]), alignment.PieceBpe(alignment.default_paths()[1])
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(ODD)], DDL)
    for r in alignment.align(docs).collect():
        if r.n_a:
            raw = b" " + ODD[r.doc_id].encode()
            assert b"".join(a.bytes[t].as_py() for t in r.a_ids) == raw == b"".join(b.bytes[t].as_py() for t in r.b_ids)
            assert len(r.group_ends) == r.n_groups and r.group_ends[-1] == len(raw)
        else:
            assert (r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.a_ids, r.group_ends) == (0, 0, 0, 0, 0, "", [], [])


def test_other_ids_bad_bytes_and_nothing(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([("k", "some text"), ("l", "some text")], "doc_id string, text string")
    rows = got(alignment.align(docs, spans=False))
    assert [r[0] for r in rows] == ["k", "l"] and rows[0][1:] == rows[1][1:] and rows[0][1] > 0
    bad = docs.withColumn("text", F.lit(b"\xff\xfe oops").cast("string"))
    assert {r[1:] for r in got(alignment.align(bad, spans=False))} == {(0, 0, 0, 0, 0, 0, "")}
    assert got(alignment.align(docs.where("false"), spans=False)) == []


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 400]
    docs = spark.createDataFrame(short, "doc_id bigint, text string")
    assert got(alignment.align(docs, spans=False)) == brute(short)
    every = got(alignment.op12_alignment(spark, "/root/testdata/sf0.001"))
    want = {w[0]: w for w in brute_shape(rows)}
    assert len(every) == len(rows) and all((g[1:4], g[7]) == want[g[0]][1:] for g in every)


def brute_shape(rows):
    """n_a, n_b, n_groups and the digest of whole texts, without the links."""
    a, b = tokenizers()
    byte = {c: x for x, c in byte_letters().items()}
    for i, text in rows:
        ta = a.encode(" " + text, add_special_tokens=False).ids if text else []
        tb = b.encode(text) if text else []
        la = [len(a.id_to_token(t)) for t in ta]
        lb = [1 if b.is_byte(t) else len(b.id_to_piece(t).replace("▁", " ").encode()) for t in tb]
        assert not text or all(c in byte for t in ta for c in a.id_to_token(t))
        if text and sum(la) != sum(lb):
            ta, tb, la, lb = [], [], [], []
        x = y = i_a = i_b = 0
        groups, lo = [], (0, 0)
        while i_a < len(ta) or i_b < len(tb):
            if x <= y:
                x, i_a = x + la[i_a], i_a + 1
            else:
                y, i_b = y + lb[i_b], i_b + 1
            if x == y:
                groups.append(",".join(map(str, ta[lo[0]:i_a])) + "|" + ",".join(map(str, tb[lo[1]:i_b])))
                lo = (i_a, i_b)
        s = ";".join(groups)
        yield i, (len(ta), len(tb), len(groups)), hashlib.sha256(s.encode()).hexdigest() if s else ""
