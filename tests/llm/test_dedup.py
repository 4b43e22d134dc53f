"""Exact dedup, SimHash, components and order MinHash against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from hirelake.llm import components, cuckoo, order_minhash, simhash

DOC = "doc_id bigint, text string, lang string, fingerprint int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1) for i, t in rows], DOC)


ROWS = [(1, "same"), (5, "same"), (3, "same"), (5, "same"), (7, None), (8, ""), (9, "Other"), (10, "other"), (None, "lone"), (None, "lone"),
        (11, "x y z " * 5000)]


def test_exact_duplicates(spark):
    got = cuckoo.exact_duplicates(docs_of(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    by_text = {}
    for i, t in ROWS:
        by_text.setdefault(t or "", []).append(i)
    for r in got:
        group = next(v for t, v in by_text.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(group)
        assert r.keep_id == max((i for i in group if i is not None), default=None)
    assert sum(r.kept for r in got) == len(by_text)
    assert cuckoo.exact_duplicates(docs_of(spark, ROWS).where("false")).count() == 0


def test_drop_exact_duplicates_keeps_columns_and_one_row_each(spark):
    docs = docs_of(spark, ROWS)
    out = cuckoo.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str) == sorted(
        [(5, "same"), (8, ""), (9, "Other"), (10, "other"), (None, "lone"), (11, "x y z " * 5000)], key=str)


def test_cuckoo_shard_insert_delete_resize():
    random.seed(3)
    shard, live = cuckoo.CuckooShard(4), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(4000)]
    for step in range(12000):
        k = random.choice(keys)
        if random.random() < 0.3:
            assert shard.delete(k) == (live.pop(k, None) is not None)
        else:
            assert shard.insert(k, step) == (k not in live)
            live[k] = max(step, live.get(k, 0))
    assert shard.n > 4 and shard.count == len(live)
    again = cuckoo.CuckooShard.from_row(*shard.row(0)[1:])
    for k in keys:
        assert (again.get(k) is not None) == (k in live)
        assert k not in live or (again.get(k)[0] == live[k] and again.maybe(k))


def test_index_table_insert_then_delete(spark):
    keyed = cuckoo.digests(docs_of(spark, [(i, f"text {i}") for i in range(300)]))
    rows = keyed.selectExpr("digest", "id AS best", "1L AS copies")
    index = cuckoo.apply(None, rows, n_shards=8)
    index = cuckoo.apply(index, deletes=keyed.where("id < 100").select("digest"), n_shards=8)
    assert {r.keep_id for r in cuckoo.live(index).collect()} == set(range(100, 300))
    index = cuckoo.apply(index, rows.where("best between 50 and 150"), n_shards=8)
    got = {r.keep_id: r.group_size for r in cuckoo.live(index).collect()}
    assert set(got) == set(range(50, 300)) and got[120] == 2 and got[60] == 1


def brute_simhash(text, n):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


TEXTS = [None, "", " \n\t", "one", "one two", "one two three", "One  TWO\tthree four", "é è É ç x", "a a a a a a", "a b c d e f g " * 300]


def test_fingerprints_match_brute_force(spark):
    docs = docs_of(spark, list(enumerate(TEXTS)))
    got = {r.doc_id: r.print for r in simhash.fingerprints(docs, 3, into="print").collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] & (1 << 64) - 1 == brute_simhash(t, 3)
        if t and t.split():
            from pyspark.sql import functions as F
            one = spark.range(1).select(F.xxhash64(F.lit("one")).alias("h")).first().h
            assert t != "one" or got[i] == one


def brute_groups(prints, radius):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if bin((prints[i] ^ prints[j]) & (1 << 64) - 1).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("tile", [4, 1000])
def test_links_connect_what_brute_force_connects(spark, tile):
    rng = random.Random(5)
    prints = []
    for _ in range(25):
        p = rng.getrandbits(64)
        prints.append(p)
        for _ in range(rng.randrange(8)):  # chains of small steps
            p ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.append(p)
    prints += [0, 0, 1, (1 << 64) - 1]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fingerprint bigint")
    links = simhash.fingerprint_links(df, 3, tile)
    roots = {r.node: r.root for r in components.components(links).collect()}
    expect = brute_groups(prints, 3)
    got = [roots.get(p, p) for p in signed]
    same = {}
    for e, g in zip(expect, got):
        assert same.setdefault(e, g) == g
    assert len(set(got)) == len(set(expect))


def test_near_duplicates(spark):
    base = " ".join(f"word{i}" for i in range(400))
    docs = docs_of(spark, [(4, base), (2, base + " tail"), (9, base), (1, "quite another thing " * 9), (6, None), (5, " "), (None, base)])
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    expect = brute_groups([brute_simhash(t, 3) for t in (base, base + " tail")], 3)
    assert got[9] == got[4] == got[None] and got[6] == got[5] == 5 and got[1] == 1
    assert got[2] == 2 and got[4] == (2 if len(set(expect)) == 1 else 4)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_drop_near_duplicates_with_null_and_repeated_ids(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(200)) for x in "abcde")
    docs = docs_of(spark, [(None, a), (None, b), (None, b), (None, c), (2, d), (5, d), (5, e), (7, e), (None, e)])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(None, a), (None, b), (None, c), (2, d), (5, e)], key=str)


def test_one_large_group_gives_a_forest_only():
    left = np.arange(2000, dtype=np.uint64) & np.uint64(7)
    a, b = simhash.tile_forest(left, None, 3)
    assert len(a) < 2000 and len(set(b.tolist())) == 1


def test_components_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(2000, 2000)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 1000 for i in range(1000, 1200)) and got[2000] == 2000
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


MASK = (1 << 24) - 1


def signed64(x):
    return x - (1 << 64) if x >> 63 else x


def brute_slots(spark, text, k=order_minhash.K):
    """Slots of a text in plain Python; only Spark's hash of a k-mer is taken from Spark."""
    words = [w for w in re.split(r"[ \t\n\x0B\f\r]+", text) if w]
    if not words:
        return []
    grams = [words[i:i + k] for i in range(len(words) - k + 1)] if len(words) > k else [words]

    def hashed(parts, seed=42):  # Spark chains the hash of several values through the seed
        for p in parts:
            seed = (xxhash.xxh64_intdigest(p.encode(), seed) if isinstance(p, str) else
                    xxhash.xxh64_intdigest((p & (1 << 64) - 1).to_bytes(8, "little"), seed))
        return signed64(seed)

    def hash_int(a, b):  # a long, then an int (hashed by Spark with its own 4-byte form)
        return hashed([a]) if b is None else spark.sql(f"SELECT xxhash64({a}L, {b}) AS h").first().h

    entries = sorted((hashed(g) & ~MASK) | min(i, MASK) for i, g in enumerate(grams))
    if len({hashed(g) for g in grams}) < len(grams):
        out, seen = [], {}
        for e in entries:
            n = seen[e >> 24] = seen.get(e >> 24, -1) + 1
            out.append(e if n == 0 else (hash_int(e >> 24, n) & ~MASK) | (e & MASK))
        entries = sorted(out)
    bins = {}
    for e in entries:
        bins.setdefault(e >> 58, []).append(e)
    slots = []
    for b, es in sorted(bins.items()):
        pair = sorted(es[:2], key=lambda e: e & MASK)
        slots.append((hashed([e >> 24 for e in pair]) & (1 << 25) - 1) * 64 + (b & 63))
    return slots


def test_order_minhash_matches_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(50)]
    texts = ["", "  ", "one", "one two three four five", " a b c d e f ", "x " * 40, "p q r s t " * 9,
             " ".join(rng.choice(vocab) for _ in range(300)), "\n".join(rng.choice("ab") for _ in range(60))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: r.slots for r in order_minhash.with_slots(df, "text", "slots").collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_slots(spark, t), t


def test_fingerprint_documents_order_and_edit(spark):
    rows = [(3, "ab cd ef gh ij kl"), (1, "0123456789"), (2, None), (9, "é" * 5), (9, "é" * 5), (None, "end of all")]
    got = order_minhash.fingerprint_documents(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    order = [(9, "é" * 5), (3, "ab cd ef gh ij kl"), (2, ""), (1, "0123456789"), (None, "end of all")]
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        h = len(t) // 2
        for r in (r for r in got if r.doc_id == i):
            assert r.edited_sha256 == hashlib.sha256((t[:len(t) - h] + u[:h]).encode()).hexdigest()
            assert r.n_chars == len(t) and r.next_id == j
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    single = order_minhash.fingerprint_documents(docs_of(spark, [(1, "a b c d e f g")])).first()
    assert single.near_next == 1.0 and single.next_id == 1
    assert order_minhash.fingerprint_documents(docs_of(spark, rows).where("false")).count() == 0
