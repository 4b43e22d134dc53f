"""Corpus-wide n-gram statistics by blocks of documents.

``pack`` writes the documents once, as compressed blocks of a few megabytes.
A block's distinct grams (not its symbols) are what moves: they are counted in
shards of their contexts, a model is computed shard by shard, and each block
gets back one number for each of its distinct grams.  Nothing that grows with
the corpus is broadcast or collected, and every shard is read as a stream.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from hirelake.llm import bytegrams as bg
from hirelake.llm.common import arrow_schema, keyed_stream, text_bytes, written

BLOCK_BYTES = 6 << 20
BLOCKS_PER_SALT = 512
GRAMS, WORDS = 0, 1


def squeeze(a: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def spread(blob: bytes, dtype) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


def rows_of(batches):
    """Rows of Arrow batches as tuples, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def batch_of(schema, rows: list[tuple]):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def emitted(rows, schema, most: int = 8 << 20):
    """Arrow batches of rows, cut when their binaries reach ``most`` bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(x) for x in r if isinstance(x, bytes))
        if size >= most:
            yield batch_of(schema, held)
            held, size = [], 0
    if held:
        yield batch_of(schema, held)


def pack(docs: DataFrame, id_col: str, text_col: str, flag: Column, level: int = 3, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents as blocks: ids, flags, byte lengths and the compressed whole texts, A-Z lower-cased."""
    from pyspark.sql.types import ArrayType, StructField, StructType

    id_type = docs.schema[id_col].dataType
    schema = StructType.fromDDL("block bigint, flags binary, lens binary, payload binary, n_flagged bigint")
    schema = StructType([*schema.fields, StructField("ids", ArrayType(id_type))])
    out = arrow_schema(schema)

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        z = zstandard.ZstdCompressor(level=level)
        base, k = TaskContext.get().partitionId() << 32, 0

        def block(texts, ids, flags):
            return (base + k, np.array(flags, np.uint8).tobytes(), np.array([len(t) for t in texts], np.int64).tobytes(),
                    z.compress(b"".join(texts)), int(sum(flags)), ids)

        texts, ids, flags, size = [], [], [], 0
        for i, f, t in rows_of(batches):
            if texts and (size + len(t) > block_bytes or len(texts) >= bg.MAX_DOCS):
                yield batch_of(out, [block(texts, ids, flags)])
                texts, ids, flags, size, k = [], [], [], 0, k + 1
            texts.append(t.lower())
            ids.append(i)
            flags.append(bool(f))
            size += len(t)
        if texts:
            yield batch_of(out, [block(texts, ids, flags)])

    src = docs.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(flag, F.lit(False)).alias("f"),
                      text_bytes(F.col(f"`{text_col}`")).alias("t"))
    return written(src.mapInArrow(run, schema), "blocks")


def flagged(packed: DataFrame, chosen: DataFrame, field: str) -> DataFrame:
    """The blocks, with those documents flagged whose id has a value of ``chosen``
    (one column without repeats) in its ``field``.

    The ids alone are shuffled; their flags, a byte for each document, join the blocks.
    """
    at = packed.select("block", F.posexplode("ids").alias("at", "id")).select("block", "at", F.col("id").getField(field).alias("value"))
    marked = at.join(chosen.toDF("chosen"), F.col("value") == F.col("chosen"), "left").select("block", "at", F.col("chosen").isNotNull().alias("f"))
    flags = F.transform(F.array_sort(F.collect_list(F.struct("at", "f"))), lambda x: F.when(x.f, "01").otherwise("00"))
    found = written(marked.groupBy("block").agg(F.unhex(F.array_join(flags, "")).alias("flags"), F.count_if("f").alias("n_flagged")), "flags")
    return packed.drop("flags", "n_flagged").join(found, "block").select(packed.columns)


def unpacked(lens: bytes, payload: bytes) -> list[bytes]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(payload)
    ends = np.cumsum(np.frombuffer(lens, np.int64)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def bucket_of(grams: np.ndarray, n: int) -> np.ndarray:
    """Shard of a gram, by the two symbols before its symbol: all longer contexts of a chain are in one shard."""
    ctx = (grams >> np.uint64(8)) & np.uint64(0xFFFF)
    return (((ctx * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)) >> np.uint64(9)).astype(np.int64) % n


def by_bucket(buckets: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, its positions in order) of each bucket that occurs."""
    if not len(buckets):
        return []
    order = np.argsort(buckets.astype(np.uint16) if buckets.max() < 1 << 16 else buckets, kind="stable")  # 16 bits sort faster
    b = buckets[order]
    at = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
    return [(int(b[i]), order[i:j]) for i, j in zip(at, np.append(at[1:], len(b)))]


def word_index(texts: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct white-space-free words in order of appearance, and each text as their numbers."""
    from collections import defaultdict
    seen: dict = defaultdict()
    seen.default_factory = seen.__len__
    get = seen.__getitem__
    numbers = [np.array(list(map(get, t.split())), np.int64) for t in texts]
    return list(seen), numbers


def word_buckets(words: list[bytes], n: int) -> np.ndarray:
    from zlib import crc32
    return np.fromiter(map(crc32, words), np.int64, len(words)) % n


def _count(packed: DataFrame, depth: int, n_buckets: int, n_salts: int, words: bool) -> DataFrame:
    """(bucket, salt, block, kind, keys, counts): the distinct grams of every block, counted over flagged documents."""
    ddl = "bucket int, salt int, block bigint, kind int, a binary, b binary"
    out = arrow_of(ddl)

    def rows(batches):
        for block, flags, lens, payload in rows_of(batches):
            texts, w = unpacked(lens, payload), np.frombuffer(flags, np.uint8)
            uniq, starts, d = bg.spans(bg.doc_grams(texts, depth))
            counts = np.add.reduceat(w[d], starts, dtype=np.int64)
            del starts, d
            for b, at in by_bucket(bucket_of(uniq, n_buckets)):
                k = uniq[at]
                yield b, block % n_salts, block, GRAMS, squeeze(np.diff(k, prepend=np.uint64(0))), squeeze(counts[at])
            if words:
                vocab, numbers = word_index(texts)
                counts = np.zeros(len(vocab), np.int64)
                for x, use in zip(numbers, w):
                    if use:
                        np.add.at(counts, x, 1)
                for b, at in by_bucket(word_buckets(vocab, n_buckets)):
                    yield (b, block % n_salts, block, WORDS, squeeze(np.frombuffer(b" ".join([vocab[i] for i in at]), np.uint8)),
                           squeeze(counts[at]))

    return written(packed.select("block", "flags", "lens", "payload")
                   .mapInArrow(lambda it: emitted(rows(it), out), ddl), "block_grams")


def arrow_of(ddl: str):
    from pyspark.sql.types import StructType
    return arrow_schema(StructType.fromDDL(ddl))


def _grams(a: bytes) -> np.ndarray:
    return np.cumsum(spread(a, np.uint64), dtype=np.uint64)


def _merge(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the counts of equal grams (or words) of a key; memory holds the distinct ones only."""
    ddl = ", ".join(f"{k} int" for k in keys) + ", a binary, b binary"
    out = arrow_of(ddl)

    def merged(rows):
        key, held = None, None

        def flush():
            if key[-1] == GRAMS:
                k, c = bg.summed(np.concatenate(held[0]), np.concatenate(held[1]))
                return (*key, squeeze(np.diff(k, prepend=np.uint64(0))), squeeze(c))
            return (*key, squeeze(np.frombuffer(b" ".join(held), np.uint8)), squeeze(np.fromiter(held.values(), np.int64, len(held))))

        for *k, a, b in rows:
            if k != key:
                if key is not None:
                    yield flush()
                key, held, settled, pending = k, ([], []) if k[-1] == GRAMS else {}, 0, 0
            counts = spread(b, np.int64)
            if k[-1] == GRAMS:
                held[0].append(_grams(a))
                held[1].append(counts)
                pending += len(counts)
                if pending > max(1 << 19, settled):
                    x = bg.summed(np.concatenate(held[0]), np.concatenate(held[1]))
                    held, settled, pending = ([x[0]], [x[1]]), len(x[0]), 0
            else:
                for w, c in zip(spread(a, np.uint8).tobytes().split(b" "), counts.tolist()):
                    held[w] = held.get(w, 0) + c
        if key is not None:
            yield flush()

    return keyed_stream(rows.select(*keys, "a", "b"), keys, [], lambda it: emitted(merged(rows_of(it)), out), ddl)


def ngram_scores(packed: DataFrame, depth: int, summary, build, words: bool = False,
                 salted: int = BLOCKS_PER_SALT) -> tuple[DataFrame, dict]:
    """One row per document: ``id``, ``flag``, ``n_bytes``, ``score`` (sum of the
    model's log10 probabilities of its symbols) and, with ``words``,
    ``n_words``, ``n_known`` and ``word_sum`` (sum of log10(count + 0.1)).

    ``summary(grams, counts)`` gives (key, value) pairs of a shard, which are
    summed over the shards (at most 65,536 two-symbol keys and a few more, so
    they can be collected); ``build(grams, counts, sums)`` gives log10
    probabilities of all grams of a shard.  The second result holds the sums.
    """
    spark = packed.sparkSession
    n_buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_salts = 1 + packed.count() // salted
    rows = _count(packed, depth, n_buckets, n_salts, words)
    part = _merge(rows, ["bucket", "salt", "kind"])
    whole = written(_merge(part, ["bucket", "kind"]), "grams")

    sums_ddl = "k bigint, v double"
    sums_out = arrow_of(sums_ddl)

    def summed(batches):
        for bucket, kind, a, b in rows_of(batches):
            counts = spread(b, np.int64)
            if kind == GRAMS:
                k, v = summary(_grams(a), counts)
            else:
                k, v = [-1000, -1001], [counts.sum(), (counts > 0).sum()]
            yield batch_of(sums_out, list(zip(map(int, k), map(float, v))))

    sums = {r.k: r.v for r in whole.mapInArrow(summed, sums_ddl).groupBy("k").agg(F.sum("v").alias("v")).collect()}
    shared = spark.sparkContext.broadcast(sums)

    ask_ddl = "block bigint, bucket int, kind int, a binary"
    ask_out = arrow_of(ask_ddl)

    def answered(rows):
        here, grams, logs, known = None, None, None, None
        for bucket, salt, role, kind, block, a, b in rows:
            if (bucket, salt) != here:
                here, grams, known = (bucket, salt), None, None
            if role == 0 and kind == GRAMS:
                grams = _grams(a)
                logs = build(grams, spread(b, np.int64), shared.value).astype(np.float32)
            elif role == 0:
                known = dict(zip(spread(a, np.uint8).tobytes().split(b" "), spread(b, np.int64).tolist()))
            elif kind == GRAMS:
                yield block, bucket, kind, squeeze(logs[np.searchsorted(grams, _grams(a))])
            else:
                yield block, bucket, kind, squeeze(np.array([known[w] for w in spread(a, np.uint8).tobytes().split(b" ")], np.int64))

    model = whole.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))).alias("salt"), F.lit(0).alias("role"),
                         "kind", F.lit(None).cast("bigint").alias("block"), "a", "b")
    asked = rows.select("bucket", "salt", F.lit(1).alias("role"), "kind", "block", "a", "b")
    replies = keyed_stream(model.unionByName(asked), ["bucket", "salt"], ["role", "kind"],
                           lambda it: emitted(answered(rows_of(it)), ask_out), ask_ddl)

    id_type = packed.schema["ids"].dataType.elementType
    from pyspark.sql.types import StructField, StructType
    ddl = "flag boolean, n_bytes bigint, score double" + (", n_words bigint, n_known bigint, word_sum double" if words else "")
    score_schema = StructType([StructField("id", id_type), *StructType.fromDDL(ddl).fields])
    score_out = arrow_schema(score_schema)

    def scored(rows):
        here, got = None, {}
        for block, role, bucket, kind, a, flags, lens, ids in rows:
            if block != here:
                here, got = block, {}
            if role == 0:
                got[kind, bucket] = a
                continue
            texts = unpacked(lens, a)
            uniq, starts, d = bg.spans(bg.doc_grams(texts, depth))
            logs = np.zeros(len(uniq))
            for b, at in by_bucket(bucket_of(uniq, n_buckets)):
                logs[at] = spread(got.pop((GRAMS, b)), np.float32)
            cols = [ids, np.frombuffer(flags, np.uint8).astype(bool).tolist(), np.frombuffer(lens, np.int64).tolist(),
                    bg.sums_by_doc(logs, starts, d, len(texts)).tolist()]
            del uniq, starts, d, logs
            if words:
                vocab, numbers = word_index(texts)
                c = np.zeros(len(vocab), np.int64)
                for b, at in by_bucket(word_buckets(vocab, n_buckets)):
                    c[at] = spread(got.pop((WORDS, b)), np.int64)
                w = np.log10(c + 0.1)
                cols += [[len(x) for x in numbers], [int((c[x] > 0).sum()) for x in numbers], [float(w[x].sum()) for x in numbers]]
            yield list(zip(*cols))

    blank = lambda t: F.lit(None).cast(t)
    inputs = replies.select("block", F.lit(0).alias("role"), "bucket", "kind", "a", blank("binary").alias("flags"),
                            blank("binary").alias("lens"), blank(packed.schema["ids"].dataType).alias("ids")).unionByName(
        packed.select("block", F.lit(1).alias("role"), F.lit(0).alias("bucket"), F.lit(0).alias("kind"), F.col("payload").alias("a"),
                      "flags", "lens", "ids"))
    scores = inputs.repartition("block").sortWithinPartitions("block", "role").mapInArrow(
        lambda it: (batch_of(score_out, r) for r in scored(rows_of(it))), score_schema)
    return scores, sums
