"""Operator 10, SimHash near-dedup: 64-bit fingerprints of word shingles,
linked by a tiled exact comparison.

Distinct fingerprints are dealt into tiles of equal population count.  Every
pair of tiles whose population counts differ by no more than the radius is
compared whole, with numpy exclusive-or and bit counts; other pairs cannot hold
a link.  A pair of tiles returns a spanning forest of its links, not the
links, so a group of thousands of near copies costs one row for each member.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from hirelake.llm.common import append_scores, private, read, text_bytes, written
from hirelake.llm.components import components

TILE = 32768
SEED = 42


def text_simhash(raw: bytes, shingle: int) -> int:
    """Fingerprint of one text (bytes), as a signed 64-bit integer."""
    from xxhash import xxh64_digest

    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        digests = xxh64_digest(b" ".join(words), SEED)
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digests = b"".join([xxh64_digest(joined[i:j], SEED) for i, j in
                            zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(rows), 1 << 16):
        ones += np.unpackbits(rows[k:k + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", keep: list[str] | None = None,
                 into: str = "fingerprint") -> DataFrame:
    """The rows with the fingerprint (bigint) of their whole texts; null counts as empty."""
    return append_scores(docs, text_col, f"{into} bigint",
                         lambda: lambda texts: {into: [text_simhash(t, shingle) for t in texts]}, keep)


def _union(lab: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the labels of linked positions; a label is the least position of its group."""
    while True:
        la, lb = lab[a], lab[b]
        apart = la != lb
        if not apart.any():
            return lab
        np.minimum.at(lab, np.maximum(la[apart], lb[apart]), np.minimum(la[apart], lb[apart]))
        while True:
            up = lab[lab]
            if np.array_equal(up, lab):
                break
            lab = up


def tile_forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) fingerprints of the links within one tile (``right`` None) or between two."""
    both = left if right is None else np.concatenate((left, right))
    lab = np.arange(len(both))
    other, shift = (left, 0) if right is None else (right, len(left))
    step = max(1, (1 << 17) // max(1, len(other)))
    for i in range(0, len(left), step):
        rows = left[i:i + step, None]
        cols, skip = (other[i:], i) if right is None else (other, 0)
        near = np.bitwise_count(rows ^ cols[None, :]) <= radius
        x, y = np.nonzero(near)
        if len(x):
            lab = _union(lab, x + i, y + skip + shift)
    moved = np.flatnonzero(lab != np.arange(len(both)))
    return both[moved], both[lab[moved]]


def fingerprint_links(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect exactly the distinct ``fingerprint`` values
    that are connected by steps of at most ``radius`` differing bits."""
    spark = prints.sparkSession
    pop = F.bit_count("fingerprint")
    distinct = written(prints.select("fingerprint").distinct().withColumn("pop", pop), "prints")
    counts = {r["pop"]: -(-r["count"] // tile) for r in distinct.groupBy("pop").count().collect()}  # 65 rows at most
    if not counts:
        return spark.createDataFrame([], "a bigint, b bigint")
    parts = F.element_at(F.create_map(*[F.lit(x) for kv in counts.items() for x in kv]), F.col("pop"))
    tiles = written(distinct.withColumn("part", F.pmod(F.xxhash64("fingerprint"), parts).cast("int"))
                    .groupBy("pop", "part").agg(F.collect_list("fingerprint").alias("prints")), "tiles")
    # a tile is compared with itself, the later parts of its population count, and the next counts up to the radius
    first = tiles.select("pop", "part", "prints", F.explode(F.sequence("pop", F.col("pop") + radius)).alias("pop2"))
    reach = F.element_at(F.create_map(*[F.lit(x) for kv in counts.items() for x in kv]), F.col("pop2"))
    first = (first.withColumn("n2", reach).where("n2 is not null")
             .select("pop", "part", F.col("prints").alias("left"), "pop2",
                     F.explode(F.sequence(F.lit(0), F.col("n2").cast("int") - 1)).alias("part2"))
             .where("pop2 > pop or part2 >= part"))
    second = tiles.select(F.col("pop").alias("pop2"), F.col("part").alias("part2"), F.col("prints").alias("right"))
    pairs = first.join(second, ["pop2", "part2"]).select(
        "pop", "part", "pop2", "part2", "left", F.when((F.col("pop") == F.col("pop2")) & (F.col("part") == F.col("part2")), F.lit(None)).otherwise(F.col("right")).alias("right"))

    def compare(batches):
        import pyarrow as pa

        def print_array(x):
            return np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)

        for batch in batches:
            for i in range(batch.num_rows):
                left, right = batch.column(0)[i], batch.column(1)[i]
                a, b = tile_forest(print_array(left), print_array(right) if right.is_valid else None, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    wide = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pairs.repartition(wide, "pop", "part", "pop2", "part2")  # by the tiles' numbers, so that a task that runs again deals alike
    return dealt.select("left", "right").mapInArrow(compare, "a bigint, b bigint")


def rooted(prints: DataFrame, radius: int, least: Column) -> DataFrame:
    """(fingerprint, ``least`` of its rows, root): one row per distinct fingerprint; a root names a group."""
    least = prints.groupBy("fingerprint").agg(least.alias("least"))
    roots = written(components(written(fingerprint_links(prints, radius), "links")), "roots")
    linked = least.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    return written(linked, "linked")


def near_groups(prints: DataFrame, radius: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(fingerprint, component_id): least id reachable over links of fingerprints, ids by distinct fingerprint."""
    linked = rooted(prints, radius, F.min(id_col))
    heads = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return linked.join(heads, "root").select("fingerprint", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``fingerprint`` (bigint), ``component_id``.

    Equal fingerprints are one node; so copies, and texts without words
    (fingerprint zero), link like any other.  Repeated rows share a component.
    Null ids stay, and never name a component unless it has no other id.
    """
    prints = written(fingerprints(docs, shingle, text_col, [id_col]), "fingerprints")
    groups = near_groups(prints, radius, id_col)
    return prints.join(groups, "fingerprint").select(id_col, "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents less all but one of each group: the row with the least id
    (null ids last), of several texts with that id the least digest, and of
    repeated rows of both one.  Columns as given."""
    name = private(docs)
    digest = name + "digest"
    marked = docs.withColumn(digest, F.unhex(F.sha2(text_bytes(F.col(f"`{text_col}`")), 256)))
    prints = written(fingerprints(marked, shingle, text_col, [id_col, digest]), "fingerprints")
    head = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.col(digest).alias("digest"))
    heads = rooted(prints, radius, F.min(head)).groupBy("root").agg(F.min("least").alias("head"))
    stay = heads.select(F.col("head.id").alias(name + "id"), F.col("head.digest").alias(name + "kept"))
    return one_row_each(marked, stay, [(id_col, name + "id"), (digest, name + "kept")]).drop(digest)


def one_row_each(docs: DataFrame, keys: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``docs`` that match a key row, one for each (the rest of the row decides which)."""
    from pyspark.sql import Window

    cond = None
    for x, y in on:
        c = docs[f"`{x}`"].eqNullSafe(keys[y])
        cond = c if cond is None else cond & c
    rank = private(docs) + "rank"
    cols = [docs[f"`{c}`"] for c in docs.columns]
    w = Window.partitionBy(*[docs[f"`{x}`"] for x, _ in on]).orderBy(F.xxhash64(*cols))
    return (docs.join(keys, cond, "left_semi").withColumn(rank, F.row_number().over(w))
            .where(F.col(rank) == 1).drop(rank))


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    near = near_duplicates(read(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
