"""Operator 3, exact dedup: a sharded cuckoo-filter index over live digests.

A shard holds a cuckoo filter (16-bit tags, 4 slots a bucket) and the live
digests themselves in buckets by their leading bytes.  A key that the filter
does not know is new; a filter hit is verified against the bucketed digests.
When an insertion finds no free slot, the filter is rebuilt at twice the size
from the stored keys.  Digests can be inserted and deleted at any time; the
index is a table with one row per shard.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelake.llm.blocks import arrow_of, batch_of, rows_of
from hirelake.llm.common import keyed_stream, private, read, text_bytes, written

SLOTS = 4
KICKS = 200
#: Digests that a shard of an index is made for.
SHARD_DIGESTS = 250_000


def index_ddl(id_type: str) -> str:
    """The columns of an index, by the type of the ids."""
    return f"shard int, n_buckets bigint, slots binary, digests binary, best array<{id_type}>, copies array<bigint>"


def _id_type(index: DataFrame | None, inserts: DataFrame | None) -> str:
    if index is not None:
        return index.schema["best"].dataType.elementType.simpleString()
    return inserts.schema["best"].dataType.simpleString() if inserts is not None else "bigint"


class CuckooShard:
    """One shard: filter, live digests (32 bytes each) with the greatest id and the number of copies."""

    def __init__(self, n_buckets: int = 64):
        self.live: dict[bytes, dict[bytes, list]] = {}
        self.count = 0
        self._empty(n_buckets)

    def _empty(self, n_buckets: int) -> None:
        from array import array
        self.n = n_buckets
        self.slots = array("H", bytes(2 * SLOTS * n_buckets))

    @staticmethod
    def _tag(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "big") or 1

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(digest[10:18], "big") % self.n

    def _other(self, bucket: int, tag: int) -> int:
        # an involution for any number of buckets: the two buckets of a tag sum to a constant
        return (tag * 0x5BD1E995 - bucket) % self.n

    def _bucket(self, i: int):
        return self.slots[i * SLOTS:(i + 1) * SLOTS]

    def maybe(self, digest: bytes) -> bool:
        tag, i = self._tag(digest), self._home(digest)
        return tag in self._bucket(i) or tag in self._bucket(self._other(i, tag))

    def get(self, digest: bytes) -> list | None:
        """[greatest id, copies] of a live digest: a filter hit is verified against the stored digests."""
        return self.live.get(digest[:3], {}).get(digest) if self.maybe(digest) else None

    def _place(self, digest: bytes) -> bool:
        tag, i = self._tag(digest), self._home(digest)
        for k in range(KICKS):
            for j in ((i, self._other(i, tag)) if not k else (i,)):
                b = self._bucket(j)
                if 0 in b:
                    self.slots[j * SLOTS + b.index(0)] = tag
                    return True
            spot = i * SLOTS + (k + tag) % SLOTS
            tag, self.slots[spot] = self.slots[spot], tag
            i = self._other(i, tag)
        return False

    def _rebuild(self, n_buckets: int) -> None:
        while True:
            self._empty(n_buckets)
            if all(self._place(d) for group in self.live.values() for d in group):
                return
            n_buckets *= 2

    def insert(self, digest: bytes, best, copies: int = 1) -> bool:
        """Add copies of a digest; True if it was not live before."""
        held = self.get(digest)
        if held is not None:
            if best is not None and (held[0] is None or best > held[0]):
                held[0] = best
            held[1] += copies
            return False
        self.live.setdefault(digest[:3], {})[digest] = [best, copies]
        self.count += 1
        if not self._place(digest):
            self._rebuild(2 * self.n)
        return True

    def delete(self, digest: bytes) -> bool:
        """Drop a live digest with all its copies; unknown digests change nothing."""
        if self.get(digest) is None:
            return False
        del self.live[digest[:3]][digest]
        self.count -= 1
        tag, i = self._tag(digest), self._home(digest)
        for j in (i, self._other(i, tag)):
            b = self._bucket(j)
            if tag in b:
                self.slots[j * SLOTS + b.index(tag)] = 0
                return True
        return True

    def row(self, shard: int) -> tuple:
        items = [(d, *v) for group in self.live.values() for d, v in group.items()]
        return (shard, self.n, self.slots.tobytes(), b"".join(d for d, _, _ in items), [b for _, b, _ in items], [c for _, _, c in items])

    @classmethod
    def from_row(cls, n_buckets: int, slots: bytes, digests: bytes, best: list, copies: list) -> "CuckooShard":
        self = cls(n_buckets)
        self.slots[:] = type(self.slots)("H", slots)
        for i, (b, c) in enumerate(zip(best, copies)):
            d = digests[32 * i:32 * i + 32]
            self.live.setdefault(d[:3], {})[d] = [b, c]
        self.count = len(best)
        return self


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest): SHA-256 of each whole text; null counts as empty."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.sha2(text_bytes(F.col(f"`{text_col}`")), 256)).alias("digest"))


def _shard(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int")


def apply(index: DataFrame | None, inserts: DataFrame | None = None, deletes: DataFrame | None = None,
          n_shards: int = 64) -> DataFrame:
    """The index after deleting and then inserting digests: one row per shard.

    ``inserts`` has (digest, best, copies), any number of rows a digest;
    ``deletes`` has (digest).  ``n_shards`` must be that of the given index.
    """
    kind = _id_type(index, inserts)
    out = arrow_of(index_ddl(kind))
    none = lambda t: F.lit(None).cast(t)
    cols = ["shard", "step", "digest", "best", "copies", "n_buckets", "slots", "digests", "bests", "counts"]
    parts = []
    if index is not None:
        parts.append(index.select("shard", F.lit(0).alias("step"), none("binary").alias("digest"), none(kind).alias("best"),
                                  none("bigint").alias("copies"), "n_buckets", "slots", "digests", F.col("best").alias("bests"),
                                  F.col("copies").alias("counts")))
    blank = [none("bigint").alias("n_buckets"), none("binary").alias("slots"), none("binary").alias("digests"),
             none(f"array<{kind}>").alias("bests"), none("array<bigint>").alias("counts")]
    if deletes is not None:
        parts.append(deletes.select(_shard(n_shards).alias("shard"), F.lit(1).alias("step"), "digest", none(kind).alias("best"),
                                    none("bigint").alias("copies"), *blank))
    if inserts is not None:
        parts.append(inserts.select(_shard(n_shards).alias("shard"), F.lit(2).alias("step"), "digest", "best", "copies", *blank))
    events = parts[0]
    for p in parts[1:]:
        events = events.unionByName(p)

    def play(rows):
        here, state = None, None
        for shard, step, digest, best, copies, n_buckets, slots, kept, bests, counts in rows:
            if shard != here:
                if state is not None:
                    yield state.row(here)
                here, state = shard, CuckooShard()
            if step == 0:
                state = CuckooShard.from_row(n_buckets, slots, kept, bests, counts)
            elif step == 1:
                state.delete(digest)
            else:
                state.insert(digest, best, copies)
        if state is not None:
            yield state.row(here)

    return keyed_stream(events.select(*cols), ["shard"], ["step"], lambda it: (batch_of(out, [r]) for r in play(rows_of(it))), index_ddl(kind))


def live(index: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) of every live digest of the index."""
    ddl = f"digest binary, keep_id {_id_type(index, None)}, group_size bigint"
    out = arrow_of(ddl)

    def rows(batches):
        for d, b, c in rows_of(batches):
            for k in range(0, len(b), 50_000):
                n = len(b[k:k + 50_000])
                if n:
                    yield batch_of(out, [(d[32 * i:32 * i + 32], b[i], c[i]) for i in range(k, k + n)])

    return index.select("digests", "best", "copies").mapInArrow(rows, ddl)


def exact_groups(keyed: DataFrame, n_salts: int = 32) -> DataFrame:
    """(digest, keep_id, group_size) of the digests of (id, digest) rows, through the index.

    Copies are first aggregated by digest and a salt of the id, before they
    move and after, so a digest that a third of the rows share reaches its
    shard as at most ``n_salts`` rows.
    """
    n_shards = max(64, -(-keyed.count() // SHARD_DIGESTS))
    part = (keyed.groupBy("digest", F.pmod(F.xxhash64("id"), F.lit(n_salts)).alias("salt"))
            .agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("copies")))
    return live(written(apply(None, part, n_shards=n_shards), "cuckoo"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Equal texts form a group; null counts as empty.  The row with the greatest
    id stays; of repeated rows of that id, one.  Null ids lose to any id; a
    group of null ids alone keeps one row.
    """
    from pyspark.sql import Window

    keyed = written(digests(docs, id_col, text_col), "digests")
    ranked = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("id", "digest").orderBy("digest")))
    return (ranked.join(exact_groups(keyed), "digest")
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("rank") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents less all but one of each group of equal texts.  Columns as given."""
    from hirelake.llm.simhash import one_row_each

    keyed = written(digests(docs, id_col, text_col), "digests")
    name = private(docs)
    stay = exact_groups(keyed).select(F.col("keep_id").alias(name + "id"), F.col("digest").alias(name + "kept"))
    digest = name + "digest"
    marked = docs.withColumn(digest, F.unhex(F.sha2(text_bytes(F.col(f"`{text_col}`")), 256)))
    return one_row_each(marked, stay, [(id_col, name + "id"), (digest, name + "kept")]).drop(digest)


def op3_cuckoo_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


OP3_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h, row_number() OVER (PARTITION BY doc_id, sha256(coalesce(text, ''))) AS rn
           FROM documents),
     g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AND d.rn = 1 AS kept, d.h AS text_sha256
FROM d JOIN g USING (h)
"""
