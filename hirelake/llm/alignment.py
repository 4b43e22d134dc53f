"""Operator 12, cross-tokenizer alignment as an Arrow pipeline.

Two tokenizers cut the same bytes.  For a batch of documents, the two lists of
ids are flattened, parent indices and segmented cumulative sums of the tokens'
byte lengths give every token its document and end offset, and an Acero hash
join on (document, end) finds the offsets where both end: those cut a document
into groups.  Sorted by offset, every end of either side closes exactly one
overlap of an A token with a B token, a link.  ``Table.group_by`` counts the
links of each pair of ids, Spark merges the counts over the corpus, and each
block gets the totals of its own pairs back by an equi-join.
"""
from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, functions as F

from hirelake.llm.blocks import spread, squeeze
from hirelake.llm.common import arrow_schema, read, text_bytes, written
from hirelake.llm.packing import byte_letters

BATCH_BYTES, BLOCK_BYTES = 2 << 20, 16 << 20
#: How byte-level BPE cuts text before merging (a fixed value of the tokenizer).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
B_BITS = 24


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokens:
    """Bytes, byte lengths and decimal forms of a vocabulary, as Arrow arrays by id."""

    def __init__(self, pieces: list[bytes], ends: tuple[bytes, bytes, bytes]):
        import pyarrow as pa
        self.n = len(pieces)
        self.bytes = pa.array(pieces, pa.binary())
        self.lens = pa.array([len(p) for p in pieces], pa.int64())
        #: an id's decimal digits with a comma, with the sign at a group's end, and with the sign at the text's end
        self.digits = pa.array([b"%d%b" % (i, e) for e in ends for i in range(self.n)], pa.binary())


class ByteBpe(Tokens):
    """The merges of a byte-level BPE file; special tokens are unknown to it, so their strings are plain text."""

    def __init__(self, path: str):
        import tiktoken
        model = json.load(open(path, encoding="utf-8"))
        byte = {c: b for b, c in byte_letters().items()}
        special = {t["id"] for t in model["added_tokens"]}
        ranks = {bytes(byte[c] for c in word): i for word, i in model["model"]["vocab"].items() if i not in special}
        pieces = [b""] * (1 + max(ranks.values()))
        for word, i in ranks.items():
            pieces[i] = word
        super().__init__(pieces, (b",", b"|", b"|"))
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceBpe(Tokens):
    """A SentencePiece model; it puts the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in enumerate(self.model.id_to_piece(list(range(self.model.get_piece_size()))))]
        super().__init__(pieces, (b",", b";", b""))

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _data(array) -> memoryview:
    """The bytes of a binary array, end to end."""
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset:array.offset + len(array) + 1]
    return memoryview(array.buffers()[2] or b"").cast("B")[offsets[0]:offsets[-1]] if len(array) else memoryview(b"")


def _ends(lists, lens):
    """(ids, parent document, end offset in its document) of flattened lists of ids."""
    import pyarrow.compute as pc
    ids, parent = pc.list_flatten(lists), pc.cast(pc.list_parent_indices(lists), "int64")
    sums = pc.cumulative_sum(pc.take(lens, ids))
    many = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    before = np.concatenate(([0], np.asarray(sums)))[np.cumsum(many) - many]  # bytes before each document
    return ids, parent, pc.subtract(sums, pc.take(before, parent))


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a), PieceBpe(path_b)

    def tokens(self, texts: list[bytes]):
        """Lists of A and B ids; empty for empty texts and where either side's bytes are not space and text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        plain = []
        for t in texts:
            try:
                plain.append(t.decode("utf-8"))
            except UnicodeDecodeError:
                plain.append("")
        sides = [pa.array(side.ids(plain), pa.list_(pa.int32())) for side in (self.a, self.b)]
        bad = np.array([not t for t in plain], bool)
        for side, lists in zip((self.a, self.b), sides):
            flat = pc.list_flatten(lists)
            raw = _data(pc.take(side.bytes, flat))
            stops = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(lists)).astype(np.int64))))
            ends = np.concatenate(([0], np.cumsum(np.asarray(pc.take(side.lens, flat)))))[stops]
            if ends[-1] != sum(len(t) + 1 for t in texts) or raw != b"".join([b" " + t for t in texts]):
                bad |= [raw[x:y] != b" " + t for x, y, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts)]
        if bad.any():
            sides = [pc.if_else(pa.array(bad), pa.scalar([], s.type), s) for s in sides]
            sides = [pa.concat_arrays([s]) for s in sides]
        return sides

    def links(self, lists_a, lists_b):
        """Table of links in order: doc, end, a, b (ids), pa, pb (positions of the tokens), shared (both tokens end here)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        ids_a, doc_a, end_a = _ends(lists_a, self.a.lens)
        ids_b, doc_b, end_b = _ends(lists_b, self.b.lens)
        left = pa.table({"doc": doc_a, "end": end_a, "pa": pa.array(np.arange(len(ids_a)))})
        right = pa.table({"doc": doc_b, "end": end_b, "pb": pa.array(np.arange(len(ids_b)))})
        both = left.join(right, ["doc", "end"], join_type="full outer", use_threads=False).combine_chunks()
        both = both.take(pc.sort_indices(both, [("doc", "ascending"), ("end", "ascending")]))
        shared = pc.and_(pc.is_valid(both["pa"]), pc.is_valid(both["pb"]))
        at_a, at_b = (pc.fill_null_backward(both[c].combine_chunks() if len(both) else pa.array([], pa.int64())) for c in ("pa", "pb"))
        return pa.table({"doc": both["doc"], "end": both["end"], "a": pc.take(ids_a, at_a), "b": pc.take(ids_b, at_b),
                         "pa": at_a, "pb": at_b, "shared": shared})

    def digests(self, lists_a, lists_b, links) -> list[str]:
        """sha256 of every document's groups, written ``a1,a2|b1;a3|b2,b3`` in decimal ids."""
        from hashlib import sha256

        import pyarrow as pa
        import pyarrow.compute as pc

        na, nb = (np.asarray(pc.list_value_length(x)).astype(np.int64) for x in (lists_a, lists_b))
        cut = links.filter(links["shared"])
        last_a, last_b = np.asarray(cut["pa"]), np.asarray(cut["pb"])  # of every group
        ids_a, ids_b = (np.asarray(pc.list_flatten(x)).astype(np.int64) for x in (lists_a, lists_b))
        group_a = np.searchsorted(last_a, np.arange(len(ids_a)))
        group_b = np.searchsorted(last_b, np.arange(len(ids_b)))
        form_a, form_b = ids_a.copy(), ids_b + len(self.a.digits)
        form_a[last_a] += self.a.n
        form_b[last_b] += self.b.n
        form_b[np.cumsum(nb)[nb > 0] - 1] += self.b.n
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + np.concatenate(([0], last_b + 1))[group_a]] = form_a
        order[np.arange(len(ids_b)) + (last_a + 1)[group_b]] = form_b
        forms = pc.take(pa.concat_arrays([self.a.digits, self.b.digits]), pa.array(order))
        data, offsets = _data(forms), np.frombuffer(forms.buffers()[1], np.int32)[:len(forms) + 1]
        ends = np.concatenate(([0], np.cumsum(na + nb)))
        return [sha256(data[offsets[x]:offsets[y]]).hexdigest() if y > x else "" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


SHAPE = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
SPANS = "a_ids array<int>, b_ids array<int>, group_ends array<bigint>"


def _aligned(docs: DataFrame, paths: tuple[str, str], id_col: str, text_col: str, spans: bool, block_bytes: int) -> DataFrame:
    """One row per block: its documents' shapes in order, its distinct pairs of ids with their counts, and its links as places among those pairs."""
    from pyspark.sql.types import ArrayType, LongType, StructField, StructType

    doc = StructType([StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL(SHAPE + (", " + SPANS if spans else "")).fields])
    schema = StructType([StructField("block", LongType()), StructField("docs", ArrayType(doc)),
                         *StructType.fromDDL("pairs binary, counts binary, links binary").fields])
    out = arrow_schema(schema)
    fields = out.field("docs").type.value_type

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        tool, base, k = None, TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def part(ids, texts):
            lists = tool.tokens(texts)
            links = tool.links(*lists)
            n = len(texts)
            per = np.bincount(np.asarray(links["doc"]), minlength=n), np.bincount(np.asarray(links["doc"].filter(links["shared"])), minlength=n)
            columns = [ids, *(pc.cast(pc.list_value_length(x), "int64") for x in lists), pa.array(per[1].astype(np.int64)), pa.array(per[0].astype(np.int64)),
                       pa.array(tool.digests(*lists, links), pa.string())]
            if spans:
                stops = np.concatenate(([0], np.cumsum(per[1]))).astype(np.int32)
                columns += [*lists, pa.ListArray.from_arrays(pa.array(stops), links["end"].filter(links["shared"]).combine_chunks())]
            pair = (np.asarray(links["a"]).astype(np.int64) << B_BITS) | np.asarray(links["b"])
            return pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(columns, fields)], fields=list(fields)), pair

        def block():
            pair = np.concatenate([h[1] for h in held])
            table = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by("pair")
            pairs = np.asarray(table["pair"])
            rows = pa.concat_arrays([h[0] for h in held])
            whole = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            blobs = (squeeze(np.diff(pairs, prepend=0)), squeeze(np.asarray(table["pair_count"])), squeeze(np.searchsorted(pairs, pair).astype(np.uint32)))
            return pa.RecordBatch.from_arrays([pa.array([base + k], pa.int64()), whole.cast(out.field("docs").type),
                                               *(pa.array([b], pa.binary()) for b in blobs)], schema=out)

        for batch in batches:
            tool = tool or Aligner(*paths)
            lo, texts, got = 0, [], 0
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py())
                got += len(texts[-1])
                if got >= BATCH_BYTES or i == batch.num_rows - 1:
                    held.append(part(batch.column(0).slice(lo, len(texts)), texts))
                    size += got
                    lo, texts, got = i + 1, [], 0
                    if size >= block_bytes:
                        yield block()
                        held, size, k = [], 0, k + 1
        if held:
            yield block()

    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(F.col(f"`{text_col}`")).alias("text"))
    return written(src.mapInArrow(run, schema), "alignments")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold a pair of ids, and whether no pair with its B id is held by more."""
    def partial(batches):
        import pyarrow as pa

        def rows(tables):
            merged = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return merged.select(["pair", "n_sum"]).rename_columns(["pair", "n"]).combine_chunks()

        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(pa.table({"pair": np.cumsum(spread(batch.column(0)[i].as_py(), np.int64)), "n": spread(batch.column(1)[i].as_py(), np.int64)}))
                size += len(held[-1])
                if size > 1 << 21:
                    held = [rows(held)]
                    size = 0 if len(held[0]) < 1 << 20 else size
                    if size:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from rows(held).to_batches()

    counts = written(blocks.select("pairs", "counts").mapInArrow(partial, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    b = F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b")
    best = counts.groupBy(b).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", spans: bool = True,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``, and with
    ``spans`` the ids of both sides and the byte offsets (of space and text) at which groups end.

    Texts that are null, empty or not valid UTF-8, and those that either side
    does not give back byte by byte, have no tokens: zeros, an empty digest.
    Repeated rows count each time.  Other columns are ignored; an empty table
    gives no rows.  A text is tokenized whole.
    """
    blocks = _aligned(docs, paths or default_paths(), id_col, text_col, spans, block_bytes)

    def pairs(batches):
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                p = np.cumsum(spread(batch.column(1)[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), batch.column(0)[i].as_py(), np.int64)), pa.array(p)], names=["block", "pair"])

    asked = blocks.select("block", "pairs").mapInArrow(pairs, "block bigint, pair bigint")
    told = (asked.join(pair_counts(blocks), "pair").groupBy("block")
            .agg(F.sort_array(F.collect_list(F.struct("pair", "n", "best"))).alias("told")))  # no more than a block's own pairs
    from pyspark.sql.types import StructType
    doc = blocks.schema["docs"].dataType.elementType
    schema = StructType([*doc.fields, *StructType.fromDDL("n_best bigint, count_sum bigint").fields])
    out = arrow_schema(schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(0)[i].values
                links = spread(batch.column(1)[i].as_py(), np.uint32)
                sums = [np.zeros(1, np.int64)] * 2
                if len(links):
                    told = batch.column(2)[i].values
                    sums = [np.concatenate(([0], np.cumsum(np.asarray(told.field(c)).astype(np.int64)[links]))) for c in ("best", "n")]
                ends = np.concatenate(([0], np.cumsum(np.asarray(rows.field("n_links")))))
                added = [s[ends[1:]] - s[ends[:-1]] for s in sums]
                columns = [*rows.flatten(), *(pa.array(x) for x in added)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    joined = blocks.select("block", "docs", "links").join(told, "block", "left").select("docs", "links", "told")
    got = joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return got.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["a_ids", "b_ids", "group_ends"] if spans else []))


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    return align(read(spark, sf_dir, "documents"), spans=False)
