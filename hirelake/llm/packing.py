"""Operator 5, packing: concatenate and cut.

Pass one tokenizes every whole document and writes its ids with its offset
inside the partition.  The partitions' token totals (one number each) are
summed up to global offsets.  Pass two cuts the concatenation into windows of
fixed length: no shuffle, one boundary record for every piece of a document,
in Spark's own functions, so that no batch of ids goes through Python again.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from hirelake.llm.common import arrow_schema, read, small_batches, text_bytes, written

LENGTH = 4096
END_ID = 2
#: Bytes of each of the two tables of words that a worker remembers with their ids (with about ENTRY more for each entry), and of a block of texts.
WORD_BYTES, ENTRY, BLOCK_BYTES = 18 << 20, 160, 4 << 20
TAIL = ".,;:!?*%$&#)"
#: Latin letters that are no matter to normalisation and have one lower-case letter.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+"
PLAIN = f"^{LETTERS}$"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable ones for
    themselves, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of whole texts for a lower-casing word BPE tokenizer, for which white
    space is a separator only.

    A text's ids are those of its space-separated parts, and of a block of
    texts only the different parts are looked at.  Those of plain Latin letters
    go to the BPE model in lower case, without the punctuation behind them; all
    others take the whole tokenizer.  What was asked lies in ``new`` and
    ``old``, of bounded size: when ``new`` is full it becomes ``old``, so words
    in use stay.
    """

    def __init__(self, path: str, end_id: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import pyarrow as pa
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.words = Tokenizer(self.tok.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(1 + max(vocab.values()), bool)  # ids that end a word
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.letters = byte_letters()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.end = pa.array([np.uint32(end_id).tobytes()], pa.binary())

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Of words of letters in lower case, which the model sees as byte-level letters; each gives one id that ends a word."""
        seen = [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in words]
        got = np.array(self.words.encode_batch_fast([" ".join(seen)], add_special_tokens=False)[0].ids, "<u4")
        at = 4 * (1 + np.flatnonzero(self.ends[got]))
        if len(at) != len(words):
            return [self._whole(w) for w in words]
        raw, at = got.tobytes(), at.tolist()
        return [raw[a:b] for a, b in zip([0, *at], at)]

    def _asked(self, keys: list[str], ask) -> list[bytes]:
        """``ask`` gives the ids of those that are not remembered."""
        new, old = self.new, self.old
        got = [new.get(k) or old.get(k) for k in keys]
        lost = [i for i, g in enumerate(got) if g is None]
        for lo in range(0, len(lost), 2000):
            some = lost[lo:lo + 2000]
            for i, g in zip(some, ask([keys[i] for i in some])):
                got[i] = g
        for k, g in zip(keys, got):
            if k not in self.new:
                if self.held > WORD_BYTES:
                    self.old, self.new, self.held = self.new, {}, 0
                self.new[k] = g
                self.held += len(k) + len(g) + ENTRY
        return got

    def _parts(self, parts):
        """Ids of different parts, and after them the end id."""
        import pyarrow as pa
        import pyarrow.compute as pc

        def each(keys, ask):
            coded = keys.dictionary_encode()
            return pa.array(self._asked(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), ask), pa.binary()).take(coded.indices)

        whole = lambda keys: map(self._whole, keys)
        cores = pc.ascii_rtrim(parts, characters=TAIL)
        plain = pc.match_substring_regex(cores, PLAIN)
        words, tailed = cores.filter(plain), parts.filter(plain)
        # the tokenizer starts a new piece where letters end
        tails = pc.replace_substring_regex(tailed, "^" + LETTERS, "")
        ids = pc.binary_join_element_wise(each(pc.utf8_lower(words), self._words), each(tails, whole), pa.scalar(b"", pa.binary()))
        others = each(parts.filter(pc.invert(plain)), whole)
        flags = plain.to_numpy(zero_copy_only=False)
        at = np.where(flags, np.cumsum(flags) - 1, len(ids) + np.cumsum(~flags) - 1)
        return pa.concat_arrays([pa.concat_arrays([ids, others]).take(pa.array(at)), self.end])

    def ids(self, texts):
        """Little-endian unsigned 32-bit ids of each text, end id included: binary array to binary array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        try:
            texts = texts.cast(pa.string())
        except pa.ArrowInvalid:
            texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        upto = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        at = np.insert(coded.indices.to_numpy(), upto, len(coded.dictionary))
        got = self._parts(coded.dictionary).take(pa.array(at))
        bounds = np.frombuffer(got.buffers()[1], np.int32)[np.r_[0, upto + 1 + np.arange(len(upto))]]
        return pa.Array.from_buffers(pa.binary(), len(upto), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), got.buffers()[2]])


#: The tokenizers that a Python worker has loaded; their bounded caches serve all of its tasks.
LOADED: dict[tuple[str, int], WordTokenizer] = {}


def loaded(path: str, end_id: int) -> WordTokenizer:
    if (path, end_id) not in LOADED:
        LOADED.clear()
        LOADED[path, end_id] = WordTokenizer(path, end_id)
    return LOADED[path, end_id]


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, before, ids): ids of every document, ``before`` counts the tokens before it in its partition."""
    from pyspark.sql.types import StructField, StructType

    schema = StructType([StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL("part int, before bigint, n bigint, ids binary").fields])
    out = arrow_schema(schema)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        tok, part, before = None, TaskContext.get().partitionId(), 0
        for batch in batches:
            tok = tok or loaded(tokenizer, end_id)
            lo, size = 0, 0
            for i, more in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                size += more
                if size > BLOCK_BYTES or i == batch.num_rows - 1:
                    rows = batch.slice(lo, i + 1 - lo)
                    ids = tok.ids(rows.column(1))
                    n = pc.binary_length(ids).to_numpy().astype(np.int64) // 4
                    ends = before + np.cumsum(n)
                    yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n), pa.array(n), ids], schema=out)
                    lo, size, before = i + 1, 0, int(ends[-1])

    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(F.col(f"`{text_col}`")).alias("text"))
    with small_batches(docs.sparkSession):
        return written(src.mapInArrow(run, schema), "tokens")


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids`` (little-endian
    unsigned 32-bit, if ``with_ids``), ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    Only the last sequence of all is shorter than ``length``.  Null and empty
    texts are the end id alone; repeated rows are packed each; a long document
    is cut into as many pieces as it needs; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    tokens = tokenized(docs, tokenizer or default_tokenizer(), end_id, id_col, text_col)
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    base, at = [], 0
    for r in sorted(totals.collect()):  # two numbers for each input partition
        base.append((r.part, at))
        at += r.total
    size = F.lit(length)
    first, last = F.col("at"), F.col("at") + F.col("n") - 1
    start = F.greatest(F.col("sequence_id") * size - F.col("at"), F.lit(0))
    end = F.least((F.col("sequence_id") + 1) * size - F.col("at"), F.col("n"))
    piece = F.substring("ids", (4 * F.col("start") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    return (tokens.join(F.broadcast(spark.createDataFrame(base, "part int, base bigint")), "part")
            .select("id", "n", "ids", (F.col("base") + F.col("before")).alias("at"))
            .select("*", F.explode(F.sequence(F.call_function("div", first, size), F.call_function("div", last, size))).alias("sequence_id"))
            .select("*", start.alias("start"), (end - start).alias("length"))
            .select(F.col("id").alias(id_col), "start", "length", *([piece.alias("ids")] if with_ids else []), F.crc32(piece).alias("ids_crc32"),
                    F.col("n").alias("doc_tokens"), "sequence_id", (F.col("at") + F.col("start") - F.col("sequence_id") * size).alias("offset")))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), with_ids=False)
