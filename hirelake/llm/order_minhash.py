"""Operator 6, document fingerprints: order MinHash.

The k-mers of a text are its runs of five words.  Repeated k-mers are numbered
by occurrence, each numbered k-mer is hashed, and the top bits of the hash pick
one of 64 bins.  The two least numbered k-mers of a bin, put back into text
order, are hashed to its slot.  Texts that share words in another order
therefore share few slots.  DataFrame functions only.

A numbered k-mer is one long: 40 bits of hash, 24 of position (positions from
2**24 - 1 on are alike).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hirelake.llm.common import read, written

K = 5            # words of a k-mer
BINS_LOG2 = 6    # 64 slots
WORD_BREAK = r"[ \t\n\x0B\f\r]+"


def with_slots(df: DataFrame, text_col: str, into: str, k: int = K) -> DataFrame:
    """Add ``into``: the text's slots (array<int>, one for each bin that is not
    empty: 25 bits of hash, then the bin).  Without words it is empty; with
    fewer than ``k`` words the whole sequence is the only k-mer."""
    w, h, e, s = (f"__llm_{x}" for x in "whes")
    last = (1 << 24) - 1
    bin_of = lambda x: f"shiftright({x}, {64 - BINS_LOG2})"
    keep = [f"`{c}`" for c in df.columns]
    words = F.filter(F.split(F.col(text_col), WORD_BREAK), lambda x: x != "")
    df = df.withColumn(w, F.when(F.trim(F.col(text_col)) == "", F.array().cast("array<string>")).otherwise(words))
    kmer = ", ".join(f"{w}[i + {j}]" for j in range(k))
    df = df.withColumn(h, F.expr(
        f"CASE WHEN size({w}) = 0 THEN cast(array() AS array<bigint>) WHEN size({w}) <= {k} THEN array(xxhash64({w})) "
        f"ELSE transform(sequence(0, size({w}) - {k}), i -> xxhash64({kmer})) END"))
    df = df.selectExpr(*keep, h, f"sort_array(transform({h}, (x, i) -> (x & ~{last}L) | least(i, {last}))) AS {e}")
    # number the occurrences where a k-mer repeats: equal hashes are neighbours, in text order
    runs = f"filter(sequence(0, size({e}) - 1), j -> j = 0 OR shiftright({e}[j], 24) != shiftright({e}[j - 1], 24))"
    df = df.selectExpr(*keep, e, f"CASE WHEN size(array_distinct({h})) < size({h}) THEN {runs} END AS {s}")
    renumbered = (f"transform(sequence(x, coalesce(get({s}, r + 1), size({e})) - 1), j -> CASE WHEN j = x THEN {e}[j] "
                  f"ELSE (xxhash64(shiftright({e}[j], 24), j - x) & ~{last}L) | ({e}[j] & {last}L) END)")
    df = df.selectExpr(*keep, f"CASE WHEN {s} IS NULL THEN {e} ELSE sort_array(flatten(transform({s}, (x, r) -> {renumbered}))) END AS {e}")
    # the two least of every bin are those with another bin two places before
    df = df.selectExpr(*keep, f"filter({e}, (x, j) -> j < 2 OR {bin_of('x')} != {bin_of(f'{e}[j - 2]')}) AS {s}")
    nxt = f"get({s}, j + 1)"
    alone = f"({nxt} IS NULL OR {bin_of(nxt)} != {bin_of('x')})"
    tup = (f"CASE WHEN {alone} THEN xxhash64(shiftright(x, 24)) "
           f"WHEN (x & {last}L) <= ({nxt} & {last}L) THEN xxhash64(shiftright(x, 24), shiftright({nxt}, 24)) "
           f"ELSE xxhash64(shiftright({nxt}, 24), shiftright(x, 24)) END")
    slot = f"cast(((({tup}) & {(1 << 25) - 1}L) * {1 << BINS_LOG2} + ({bin_of('x')} & {(1 << BINS_LOG2) - 1}L)) AS int)"
    first = f"(j = 0 OR {bin_of('x')} != {bin_of(f'{s}[j - 1]')})"
    return df.selectExpr(*keep, f"filter(transform({s}, (x, j) -> CASE WHEN {first} THEN {slot} END), x -> x IS NOT NULL) AS `{into}`")


def likeness(a: str, b: str) -> Column:
    """Equal slots over bins that either fingerprint fills; 1 if both are empty."""
    bins = f"size(array_distinct(transform(concat({a}, {b}), x -> x & {(1 << BINS_LOG2) - 1})))"
    return F.expr(f"CASE WHEN size({a}) + size({b}) = 0 THEN 1.0D ELSE size(array_intersect({a}, {b})) / {bins} END")


def as_text(slots: str) -> Column:
    return F.expr(f"lower(array_join(transform({slots}, x -> lpad(hex(x), 8, '0')), ''))")


def successors(keys: DataFrame) -> DataFrame:
    """(k, half, next_k) of rows (id, k, half): the next key by descending id
    (then key), after the last the first.

    Rows are dealt to ranges of ids; inside a range the next row is one step
    away, and the ends of the ranges (one row for each) are linked apart.
    """
    ranged = written(keys.repartitionByRange(F.col("id").desc_nulls_last(), F.col("k")).withColumn("part", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("part").orderBy(F.col("id").desc_nulls_last(), F.col("k"))
    inside = ranged.select("k", "half", "part", F.lead("k").over(w).alias("next_k"), F.row_number().over(w).alias("rank"))
    inside = written(inside, "ranked")
    heads = inside.where("rank = 1").select("part", F.col("k").alias("head"))
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(whole)).alias("head"))
    return inside.join(heads, "part").select("k", "half", F.coalesce("next_k", "head").alias("next_k"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """One row per document row: id, ``n_chars``, ``edited_sha256``,
    ``fingerprint`` and ``edited_fingerprint`` (hex, 8 digits a slot),
    ``near_edited``, ``near_next``, ``next_id`` (id of the next document).

    The edited text has the last half of the code points (rounded down)
    replaced by as many of the first of the next document, or all it has.
    Documents follow each other by descending id, then by a digest of id and
    text; null ids come last.  Rows with equal id and text are one document in
    that order and each get its result.  A single document follows itself.
    Null counts as empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"),
                       F.unhex(F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.lit(":"), text).cast("binary"))).alias("k"))
    keys = base.select("id", "k", F.floor(F.length("text") / 2).cast("int").alias("half")).distinct()
    order = written(successors(keys), "order")
    back = order.select(F.col("next_k").alias("k"), F.col("k").alias("to_k"), "half")
    once = F.row_number().over(Window.partitionBy("k", "to_k").orderBy("k")).alias("rank")
    # both joins read the documents by the same exchange, so texts move once
    lent = (base.join(back, "k").select("k", "to_k", F.substring(F.col("text"), F.lit(1), F.col("half")).alias("lent"), "half",
                                        F.col("id").alias("next_id"), once).where("rank = 1")
            .select(F.col("to_k").alias("k"), F.col("k").alias("next_k"), "lent", "half", "next_id"))
    n = F.length("text")
    both = base.join(lent, "k").select(
        "id", "k", "next_k", "next_id", n.cast("bigint").alias("n_chars"), "text",
        F.concat(F.substring(F.col("text"), F.lit(1), n - F.col("half")), F.col("lent")).alias("edited"))
    both = both.withColumn("edited_sha256", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    made = with_slots(with_slots(both, "text", "slots", k).drop("text"), "edited", "edited_slots", k).drop("edited")
    made = written(made, "slots")
    after = made.select(F.col("k").alias("next_k"), F.col("slots").alias("next_slots")).dropDuplicates(["next_k"])
    return made.join(after, "next_k").select(
        F.col("id").alias(id_col), "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), as_text("slots").alias("fingerprint"),
        as_text("edited_slots").alias("edited_fingerprint"), likeness("slots", "edited_slots").alias("near_edited"),
        likeness("slots", "next_slots").alias("near_next"), "next_id")


def op6_order_minhash(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read(spark, sf_dir, "documents"))
