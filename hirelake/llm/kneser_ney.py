"""Operator 7, quality classifier: perplexity under a model of trusted text.

An interpolated modified Kneser-Ney model over byte 5-grams is counted on
trusted documents (labelled good and not toxic, training fold); count shards
are joined with the distinct grams of document blocks (see ``blocks``), which
gives every document's perplexity.  A document is kept when that lies between
two quantiles of the held-out trusted documents of its language.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from hirelake.llm import bytegrams as bg
from hirelake.llm.blocks import flagged, ngram_scores, pack
from hirelake.llm.common import crc_mod, read, written

DEPTH = 4


def continuation_sums(depth: int):
    """Per shard: for each two-symbol gram the distinct symbols before it, and
    the counts of counts (key -10 * order - j) of the orders it holds whole."""
    def summary(grams, counts):
        seen = counts > 0
        levels = bg.kn_levels(grams[seen], counts[seen].astype(np.float64), depth, 2)
        tri = levels[0]["keys"] if len(levels[0]["keys"]) else np.empty(0, np.uint64)
        k, v = bg.summed(tri & bg.mask(2), np.ones(len(tri)))
        keys, values = list(k), list(v)
        for o, lv in enumerate(levels, start=2):
            keys += [-10 * o - j for j in (1, 2, 3, 4)]
            values += list(bg.count_of_counts(lv["counts"]))
        return keys, values
    return summary


def kn_shard(depth: int):
    def build(grams, counts, sums):
        seen = counts > 0
        k = np.array(sorted(x for x in sums if x >= 0 and sums[x] > 0), np.uint64)
        one = bg.level(k, np.array([sums[int(x)] for x in k]))
        zero = bg.level(*bg.summed(k & bg.mask(1), np.ones(len(k))))
        levels = [zero, one] + bg.kn_levels(grams[seen], counts[seen].astype(np.float64), depth, 2)
        d = [bg.kn_discounts(bg.count_of_counts(x["counts"])) for x in (zero, one)]
        d += [bg.kn_discounts(np.array([sums.get(-10 * o - j, 0) for j in (1, 2, 3, 4)])) for o in range(2, depth + 1)]
        return bg.kn_log10(levels, d, grams)
    return build


def packed_texts(docs: DataFrame, flag: Column, id_col: str, text_col: str) -> DataFrame:
    return pack(docs, id_col, text_col, flag, level=12, block_bytes=12 << 20)


def block_perplexities(packed: DataFrame, id_col: str, depth: int) -> DataFrame:
    """(id, ``flag``, ``n_bytes``, ``perplexity``) under a model of the blocks' flagged documents."""
    scores, _ = ngram_scores(packed, depth, continuation_sums(depth), kn_shard(depth))
    return scores.select(F.col("id").alias(id_col), "flag", "n_bytes",
                         F.pow(F.lit(10.0), -F.col("score") / (F.col("n_bytes") + 1)).alias("perplexity"))


def perplexities(docs: DataFrame, trusted: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """(id, ``flag``, ``n_bytes``, ``perplexity`` of a byte, end included) of every document."""
    return block_perplexities(packed_texts(docs, trusted, id_col, text_col), id_col, depth)


def quality(docs: DataFrame, labels: DataFrame, low: float = 0.002, high: float = 0.99, slack: float = 1.25, folds: int = 5,
            max_trusted: int | None = None, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang", depth: int = DEPTH) -> DataFrame:
    """One row per document row: id, lang, ``n_bytes``, ``perplexity``, ``low``, ``high``, ``keep``.

    Trusted: labels with quality 1 and toxic 0.  Fold 0 (crc32 of the id modulo
    ``folds``) of them, all of it, sets the quantiles ``low`` and ``high`` of its
    language; all the others train the model (with ``max_trusted``, those of
    least hashed id up to that number).  The band is widened by the factor ``slack`` on
    either side, so that clean documents just beyond a quantile (or beyond few
    held-out ones) stay.  A language without held-out trusted documents
    (null is a language of its own) uses the quantiles over all languages; with
    none at all every document is kept.  Null and empty texts are the end
    symbol alone.  Repeated rows are judged each; documents that share an id
    share trust.
    """
    good = (labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
            .select(F.col("doc_id").alias("__llm_good")).distinct())
    training = good.where(crc_mod("__llm_good", folds) != 0)
    if max_trusted is not None:
        training = training.orderBy(F.xxhash64("__llm_good"), "__llm_good").limit(max_trusted)
    # ids and languages ride together through the blocks as one key
    rows = docs.select(F.struct(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang")).alias("__llm_key"), F.col(text_col).alias("text"))
    # the texts are packed before the labels meet their ids, so no text is shuffled for that
    packed = flagged(packed_texts(rows, F.lit(False), "__llm_key", "text"), training, "doc_id")
    scored = written(block_perplexities(packed, "__llm_key", depth).select("__llm_key.*", "n_bytes", "perplexity"), "perplexity")
    # the texts are gone by now, so all held-out labels can be joined
    held = written(scored.where(crc_mod("doc_id", folds) == 0)
                   .join(good, F.col("doc_id") == F.col("__llm_good"), "left_semi").select("lang", "perplexity"), "held")
    cut = [F.percentile_approx("perplexity", q, 10000).alias(n) for q, n in ((low, "low"), (high, "high"))]
    own = held.groupBy(F.col("lang").alias("__llm_lang")).agg(*cut)
    every = held.agg(*cut).first()
    lo = F.coalesce(F.col("low"), F.lit(every["low"]).cast("double")) / slack
    hi = F.coalesce(F.col("high"), F.lit(every["high"]).cast("double")) * slack
    return (scored.join(own, F.col("lang").eqNullSafe(F.col("__llm_lang")), "left")
            .select("doc_id", "lang", "n_bytes", "perplexity", lo.alias("low"), hi.alias("high"),
                    F.coalesce(F.col("perplexity").between(lo, hi), F.lit(True)).alias("keep")))


def op7_kneser_ney(spark, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
