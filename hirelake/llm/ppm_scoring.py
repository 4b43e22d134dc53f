"""Operator 8, LM scoring: prediction by partial matching over bytes.

A byte-context tree of depth 5 is counted over the training documents.  Each
symbol is coded from its longest seen context; an escape (half a count of each
distinct symbol) leads to the next shorter one, from which the symbols of the
longer one are excluded.  The code is a proper distribution over
texts, end included.  The tree's shards are joined with the distinct grams of
document blocks (see ``blocks``).
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from hirelake.llm import bytegrams as bg
from hirelake.llm.blocks import ngram_scores, pack
from hirelake.llm.common import crc_mod, read

DEPTH = 5


def bigram_sums(grams: np.ndarray, counts: np.ndarray):
    """What a shard adds to the two-symbol counts, from which orders 0 and 1 are made."""
    return bg.summed(grams & bg.mask(2), counts.astype(np.float64))


def short_orders(sums: dict) -> list[dict]:
    k = np.array(sorted(x for x in sums if x >= 0 and sums[x] > 0), np.uint64)
    c = np.array([sums[int(x)] for x in k])
    return bg.levels_from(k, c, range(0, 2))


def ppm_shard(depth: int):
    def build(grams, counts, sums):
        seen = counts > 0
        tree = short_orders(sums) + bg.levels_from(grams[seen], counts[seen].astype(np.float64), range(2, depth + 1))
        return bg.ppm_log10(bg.ppm_tree(tree), grams)
    return build


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per document: id, ``train`` (whether the tree learned from it),
    ``n_bytes``, ``code_bits`` (whole code length), ``score`` (log10 probability
    of the lower-cased text), ``n_tokens``, ``n_known``, ``train_tokens`` and
    ``base_score`` (smoothed word counts, for comparison).

    Null and empty texts are the end symbol alone.  Repeated rows are scored
    (and counted) each.  Without training documents all symbols are equally
    likely.  An empty table gives an empty result.
    """
    packed = pack(docs, id_col, text_col, train)
    n_train = packed.agg(F.coalesce(F.sum("n_flagged"), F.lit(0))).first()[0]
    scores, sums = ngram_scores(packed, depth, bigram_sums, ppm_shard(depth), words=True)
    total = int(sums.get(-1000, 0)) + n_train           # tokens, each end included
    distinct = int(sums.get(-1001, 0)) + (n_train > 0)
    end = float(np.log10(n_train + 0.1))
    n_tokens = F.col("n_words") + 1
    return scores.select(
        F.col("id").alias(id_col), F.col("flag").alias("train"), "n_bytes", (-F.col("score") * float(np.log2(10))).alias("code_bits"),
        "score", n_tokens.alias("n_tokens"), (F.col("n_known") + int(n_train > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("word_sum") + end - n_tokens * float(np.log10(total + 0.1 * (distinct + 1)))).alias("base_score"))


def op8_ppm_scoring(spark, sf_dir: str) -> DataFrame:
    got = score_documents(read(spark, sf_dir, "documents"), crc_mod("doc_id", 10) != 0)
    return got.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
