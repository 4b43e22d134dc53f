"""Operator 4, language identification: prediction by partial matching.

Each language has a byte-context tree of depth 3 counted on whole labelled
documents.  A text's exact code length under every tree (escape probabilities,
symbol exclusion, statistics frozen) decides; the shortest code wins.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from hirelake.llm import bytegrams as bg
from hirelake.llm.blocks import arrow_of, batch_of, rows_of, spread, squeeze
from hirelake.llm.common import append_scores, crc_mod, read, text_bytes

DEPTH = 3
UNDETERMINED = "und"
SALTS = 64
BLOCK_BYTES = 3 << 20  # of texts that are counted or scored at once


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          depth: int = DEPTH, max_docs: int = 2000, max_bytes: int = 8 << 20) -> dict[str, list[dict]]:
    """A tree per language, from at most ``max_docs`` whole documents and
    ``max_bytes`` bytes of each (those of least hashed id come first; of each
    of ``SALTS`` parts of the ids at most four times its share).  Documents of
    over four times ``max_bytes / max_docs`` come last, the shortest first, so
    that none of them ends a sample that others would fill; a language's
    shortest document is taken whatever its size."""
    sizes = (docs.where(usable & F.col(lang_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.octet_length(text_bytes(text_col)).alias("size")))
    order = [F.greatest("size", F.lit(4 * max_bytes // max_docs)), F.xxhash64("id", "size"), F.col("id")]
    # a salt splits a language, and few rows of a part move on: so few that Spark cuts in every task before rows meet
    part = Window.partitionBy("lang", "salt").orderBy(*order)
    few = (sizes.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).withColumn("k", F.row_number().over(part))
           .where(F.col("k") <= min(-(-4 * max_docs // SALTS), 1000)).drop("k", "salt"))
    few = (few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("k") <= max_docs))
    few = (few.withColumn("sum", F.sum("size").over(Window.partitionBy("lang").orderBy("k")))
           .where((F.col("sum") <= max_bytes) | (F.col("k") == 1)).select("id", "lang").distinct())
    ddl = "lang string, a binary, b binary"
    out = arrow_of(ddl)

    def count(batches):
        held, size = {}, 0

        def flush():
            for lang, texts in held.items():
                uniq, starts, d = bg.spans(bg.doc_grams(texts, depth))
                yield batch_of(out, [(lang, squeeze(uniq), squeeze(np.diff(np.append(starts, len(d)))))])
            held.clear()

        for lang, text in rows_of(batches):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size > BLOCK_BYTES or len(held[lang]) >= bg.MAX_DOCS:
                yield from flush()
                size = 0
        yield from flush()

    texts = docs.where(usable).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text_bytes(text_col).alias("t"))
    picked = texts.join(F.broadcast(few), ["id", "lang"], "left_semi").select("lang", "t")
    trees: dict[str, tuple[list, list]] = {}
    for r in picked.mapInArrow(count, ddl).toLocalIterator():
        got = trees.setdefault(r.lang, ([], []))
        got[0].append(spread(r.a, np.uint64))
        got[1].append(spread(r.b, np.int64))
    made = {}
    for lang in sorted(trees):
        k, c = bg.summed(np.concatenate(trees[lang][0]), np.concatenate(trees[lang][1]))
        made[lang] = bg.ppm_tree(bg.levels_from(k, c.astype(np.float64), range(depth + 1)))
    return made


def code_lengths(texts: list[bytes], trees: dict[str, list[dict]], depth: int) -> np.ndarray:
    """Code length in bits of every text (rows) under every tree (columns)."""
    uniq, starts, d = bg.spans(bg.doc_grams(texts, depth))
    got = np.empty((len(texts), len(trees)))
    for j, tree in enumerate(trees.values()):
        got[:, j] = bg.sums_by_doc(-np.log2(10) * bg.ppm_log10(tree, uniq), starts, d, len(texts))
    return got


def identify(docs: DataFrame, trees: dict[str, list[dict]], text_col: str = "text", depth: int = DEPTH,
             keep: list[str] | None = None) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``.

    ``score`` is the posterior of the shortest code with equal priors.  Ties go
    to the first language by name.  Null texts, texts without a letter, and all
    texts when there is no tree, are ``und`` with score 0.  Other columns pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def make():
        import regex
        letter = regex.compile(r"\p{L}")

        def score(texts):
            names = list(shared.value)
            spoken = [letter.search(t.decode("utf-8", "replace")) is not None for t in texts]
            pred, sure = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if names:
                for a in range(0, len(texts), bg.MAX_DOCS):
                    bits = code_lengths(texts[a:a + bg.MAX_DOCS], shared.value, depth)
                    best = bits.argmin(axis=1)
                    odds = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
                    for i, (b, o) in enumerate(zip(best.tolist(), odds.tolist()), start=a):
                        if spoken[i]:
                            pred[i], sure[i] = names[b], o
            return {"lang_pred": pred, "score": sure}
        return score

    return append_scores(docs, text_col, "lang_pred string, score double", make, keep, BLOCK_BYTES)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    trees = train(docs, crc_mod("doc_id", 5) != 0)
    return identify(docs, trees, keep=["doc_id"]).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
