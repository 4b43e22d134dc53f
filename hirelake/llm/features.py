"""Sparse text features: hashed words and word beginnings, and their selection on labelled texts.

The hash space bounds everything that is collected: two counts for each
feature and class.  A fitted vocabulary maps at most ``most`` hashed features
to columns; words that touch none of them cost one dictionary lookup.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from hirelake.llm.blocks import arrow_of, batch_of, emitted, rows_of
from hirelake.llm.common import arrow_schema, text_bytes

BITS = 18
PREFIXES = (4, 5, 6)
STRIP = b".,;:!?\"'()[]{}<>|*%$&#@-_=+/\\~`^"


def word_features(word: bytes) -> list[int]:
    """Hashed features of one lower-cased word without the punctuation around it: the word, and its beginnings by bytes."""
    from zlib import crc32
    word = word.strip(STRIP)
    if not word:
        return []
    most = (1 << BITS) - 1
    return [crc32(word) & most, *[crc32(word[:n], n) & most for n in PREFIXES if len(word) > n]]


def labelled_sample(docs: DataFrame, labelled: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text bytes, label) of at most ``most`` labelled documents, those of least hashed id.

    ``labelled`` has (doc_id, label); null ids and labels are left out, and of
    repeated ids the least label counts.  The chosen ids are at most ``most``
    small rows, so they are broadcast.
    """
    one = (labelled.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("__llm_label_id"))
           .agg(F.min(label).alias("label")).orderBy(F.xxhash64("__llm_label_id"), "__llm_label_id").limit(most))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(F.col(f"`{text_col}`")).alias("text"))
    return rows.join(F.broadcast(one), F.col("id") == F.col("__llm_label_id")).select("id", "text", "label")


def class_counts(sample: DataFrame, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents of each class with each feature [2**BITS, classes], documents of each class)."""
    ddl = "feature int, label int, n bigint"
    out = arrow_of(ddl)

    def run(batches):
        held: dict[int, np.ndarray] = {}
        cache: dict[bytes, list[int]] = {}
        for _, text, label in rows_of(batches):
            counts = held.setdefault(label, np.zeros((1 << BITS) + 1, np.int64))
            got = set()
            for w in set(text.lower().split()):
                f = cache.get(w)
                if f is None:
                    f = cache[w] = word_features(w)
                    if len(cache) > 300_000:
                        cache.clear()
                got.update(f)
            counts[list(got)] += 1
            counts[-1] += 1
        for label, counts in held.items():
            at = np.flatnonzero(counts)
            for k in range(0, len(at), 50_000):
                yield batch_of(out, [(int(i), label, int(counts[i])) for i in at[k:k + 50_000]])

    counts = np.zeros(((1 << BITS) + 1, n_classes))
    for r in sample.mapInArrow(run, ddl).groupBy("feature", "label").agg(F.sum("n").alias("n")).collect():
        counts[r.feature, r.label] = r.n
    return counts[:-1], counts[-1]


def select_features(counts: np.ndarray, docs: np.ndarray, most: int, least: int = 3) -> np.ndarray:
    """The ``most`` features with the greatest chi-square against the classes; ties by number."""
    total = docs.sum()
    with_f = counts.sum(axis=1)
    if total == 0:
        return np.empty(0, np.int64)
    expected = with_f[:, None] * docs[None, :] / total
    missing = (total - with_f)[:, None] * docs[None, :] / total
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (np.nan_to_num((counts - expected) ** 2 / expected) + np.nan_to_num((expected - counts) ** 2 / missing)).sum(axis=1)
    chi[(with_f < least) | (chi < 10.83)] = 0  # 10.83: one in a thousand for one degree of freedom
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(best[chi[best] > 0])


class Featurizer:
    """Column numbers and values of whole texts for a fitted vocabulary."""

    def __init__(self, chosen: np.ndarray):
        self.column = {int(f): i for i, f in enumerate(chosen)}
        self.cache: dict[bytes, tuple | None] = {}

    def _learn(self, words: set) -> None:
        cache, column = self.cache, self.column
        for w in words:
            got = [column[f] for f in word_features(w) if f in column]
            cache[w] = tuple(set(got)) if got else None

    def __call__(self, text: bytes) -> tuple[list[int], list[float], int]:
        """(columns, 1 + log(count), number of words)."""
        from math import log
        words = text.lower().split()
        distinct = set(words)
        if len(self.cache) + len(distinct) > 600_000:
            self.cache.clear()
        self._learn(distinct.difference(self.cache))
        hits: dict[int, int] = {}
        for got in filter(None, map(self.cache.__getitem__, words)):
            for c in got:
                hits[c] = hits.get(c, 0) + 1
        return list(hits), [1 + log(n) for n in hits.values()], len(words)


def sample_matrix(sample: DataFrame, chosen: np.ndarray) -> tuple[list, list, list, list, list]:
    """(ids, labels, columns, values, word counts) of the sample's rows, ordered by id.

    Bounded by the sample: at most ``len(chosen)`` numbers a document, sent and held as packed arrays.
    """
    from pyspark.sql.types import StructType
    ddl = StructType([sample.schema["id"], *StructType.fromDDL("label int, columns binary, values binary, words bigint").fields])
    out = arrow_schema(ddl)

    def run(batches):
        feats = Featurizer(chosen)

        def rows():
            for i, text, label in rows_of(batches):
                c, v, n = feats(text)
                yield i, label, np.array(c, np.int32).tobytes(), np.array(v, float).tobytes(), n
        return emitted(rows(), out)

    rows = sample.mapInArrow(run, ddl).collect()
    rows.sort(key=lambda r: (r.id is None, r.id, r.label, r.words))
    return ([r.id for r in rows], [r.label for r in rows], [np.frombuffer(r["columns"], np.int32) for r in rows],
            [np.frombuffer(r["values"], float) for r in rows], [r.words for r in rows])


class Rows:
    """A small sparse matrix with the two products that fitting needs: sums of runs, by row and by column.

    It empties the lists that it is given, so that the sample is held once.
    """

    def __init__(self, columns: list, values: list, width: int):
        self.n, self.width = len(columns), width
        row = np.repeat(np.arange(self.n, dtype=np.int32), [len(c) for c in columns])
        col = np.concatenate([np.asarray(c, np.int32) for c in columns] or [np.empty(0, np.int32)])
        val = np.concatenate([np.asarray(v, float) for v in values] or [np.empty(0)])
        columns.clear(), values.clear()  # the caller's lists hold the same numbers again
        order = np.argsort(col, kind="stable").astype(np.int32)
        self.by_row = (*self._runs(row), col, val)
        self.by_col = (*self._runs(col[order]), row[order], val[order])

    @staticmethod
    def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first position, key) of each run of equal keys."""
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return first, keys[first]

    @staticmethod
    def _product(side: tuple, x: np.ndarray, size: int) -> np.ndarray:
        first, keys, other, val = side
        out = np.zeros(size)
        if len(first):
            out[keys] = np.add.reduceat(val * x[other], first)
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return self._product(self.by_row, w, self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return self._product(self.by_col, r, self.width)
