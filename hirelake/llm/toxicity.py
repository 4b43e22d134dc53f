"""Operator 9, toxicity: cumulative-link ordinal regression on sparse text features.

Severity grades are ordered; one weight vector is shared by all of them and the
thresholds between grades rise.  P(grade >= k) = sigmoid(x.w - threshold_k), and
the expected severity is the sum of these.  The labels say only toxic or not, so
the training grades 1 and up are quantile groups of how many words that mark
toxic documents a toxic document has.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from hirelake.llm.common import append_scores, private, read
from hirelake.llm.features import Featurizer, Rows, class_counts, labelled_sample, sample_matrix, select_features

GRADES = 3          # grade 0 and two grades of toxic documents
MOST_DOCS = 20_000  # labelled documents that the model is fitted on
MOST_FEATURES = 2048


def fit_cumulative_link(x: Rows, grade: np.ndarray, n_grades: int, l2: float = 1e-5, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """(weights, rising thresholds) by accelerated gradient descent on the
    log-likelihood.  Thresholds are a first one and positive gaps, so they stay ordered."""
    n = max(1, x.n)
    w = np.zeros(x.width)
    share = np.clip([(grade >= k).mean() if x.n else 0.5 for k in range(1, n_grades)], 1e-3, 1 - 1e-3)
    start = np.log((1 - np.array(share)) / np.array(share))
    p = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 1e-2))))
    mw, vw, mp, vp = np.zeros_like(w), np.zeros_like(w), np.zeros_like(p), np.zeros_like(p)
    k = np.arange(x.n)

    def sig(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for t in range(1, steps + 1):
        theta = np.concatenate(([p[0]], p[0] + np.cumsum(np.exp(p[1:]))))
        s = x.dot(w)
        above = np.column_stack([np.ones(x.n), *(sig(s - b) for b in theta), np.zeros(x.n)])  # P(grade >= k)
        slope = above * (1 - above)
        like = np.maximum(above[k, grade] - above[k, grade + 1], 1e-12)
        ds = (slope[k, grade] - slope[k, grade + 1]) / like / n
        dtheta = np.array([(((grade == j) * 1.0 - (grade == j + 1)) * slope[:, j + 1]).dot(1 / like) / n for j in range(n_grades - 1)])
        gw = -x.back(ds) + l2 * w
        gp = -np.concatenate(([dtheta.sum()], [np.exp(p[j]) * dtheta[j:].sum() for j in range(1, n_grades - 1)]))
        for g, v, m1, m2 in ((gw, w, mw, vw), (gp, p, mp, vp)):
            m1 *= 0.9
            m1 += 0.1 * g
            m2 *= 0.99
            m2 += 0.01 * g * g
            v -= 0.05 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-8)
    return w, np.concatenate(([p[0]], p[0] + np.cumsum(np.exp(p[1:]))))


def severity_grades(toxic: np.ndarray, columns: list, values: list, marks: np.ndarray, n_grades: int) -> np.ndarray:
    """Grade 0 for documents that are not toxic; the toxic ones by groups of
    about equal size by their number of marking words (ties stay together)."""
    found = np.array([np.round(np.exp(np.asarray(vs, float) - 1) @ marks[np.asarray(cs, int)]) for cs, vs in zip(columns, values)])
    if not (toxic == 1).any():
        return np.zeros(len(toxic), int)
    cuts = np.quantile(found[toxic == 1], np.arange(1, n_grades - 1) / (n_grades - 1))
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, found, side="left"), 0)


def train(docs: DataFrame, labels: DataFrame, n_grades: int = GRADES, most_docs: int = MOST_DOCS, most_features: int = MOST_FEATURES,
          id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The fitted model, from at most ``most_docs`` labelled whole documents.

    Without toxic (or without clean) labelled documents the model finds nothing toxic.
    """
    marked = labels.where("toxic in (0, 1)")
    sample = labelled_sample(docs, marked, "toxic", most_docs, id_col, text_col)
    counts, per_class = class_counts(sample, 2)
    chosen = select_features(counts, per_class, most_features)
    _, toxic, columns, values, _ = sample_matrix(sample, chosen)
    toxic = np.array(toxic, int)
    if len(chosen) == 0 or per_class.min() == 0:
        return {"chosen": np.empty(0, np.int64), "weights": np.empty(0), "thresholds": np.full(n_grades - 1, 40.0)}
    rate = counts[chosen] / per_class
    marks = rate[:, 1] > 20 * np.maximum(rate[:, 0], 0.5 / per_class[0])
    grade = severity_grades(toxic, columns, values, marks, n_grades)
    w, theta = fit_cumulative_link(Rows(columns, values, len(chosen)), grade, n_grades)
    return {"chosen": chosen, "weights": w, "thresholds": theta}


def scores(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None, into: str = "expected_severity") -> DataFrame:
    """The rows with the expected severity of their whole texts (0 to grades - 1)."""
    def make():
        feats = Featurizer(model["chosen"])
        weight, theta = model["weights"].tolist(), model["thresholds"]

        def score(texts):
            s = np.array([sum(weight[c] * v for c, v in zip(*feats(t)[:2])) for t in texts])
            z = np.clip(s[:, None] - theta[None, :], -40, 40)
            return {into: (1 / (1 + np.exp(-z))).sum(axis=1).tolist()}
        return score

    return append_scores(docs, text_col, f"{into} double", make, keep)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose expected severity is below ``threshold``.  Columns as
    given; null and empty texts stay; repeated rows are judged alike."""
    into = private(docs) + "severity"
    return scores(docs, train(docs, labels), into=into).where(F.col(into) < threshold).drop(into)


def op9_toxicity(spark, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = scores(docs, train(docs, read(spark, sf_dir, "labels")), keep=["doc_id"])
    return out.select("doc_id", "expected_severity", (F.col("expected_severity") >= threshold).alias("toxic"))
