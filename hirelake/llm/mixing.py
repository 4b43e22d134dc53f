"""Operator 1, mixing sources to target weights by soft membership.

A softmax classifier trained on a labelled table gives every document
posteriors over domains.  Nonnegative rates, one a document, are fitted by
projected-gradient least squares so that the expected domain token totals meet
the targets; a small term keeps rates near one.  The table of posteriors stays
distributed: an iteration sums vectors of domain totals, and the driver keeps
one vector, from which any task can replay a document's rate.  The fixed point
of the projected gradient is reached by Newton steps in that vector, not by one
gradient step a pass over the members.
"""
from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from hirelake.llm.blocks import arrow_of, batch_of
from hirelake.llm.common import append_scores, private, read, written
from hirelake.llm.features import Featurizer, Rows, class_counts, labelled_sample, sample_matrix, select_features

MOST_DOCS = 20_000
MOST_FEATURES = 2048
OFF_TARGET = 0.01
LENGTHS = (1.0, 0.5, 0.2, 0.05, 0.01, 0.001)


def fit_softmax(x: Rows, label: np.ndarray, n: int, l2: float = 1e-3, steps: int = 200) -> np.ndarray:
    """(features + 1) x classes weights, bias last."""
    w = np.zeros((x.width + 1, n))
    m, v = np.zeros_like(w), np.zeros_like(w)
    want = np.eye(n)[label]
    for t in range(1, steps + 1):
        s = np.column_stack([x.dot(w[:-1, j]) + w[-1, j] for j in range(n)])
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        r = (p - want) / max(1, x.n)
        g = np.vstack([np.column_stack([x.back(r[:, j]) for j in range(n)]), r.sum(axis=0)])
        g[:-1] += l2 * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def train_domains(docs: DataFrame, labelled: DataFrame, most_docs: int = MOST_DOCS, most_features: int = MOST_FEATURES,
                  id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The domain classifier, from at most ``most_docs`` documents of
    ``labelled`` (doc_id, domain).  Without labelled documents it knows no domain."""
    names = [r[0] for r in labelled.select("domain").where("domain is not null").distinct().orderBy("domain").collect()]
    number = F.create_map(*[F.lit(x) for kv in zip(names, range(len(names))) for x in kv]) if names else None
    if not names:
        return {"names": [], "chosen": np.empty(0, np.int64), "weights": np.zeros((1, 0))}
    coded = labelled.where("domain is not null").select("doc_id", F.element_at(number, F.col("domain")).alias("label"))
    sample = labelled_sample(docs, coded, "label", most_docs, id_col, text_col)
    counts, per_class = class_counts(sample, len(names))
    chosen = select_features(counts, per_class, most_features)
    _, label, columns, values, _ = sample_matrix(sample, chosen)
    w = fit_softmax(Rows(columns, values, len(chosen)), np.array(label, int), len(names))
    return {"names": names, "chosen": chosen, "weights": w}


def posteriors(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The rows with ``tokens`` (white-space words) and ``posterior`` (one number a domain, summing to 1)."""
    def make():
        feats, w = Featurizer(model["chosen"]), model["weights"]

        def score(texts):
            tokens, post = [], []
            for t in texts:
                c, v, n = feats(t)
                s = w[-1] + np.array(v) @ w[c] if c else w[-1]
                p = np.exp(s - s.max()) if len(s) else s
                tokens.append(n)
                post.append((p / p.sum()).tolist() if len(s) else [])
            return {prefix + "tokens": tokens, prefix + "posterior": post}
        return score

    return append_scores(docs, text_col, f"{prefix}tokens bigint, {prefix}posterior array<double>", make, keep)


def replay(post: np.ndarray, pulls: list[np.ndarray], step: float, ridge: float, low: float, high: float) -> np.ndarray:
    """Rates after the given gradient steps from one, projected onto [low, high] each time."""
    r = np.ones(len(post))
    for pull in pulls:
        r = np.clip(r - step * (post @ pull + ridge * (r - 1)), low, high)
    return np.clip(r, low, high)


def fit_rates(members: DataFrame, targets: np.ndarray, scale: float = 1.0, ridge: float = 1e-3, low: float = 0.0, high: float = 1e9,
              steps: int = 100, tol: float = 1e-7, prefix: str = "", ratios: bool = False) -> tuple[list[np.ndarray], float, np.ndarray]:
    """(pulls, step, reached totals over N): minimise sum_k ((total_k - target_k) / N)^2 / have_k / 2
    + ridge / 2 sum_d (tokens_d / N) (rate_d - 1)^2.

    ``members`` has ``tokens`` and ``posterior``; target_k is ``scale`` * N *
    targets_k with N all tokens, have_k the share of domain k as given.
    Gradients use the token-weighted metric.  Where the projected gradient
    vanishes, the rates are one projected step from one along a pull, and that
    pull is the one which their own totals give.  So the steps are taken in
    the pull (Newton's, with the step lengths of ``LENGTHS`` tried in one pass
    over the members), until no rate has a projected gradient above ``tol``:
    that is at most the largest change of a pull.  It raises when that takes
    more than ``steps`` passes.  The one pull returned is for ``replay`` with
    the returned step.

    With ``ratios`` target_k is targets_k of the total reached, whatever that
    is, and domains without a target (0) count neither in it nor as a gap.  So
    with rates of at least one the targets are met by as many repetitions as
    they take.
    """
    k = len(targets)
    if k == 0:
        return [], 0.0, np.zeros(0)
    size = 1 + k + k * k

    def sums(rates, n_rates=1):
        """Per set of rates: the sums of tokens * (least of the Lagrangian), of the totals and of the moving members' squares."""
        ddl = "total double, " + ", ".join(f"m{i} double" for i in range(n_rates * size))
        out = arrow_of(ddl)

        def run(batches):
            acc = np.zeros(1 + n_rates * size)
            for batch in batches:
                n = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), float)
                p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(n), k)
                acc[0] += n.sum()
                for i, (value, r, moves) in enumerate(rates(p)):
                    at = acc[1 + i * size:1 + (i + 1) * size]
                    at[0] += n @ value
                    at[1:1 + k] += (n * r) @ p
                    at[1 + k:] += ((p * (n * moves)[:, None]).T @ p).ravel()
            yield batch_of(out, [tuple(acc.tolist())])

        got = (members.select(F.col(prefix + "tokens"), F.col(prefix + "posterior")).mapInArrow(run, ddl)
               .agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in ["total", *[f"m{i}" for i in range(n_rates * size)]]]).first())
        per = np.array(got[1:]).reshape(n_rates, size)
        return got[0], per[:, 0], per[:, 1:1 + k], per[:, 1 + k:].reshape(n_rates, k, k)

    def at_pulls(tried):
        def rates(p):
            for pull in tried:
                cost = p @ pull
                free = 1 - cost / ridge
                r = np.clip(free, low, high)
                yield r * cost + ridge / 2 * (r - 1) ** 2, r, (free > low) & (free < high)
        total, value, now, square = sums(rates, len(tried))
        return value / total, now / total, square / total

    total, _, have, gram = sums(lambda p: [(np.zeros(len(p)), np.ones(len(p)), np.ones(len(p)))])
    if total == 0:
        return [], 0.0, np.zeros(k)
    weight = 1 / np.maximum(have[0] / total, 1e-4)
    root = np.sqrt(weight)
    step = 1 / (np.linalg.eigvalsh(gram[0] / total * root[:, None] * root[None, :]).max() + ridge)
    want = np.zeros(k) if ratios else scale * targets
    # a gap is a sum of totals: of each its own, less the target's part of all that have one
    lean = np.diag(targets > 0) - np.outer(targets > 0, targets) if ratios else np.eye(k)
    pull, best = np.zeros(k), None
    tried = [pull]
    for _ in range(steps):
        value, now, square = at_pulls([lean @ x for x in tried])
        gaps = now @ lean - want
        # the dual value: the greater the better, and greatest at the solution
        dual = [v - x @ want - (x * x / weight).sum() / 2 for v, x in zip(value, tried)]
        i = int(np.argmax(dual))
        rest = [np.abs(weight * g - x).max() for g, x in zip(gaps, tried)]
        j = int(np.argmin(rest))
        if rest[j] <= tol:
            return [lean @ tried[j] / (ridge * step)], step, now[j]
        if best is None or dual[i] > best[0]:
            best, pull, reach = (dual[i], gaps[i], lean.T @ square[i] @ lean), tried[i], 1.0
        else:  # all lengths went too far
            reach *= LENGTHS[-1] / 2
        slope = best[1] - pull / weight
        move = np.linalg.solve(np.diag(1 / weight) + best[2] / ridge, slope)
        tried = [pull + reach * x * move for x in LENGTHS]
    raise RuntimeError(f"rates did not settle in {steps} passes: projected gradient {rest[j]:.2g}, tolerance {tol:.2g}")


def with_rates(members: DataFrame, pulls: list[np.ndarray], step: float, ridge: float, low: float, high: float, k: int,
               prefix: str = "") -> DataFrame:
    """The rows with the fitted ``rate`` of each."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    from hirelake.llm.common import arrow_schema
    schema = StructType([*members.schema.fields, StructField(prefix + "rate", DoubleType())])
    out = arrow_schema(schema)
    at = members.columns.index(prefix + "posterior")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            n = batch.num_rows
            p = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(n, k) if k else np.zeros((n, 0))
            r = replay(p, pulls, step, ridge, low, high)
            arrays = [c if c.type.equals(f.type) else c.cast(f.type) for c, f in zip(batch.columns, list(out))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(r)], schema=out)

    return members.mapInArrow(run, schema)


def quality_domains(labels: DataFrame) -> DataFrame:
    """The labelled table: (doc_id, domain) with domains ``clean``, ``low`` and ``toxic``."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


TARGETS = {"clean": 0.95, "low": 0.04, "toxic": 0.01}
RIDGE = 1e-3
#: Of rates that are at least one: so small that shares come within a thousandth of reachable targets.
RATIO_RIDGE = 1e-5


def target_vector(names: list[str], targets: dict[str, float]) -> np.ndarray:
    """Shares of the known domains, scaled to sum to 1 (equal if none has a target)."""
    t = np.array([targets.get(n, 0.0) for n in names])
    return t / t.sum() if t.sum() > 0 else np.full(len(names), 1 / max(1, len(names)))


def report(names: list[str], targets: np.ndarray, reached: np.ndarray) -> None:
    """Log the shares reached, as a warning when one is more than ``OFF_TARGET`` from its target."""
    if not reached.sum() > 0:
        return
    shares = reached / reached.sum()
    off = not np.abs(shares - targets).max() <= OFF_TARGET
    logging.getLogger(__name__).log(logging.WARNING if off else logging.INFO, "shares reached (target): %s",
                                    ", ".join(f"{n} {x:.4f} ({t:.4f})" for n, x, t in zip(names, shares, targets)))


def mixture(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, scale: float = 1.0, low: float = 0.0,
            high: float = 1e9, keep: list[str] | None = None, prefix: str = "", ratios: bool = False) -> tuple[DataFrame, dict, np.ndarray]:
    """The rows with ``tokens``, ``posterior`` and ``rate`` (input columns of these names are replaced); the classifier;
    the reached totals over all tokens.

    Null and empty texts have no tokens and get the rate that their prior
    posterior earns.  Repeated rows are members each.  Without labelled
    documents every rate is one.
    """
    model = train_domains(docs, labelled)
    keep = [c for c in (keep or docs.columns) if c.lower() != f"{prefix}rate"]
    members = written(posteriors(docs, model, keep=keep, prefix=prefix), "members")
    t = target_vector(model["names"], targets)
    ridge = RATIO_RIDGE if ratios else RIDGE
    pulls, step, reached = fit_rates(members, t, scale, ridge, low, high, prefix=prefix, ratios=ratios)
    report(model["names"], t, reached)
    return with_rates(members, pulls, step, ridge, low, high, len(t), prefix), model, reached


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, low: float = 1.0,
        high: float = 1e9, seed: int = 7, id_col: str = "doc_id") -> DataFrame:
    """The documents, each as often as its rate says: the whole part, and once
    more with the chance of the rest (decided by a hash of the id).  Columns as
    given.  With ``low`` at 1 or above no document is lost.

    The targets are shares of what comes out, among the domains that have one:
    wanted domains are repeated until the others have come down to theirs.
    Domains without a target stay, and the shares reached are logged."""
    name = private(docs)
    rated, _, _ = mixture(docs, labelled, targets, low=low, high=high, prefix=name, ratios=True)
    rate = F.col(name + "rate")
    chance = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    times = F.floor(rate + F.lit(1e-9)).cast("int") + (chance < rate - F.floor(rate + F.lit(1e-9))).cast("int")
    return (rated.withColumn(name + "times", times).where(F.col(name + "times") > 0)
            .withColumn(name + "copy", F.explode(F.sequence(F.lit(1), F.col(name + "times"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rated, model, _ = mixture(docs, quality_domains(read(spark, sf_dir, "labels")), keep=["doc_id"])
    names = model["names"]
    post = [F.col("posterior")[i].alias(f"p_{n}") for i, n in enumerate(names)]
    return rated.select("doc_id", "tokens", *post, "rate")
