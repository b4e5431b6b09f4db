"""Quality scores by positive-unlabelled learning.

Trusted good documents are the positives, web text without labels is the unlabelled sample; no
negative label is used. The class prior is estimated by the best-bin rule (the smallest ratio, over
score thresholds on held-out halves, of the unlabelled share to the positive share above the
threshold, with a confidence margin), and a linear model is fitted to the non-negative unbiased
risk: pi * R_P(+) + max(0, R_U(-) - pi * R_P(-)), stepping back whenever the bracket falls below
zero. The model is fitted in numpy on samples of at most ``Training.positives`` and
``Training.unlabelled`` documents chosen by a hash of the id; every document is scored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD

PAIR_BUCKETS = 512
N_FEATURES = 256 + PAIR_BUCKETS + 4


@dataclass(frozen=True)
class Training:
    positives: int = 4000             # documented bounds of the two samples
    unlabelled: int = 6000
    steps: int = 300
    rate: float = 0.05
    decay: float = 3e-3
    threshold: float = 0.3
    seed: int = 7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        # a plain sum: a matrix product would allocate a buffer in every worker for good
        z = (np.clip((x - self.mean) / self.scale, -8, 8) * self.weights).sum(axis=1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def features(text: str | None) -> np.ndarray:
    """Byte and hashed byte-pair frequencies (square roots) and four shape figures of a text."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    out[:256] = np.sqrt(np.bincount(raw, minlength=256) / len(raw))
    if len(raw) > 1:
        pairs = (raw[:-1].astype(np.uint32) * 2654435761 + raw[1:] * np.uint32(40503)) >> 7
        out[256:256 + PAIR_BUCKETS] = np.sqrt(
            np.bincount(pairs % PAIR_BUCKETS, minlength=PAIR_BUCKETS) / (len(raw) - 1))
    words = WORD.findall(text)
    if words:
        n = len(words)
        out[-4] = np.log1p(n) / 10
        out[-3] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
        out[-2] = len(set(words)) / n ** 0.8
        out[-1] = sum(map(len, words)) / n / 10
    return out


def feature_matrix(texts) -> np.ndarray:
    rows = [features(t if isinstance(t, str) else None) for t in texts]
    return np.stack(rows) if rows else np.zeros((0, N_FEATURES), dtype=np.float32)


def _sample(df: DataFrame, bound: int, seed: int) -> DataFrame:
    """At most ``bound`` rows of ``df(doc_id)``: those whose id hash falls below a share."""
    n = df.count()
    if n > bound:
        cut = int(0.97 * bound / n * (1 << 40))
        df = df.filter(F.shiftright(F.xxhash64("doc_id", F.lit(seed)), 24)
                       + F.lit(1 << 39) < F.lit(cut))
    return df.limit(bound)


def fit(docs: DataFrame, labels: DataFrame, training: Training | None = None) -> Model:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, quality)``; the caller leaves out what
    must not be learnt from. A document with any label row is not unlabelled. Rows with equal ids
    are one document with the smallest of their texts. Without positives or unlabelled documents the
    model is constant (score 0.5)."""
    t = training or Training()
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    pos = _sample(ids.join(marks.filter("quality = 1"), "doc_id", "left_semi"),
                  t.positives, t.seed)
    unl = _sample(ids.join(marks, "doc_id", "left_anti"), t.unlabelled, t.seed)
    # bounded by two parameters, so it may be broadcast and trained on in one task
    sample = (pos.withColumn("positive", F.lit(True))
              .unionByName(unl.withColumn("positive", F.lit(False))))

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series(list(feature_matrix(texts)))

    def train(frames):
        parts = [frame for frame in frames if len(frame)]
        if parts:
            # in id order: the fit does not depend on the partitioning
            rows = pd.concat(parts, ignore_index=True)
            rows = rows.sort_values("doc_id")
            x, mark = np.stack(rows["x"].to_list()), rows["positive"].to_numpy()
            yield pd.DataFrame({"model": [pickle.dumps(fit_matrix(x[mark], x[~mark], t))]})

    # one text for each sampled id, picked by the tasks that read it: a repeated id stays one row
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .join(F.broadcast(sample), "doc_id").groupBy("doc_id", "positive")
            .agg(F.min("text").alias("text"))
            .select("doc_id", "positive", vectors("text").alias("x")))
    made = rows.repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else constant()


def constant() -> Model:
    zero = np.zeros(N_FEATURES, dtype=np.float32)
    return Model(zero, 0.0, zero, zero + 1, 0.5)


def fit_matrix(x_pos: np.ndarray, x_unl: np.ndarray, t: Training) -> Model:
    if len(x_pos) < 4 or len(x_unl) < 4:
        return constant()
    n = len(x_pos) + len(x_unl)
    mean = (x_pos.sum(0) + x_unl.sum(0)) / n
    scale = np.sqrt((np.square(x_pos - mean).sum(0) + np.square(x_unl - mean).sum(0)) / n) + 1e-3
    mean, scale = mean.astype(np.float32), scale.astype(np.float32)
    p = np.clip((x_pos - mean) / scale, -8, 8).astype(np.float32)
    u = np.clip((x_unl - mean) / scale, -8, 8).astype(np.float32)
    # the prior needs scores of a positive-against-unlabelled model on rows it has not seen
    w, b = _descend(np.ascontiguousarray(p[::2]), np.ascontiguousarray(u[::2]), None, t)
    prior = best_bin_prior(p[1::2] @ w + b, u[1::2] @ w + b)
    w, b = _descend(p, u, prior, t)
    return Model(w, b, mean, scale, prior)


def best_bin_prior(z_pos: np.ndarray, z_unl: np.ndarray, delta: float = 0.1) -> float:
    """Estimated share of positives among the unlabelled."""
    cuts = np.sort(z_pos)
    share_pos = 1 - np.arange(len(cuts)) / len(cuts)
    share_unl = 1 - np.searchsorted(np.sort(z_unl), cuts) / len(z_unl)
    margin = (np.sqrt(np.log(4 / delta) / (2 * len(z_unl)))
              + np.sqrt(np.log(4 / delta) / (2 * len(z_pos))))
    best = np.argmin(share_unl / share_pos + margin / share_pos)
    return float(np.clip(share_unl[best] / share_pos[best], 0.05, 0.98))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(p: np.ndarray, u: np.ndarray, prior: float | None, t: Training):
    """Adam on the logistic loss; with a prior on the non-negative risk, else positives against
    unlabelled, both sides weighing the same."""
    w, b = np.zeros(p.shape[1], dtype=np.float32), 0.0
    m, v, late = (np.zeros(len(w) + 1) for _ in range(3))
    for step in range(1, t.steps + 1):
        zp, zu = p @ w + b, u @ w + b
        gp_plus = -_sigmoid(-zp) / len(zp)          # slope of the loss of "positive" on P
        gp_minus = _sigmoid(zp) / len(zp)           # of "negative" on P
        gu_minus = _sigmoid(zu) / len(zu)           # of "negative" on U
        if prior is None:
            cp, cu = gp_plus, gu_minus
        else:
            rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if rest >= 0:
                cp, cu = prior * gp_plus - prior * gp_minus, gu_minus
            else:                                   # undo the overfit of the negative part
                cp, cu = prior * gp_minus, -gu_minus
        g = np.append(p.T @ cp.astype(np.float32) + u.T @ cu.astype(np.float32) + t.decay * w,
                      cp.sum() + cu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = t.rate * (1 - 0.9 * step / t.steps)
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), b - move[-1]
        if 2 * step > t.steps:
            late += np.append(w, b)
    # the mean of the later steps: stepping back from a negative part makes single steps jump
    late /= t.steps - t.steps // 2
    return late[:-1].astype(np.float32), float(late[-1])


def score(docs: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    """``docs`` with the double column ``out``, each row scored on its whole text. Null and empty
    texts get the score of the empty text; repeated rows score alike; all other columns pass."""
    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(feature_matrix(texts)) if len(texts) else [], dtype=float)

    return docs.withColumn(out, scores(F.col(text).cast("string")))
