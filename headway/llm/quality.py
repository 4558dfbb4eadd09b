"""Quality classifier by positive-unlabelled learning.

A linear model over counts of characters, words and lines minimises the
non-negative unbiased risk: with class prior p,

    p * E_pos[loss(f, +1)] + max(0, E_unl[loss(f, -1)] - p * E_pos[loss(f, -1)])

so only trusted positives (label 1) and unlabelled texts are learnt from, no
label 0. The prior is estimated first: a model of positives against unlabelled texts is fitted,
and p is the least ratio of unlabelled to positive texts above a threshold,
as texts above it that are not positive can only raise that ratio.

The model is fitted on at most ``sample`` positives and ``sample`` unlabelled rows, those with
the smallest hashes of id and text; the driver holds their features, those of equal rows once. Then all texts are scored
whole in one pass without a shuffle.

Nulls and ties: NULL text is empty; empty texts have features and a score too. A NULL
label is no label; a doc_id with several labels is positive if one of them is. A
NULL doc_id is unlabelled training data. Rows are scored one by one. No positives
to learn from: every score is 0.5. Empty table: no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.class_lm import remainder
from headway.llm.common import map_texts

SAMPLE = 20_000
_SIGNS = b"!*#$%&|.,;:?-_/\\<>=@\"'()[]{}0123456789"


def features(text: bytes) -> list[float]:
    """Shares and logs of counts; none depends on an id, label, language or source."""
    n = len(text)
    by = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    words, lines = text.split(), text.split(b"\n")
    w, per = max(1, len(words)), max(1, n)
    low = [x.lower() for x in words]
    kinds, upper = Counter(low), by[65:91].sum()
    same = sum(a == b for a, b in zip(low, low[1:], strict=False))
    pairs = len(set(zip(low, low[1:], strict=False)))
    ends = Counter(x[-1] for x in words)
    shares = [
        upper / max(1, upper + by[97:123].sum()),
        by[97:123].sum() / per,
        by[48:58].sum() / per,
        by[128:].sum() / per,
        by[[33, 35, 36, 37, 38, 42]].sum() / w,
        by[[46, 44]].sum() / w,
        (by[33:48].sum() + by[58:65].sum() + by[91:97].sum() + by[123:127].sum()) / w,
        sum(x.isupper() for x in words) / w,
        same / w,
        len(kinds) / w,
        pairs / w,
        max(kinds.values(), default=0) / w,
        len(set(lines)) / len(lines),
        sum(len(x) == 1 and not x.isalnum() for x in words) / w,
        sum(v for k, v in ends.items() if k in b"!*#$%&") / w,
        sum(v for k, v in ends.items() if k in b".,") / w,
        *(by[s] / w for s in b"!*#$%&|"),
    ]
    sizes = [np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), n / w / 10.0, w / len(lines) / 100.0]
    return [float(x) for x in [*shares, *sizes]] + [float(np.log(0.01 + x)) for x in shares]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _adam(x_pos: np.ndarray, x_unl: np.ndarray, gradient, steps: int) -> np.ndarray:
    theta = np.zeros(x_pos.shape[1])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        g = gradient(theta, x_pos @ theta, x_unl @ theta)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta


def estimate_prior(pos: np.ndarray, unl: np.ndarray, penalty: float = 1e-3) -> float:
    """Least ratio of the shares above a threshold, plus its standard error.

    Each half is scored by a model of the other half, so that overfitting does not look like
    a difference; thresholds leave at least 70 % of the positives.
    """

    def scores(p, u, p_new, u_new):
        def gradient(theta, a, b):
            return p.T @ (-_sigmoid(-a)) / len(p) + u.T @ _sigmoid(b) / len(u) + penalty * theta

        theta = _adam(p, u, gradient, 300)
        return p_new @ theta, u_new @ theta

    halves = [(pos[i::2], unl[i::2]) for i in (0, 1)] if len(pos) > 20 else [(pos, unl)] * 2
    p, u = (np.sort(np.concatenate(x)) for x in zip(scores(*halves[0], *halves[1]), scores(*halves[1], *halves[0]), strict=True))
    cuts = np.quantile(p, np.linspace(0.005, 0.3, 60))
    above_p, above_u = (1.0 - np.searchsorted(s, cuts) / len(s) for s in (p, u))
    ratio = above_u / above_p
    error = ratio * np.sqrt((1 - above_u) / (above_u * len(u) + 1e-9) + (1 - above_p) / (above_p * len(p) + 1e-9))
    return float(np.clip((ratio + error).min(), 0.05, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray, prior: float, penalty: float = 1e-4, steps: int = 600) -> np.ndarray:
    """Weights of the least non-negative unbiased risk with the logistic loss."""

    def gradient(theta, p, u):
        negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        g_pos = prior * (pos.T @ (-_sigmoid(-p))) / len(pos)
        g_neg = unl.T @ _sigmoid(u) / len(unl) - prior * (pos.T @ _sigmoid(p)) / len(pos)
        # Below zero the negative part has been overfitted: walk it back, else descend on the sum.
        return (g_pos + g_neg if negative >= 0 else -g_neg) + penalty * theta

    return _adam(pos, unl, gradient, steps)


@dataclass
class QualityModel:
    mean: np.ndarray
    std: np.ndarray
    theta: np.ndarray | None  # None: nothing was learnt
    prior: float

    def scores(self, texts: Iterable[bytes]) -> np.ndarray:
        """Probability of label 1 for each text."""
        x = np.array([features(t) for t in texts], float)
        if self.theta is None or not len(x):
            return np.full(len(x), 0.5)
        return _sigmoid(_ready(x, self.mean, self.std) @ self.theta)

    def accepts(self, text: str = "text") -> Column:
        """score >= 0.5, as a filter on a column of texts."""

        @F.pandas_udf("boolean")
        def accepted(texts: pd.Series) -> pd.Series:
            return pd.Series(self.scores(texts) >= 0.5)

        return accepted(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def _ready(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    return np.hstack([np.clip((x - mean) / std, -8, 8), np.ones((len(x), 1))])


def _held_out() -> Column:
    return remainder(3) == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 5) -> QualityModel:
    """Learn from the rows of docs that are not held out."""
    learnt = docs.where(~_held_out()).select("doc_id", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    rows = learnt.select("doc_id", "h", F.xxhash64(F.lit(seed + 1), "h").alias("g"))
    trusted = labels.where("quality = 1").where(~_held_out()).select("doc_id").distinct()
    # Rows first, as hashes; then texts of the chosen ones only: at most 2 * sample hashes are sent to the tasks.
    chosen = rows.join(trusted, "doc_id", "left_semi").select("h").orderBy("h").limit(sample).withColumn("is_pos", F.lit(1))
    other = rows.select("h", "g").orderBy("g").limit(sample).select("h", F.lit(0).alias("is_pos"))
    # Rows of one hash are equal: their features come back once, with the number of rows chosen.
    picked = chosen.unionByName(other).groupBy("h", "is_pos").agg(F.count(F.lit(1)).alias("times"))
    texts = learnt.select("h", "text").join(F.broadcast(picked), "h")

    def each(keys, texts):
        h, is_pos, times = keys
        return {"h": h, "is_pos": is_pos, "times": times, "x": [features(t) for t in texts]}

    kind = "h bigint, is_pos int, times bigint, x array<double>"
    found = map_texts(texts, each, kind, ["h", "is_pos", "times"]).dropDuplicates(["h", "is_pos"]).collect()
    # Folds of the prior are every so many rows, so their order is fixed.
    found.sort(key=lambda r: (r.is_pos, r.h))
    pos, unl = (np.array([r.x for r in found if r.is_pos == k for _ in range(r.times)], float) for k in (1, 0))
    if not len(pos) or not len(unl):
        return QualityModel(np.zeros(0), np.zeros(0), None, 0.5)
    mean, std = unl.mean(axis=0), unl.std(axis=0) + 1e-6
    pos, unl = _ready(pos, mean, std), _ready(unl, mean, std)
    prior = estimate_prior(pos, unl)
    return QualityModel(mean, std, fit(pos, unl, prior), prior)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    model = train(docs, labels, sample, seed)

    def each(ids, texts):
        return {"doc_id": ids, "score": model.scores(texts)}

    return map_texts(docs, each, "doc_id bigint, score double").select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
