"""Quality classifier: regularised quadratic discriminant on document statistics.

``document_statistics`` turns a whole text into a dozen transformed numbers
(one pass, Arrow batches). ``fit`` sums first and second moments per class as
a Spark aggregation, shrinks each class covariance towards the pooled one and
towards its diagonal, and factors it once (Cholesky). ``score`` takes the
difference of the two Gaussian log densities (Mahalanobis distance through the
cached factors) and the class priors.

Defined results
  * NULL text counts as empty; an empty text has statistics of its own (all
    counts zero) and is scored like the others, so every row gets a score.
  * Rows whose label is NULL or neither 0 nor 1 are not learned from. Repeated
    rows count as often as they occur. With one class only, or no labels, the
    score is the smoothed share of class 1 for every document.
  * An empty table gives an empty result.
  * Ids of documents are never inputs of the statistics; the operator adds the
    columns ``_stats`` and ``score`` and leaves the caller's columns alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATS = ("word_chars", "upper", "symbols", "digits", "distinct", "top_word", "repeats",
         "short_words", "same_lines", "symbol_ends", "lone_symbols")
NEAR = 0.01  # added to a share and to its rest before the logit, so that a share of zero is the same for any length
#: Noisy shares of short texts are drawn towards a usual value that weighs as much as so many words or characters.
USUAL = {"word_chars": (20, 5.0), "short_words": (20, 0.4), "upper": (100, 0.03), "repeats": (20, 0.0)}
POOL, DIAGONAL, FLOOR = 0.02, 0.02, 1e-3  # shrinkage towards pooled and diagonal covariance; least variance
ALNUM = bytes(c for c in range(128) if chr(c).isalnum()) + bytes(range(128, 256))
NOT_SYMBOLS = ALNUM + b" \t\n\r\x0b\x0c.,;:'\"-?()"


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _towards(name: str, part: float, whole: float) -> float:
    weight, value = USUAL[name]
    return (part + weight * value) / (whole + weight)


def _logit(p: float) -> float:
    return float(np.log((p + NEAR) / (1 - p + NEAR)))


def statistics(text: str) -> list[float]:
    data = text.encode("utf-8", "replace")
    w = data.split()
    n, chars = len(w), sum(map(len, w))
    counts: dict[bytes, int] = {}
    for x in w:
        counts[x] = counts.get(x, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbols = len(data.translate(None, NOT_SYMBOLS))
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    same = sum(a == b for a, b in zip(w, w[1:]))
    ends = sum(x[-1] not in NOT_SYMBOLS for x in w)
    lone = sum(not x.strip(b"|*#$%&!-=_~^+<>/\\") for x in w)
    return [float(np.log(_towards("word_chars", chars, n))), _logit(_towards("upper", upper, chars)),
            _logit(_share(symbols, chars)), _logit(_share(digits, chars)), float(np.log((len(counts) + 1) / (n + 1))),
            _logit(_share(max(counts.values(), default=1) - 1, n)), _logit(_towards("repeats", same, n)),
            _logit(_towards("short_words", sum(len(x) <= 3 for x in w), n)),
            _logit(_share(len(lines) - len(set(lines)), len(lines))), _logit(_share(ends, n)), _logit(_share(lone, n))]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return texts.fillna("").map(statistics)


def document_statistics(text: Column) -> Column:
    return _statistics(text)


@dataclass(frozen=True)
class Model:
    prior: float  # smoothed share of class 1
    means: np.ndarray | None = None  # (2, d)
    whiten: np.ndarray | None = None  # (2, d, d): inverse Cholesky factors
    log_det: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        logs = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.whiten[k].T
            logs.append(-0.5 * (z * z).sum(axis=1) - 0.5 * self.log_det[k])
        gap = logs[1] - logs[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def fit(rows: DataFrame, label: str = "label", stats: str = "_stats", pool: float = POOL,
        diagonal: float = DIAGONAL) -> Model:
    """``rows``: one row per labelled document. Only sums reach the driver."""
    d = len(STATS)
    x = [F.col(stats)[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("q")]
    got = {r["y"]: r for r in rows.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y")).agg(*sums).collect()}
    n = [got[k]["n"] if k in got else 0 for k in (0, 1)]
    prior = (n[1] + 1) / (sum(n) + 2)
    if not all(n):
        return Model(prior)
    means, covs = [], []
    for k in (0, 1):
        m = np.array(got[k]["s"]) / n[k]
        c = np.zeros((d, d))
        for (i, j), v in zip(pairs, got[k]["q"]):
            c[i, j] = c[j, i] = v / n[k] - m[i] * m[j]
        means.append(m)
        covs.append(c)
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / sum(n)
    whiten, log_det = [], []
    for c in covs:
        c = (1 - pool) * c + pool * pooled
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(c)) + FLOOR * np.eye(d)
        low = np.linalg.cholesky(c)
        whiten.append(np.linalg.inv(low))
        log_det.append(2 * np.log(np.diag(low)).sum())
    return Model(prior, np.array(means), np.array(whiten), np.array(log_det))


def score(model: Model, stats: Column) -> Column:
    """Probability of class 1."""
    @F.pandas_udf(T.DoubleType())
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(x.to_list()))) if len(x) else pd.Series([], dtype=float)
    return scored(stats)
