"""Language identification by multilingual mixture inference.

``fit`` counts character n-grams per language as a Spark aggregation. A text
is then taken for a mixture: expectation maximisation finds the proportions of
the languages under which its n-grams are most likely, and the languages are
let in one by one, by proportion, for as long as the likelihood gained pays
for the further parameter (Bayesian information criterion). The language with
the largest proportion in the chosen set is the prediction.

N-grams (two and three characters, the rest of a word's edges included) go by
hash into ``BUCKETS`` buckets, so that the model has a fixed size per
language, whatever the corpus: that is what the driver and the tasks hold, half
a megabyte a language. There may be at most ``LANGS`` languages; a column with
more distinct values, such as one of free text, is refused with an error before
anything is counted. Texts are counted whole, in Arrow batches.

Defined results
  * NULL text or text without a letter: ``und`` with a score of 0 and no
    proportions. With no language learned, every text is ``und``.
  * Rows with a NULL language are not learned from. Repeated rows count as
    often as they occur. Equal proportions: the first language by name.
  * An empty table gives an empty result. The operator adds ``_lang`` and
    leaves the caller's columns alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 16
LANGS = 256  # more than ISO 639-1 has
SMOOTH = 0.1  # added to each count
STEPS, SETTLED = 50, 1e-3  # EM steps at most; change of a proportion that ends them
UNDETERMINED = "und"
_M1, _M2, _M3 = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))  # odd multipliers
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def grams(text: str) -> np.ndarray:
    """Bucket of each n-gram: of every letter with the sign before it, and of
    every letter with its two neighbours. All that is no letter is one sign."""
    c = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = np.where(_is_letter()[c], c, np.uint32(0))
    mid = c[1:-1]
    at = np.flatnonzero(mid) + 1
    a, b, z = c[at - 1], c[at], c[at + 1]
    two = (a * _M1) ^ (b * _M2)
    three = (two ^ (z * _M3)) * _M1
    two = (two ^ (two >> np.uint32(15))) * _M3
    return np.concatenate([(two >> np.uint32(16)), (three >> np.uint32(16))]).astype(np.int64) & (BUCKETS - 1)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    odds: np.ndarray  # (languages, BUCKETS): probability over the largest of any language


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].tolist(), batch["text"].tolist()):
            if text:
                sums = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                g, n = np.unique(grams(text), return_counts=True)
                sums[g] += n
    for lang, sums in counts.items():
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": sums[at]})


def fit(rows: DataFrame, lang: str = "lang", text: str = "text", smooth: float = SMOOTH, most: int = LANGS) -> Model:
    """Counts over all given rows; at most ``BUCKETS`` sums a language reach
    the driver. More than ``most`` languages are an error."""
    rows = rows.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    if rows.select("lang").distinct().limit(most + 1).count() > most:
        raise ValueError(f"column {lang} has more than {most} values: clean it, or raise most for a larger model")
    sums = rows.mapInPandas(_counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toPandas()
    langs = tuple(sorted(got["lang"].unique()))
    counts = np.full((len(langs), BUCKETS), smooth)
    for k, name in enumerate(langs):
        own = got[got["lang"] == name]
        counts[k, own["bucket"].to_numpy(dtype=np.int64)] += own["n"].to_numpy(dtype=float)
    return model_of(langs, counts)


def model_of(langs: tuple[str, ...], counts: np.ndarray) -> Model:
    p = counts / counts.sum(axis=1, keepdims=True)
    return Model(langs, p / p.max(axis=0) if langs else p)


def mixture(odds: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """EM: proportions of the rows of ``odds`` (languages, n-grams) that make
    ``n`` occurrences of the n-grams most likely, and the log likelihood."""
    share = np.full(len(odds), 1 / len(odds))
    part = n / n.sum()
    for _ in range(STEPS if len(odds) > 1 else 0):
        new = share * (odds @ (part / (share @ odds)))
        done = np.abs(new - share).max() < SETTLED
        share = new
        if done:
            break
    return share, float(np.log(share @ odds) @ n)


def infer(model: Model, text: str | None) -> tuple[str, float, dict[str, float]]:
    """``(language, its proportion, proportions of the chosen set)``."""
    g, n = np.unique(grams(text or ""), return_counts=True)
    if not len(g) or not model.langs:
        return UNDETERMINED, 0.0, {}
    odds, n = model.odds[:, g], n.astype(float)
    share, _ = mixture(odds, n)
    order = np.argsort(-share, kind="stable")
    chosen, best = None, -np.inf
    for k in range(1, len(order) + 1):
        part, likely = mixture(odds[order[:k]], n)
        likely -= 0.5 * (k - 1) * np.log(n.sum())
        if likely <= best:
            break
        chosen, best = part, likely
    found = {model.langs[i]: float(x) for i, x in zip(order, chosen)}
    lang = min(found, key=lambda k: (-found[k], k))
    return lang, min(1.0, found[lang]), found


FOUND = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                      T.StructField("mixture", T.MapType(T.StringType(), T.DoubleType()))])


def _inferred(model: Model, text: Column) -> Column:
    @F.pandas_udf(FOUND)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([infer(model, t) for t in texts.tolist()], columns=["lang", "score", "mixture"])
    return run(text)


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``_lang``: a struct of ``lang, score, mixture``."""
    return df.withColumn("_lang", _inferred(model, F.col(text)))
