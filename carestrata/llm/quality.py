"""Text quality by regularised quadratic discriminant analysis."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.labelled import id_remainder, labels_of, seeded_first, texts_of
from carestrata.llm.rows import add_columns

#: Bound of the labelled sample, per class.
SAMPLE = 6000
#: Weight of the pooled variances in a class covariance.
SHRINKAGE = 0.1
#: Transformed statistics further out than this many deviations count as so far.
FAR = 8.0

_LOWER, _UPPER, _DIGIT = (np.arange(a, b) for a, b in ((97, 123), (65, 91), (48, 58)))
_SPACE = np.array([9, 10, 11, 12, 13, 32])
_STOP = np.array([ord(c) for c in ".,;:"])
_OTHER = np.setdiff1d(np.arange(33, 127), np.concatenate([_LOWER, _UPPER, _DIGIT, _STOP]))
FEATURES = 15


def statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text: sizes as logs, shares as logits."""
    raw = text.encode("utf-8", "replace")
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    sentences = [x for x in raw.split(b".") if x.strip()]
    n_words, kinds = len(words), len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))

    def share(part: float, whole: float) -> float:
        p = (part + 0.5) / (whole + 1.0)
        return float(np.log(p / (1 - p))) if p < 1 else 8.0

    some = hist[33:127]
    p = some[some > 0] / max(1, some.sum())
    ends = sum(w[-1] in b"!#$%&*|" for w in words)
    return [
        float(np.log1p(n_words)),
        float(np.log1p(n / max(1, n_words))),
        share(kinds, n_words),
        share(pairs, max(0, n_words - 1)),
        share(hist[_UPPER].sum(), n),
        share(hist[_DIGIT].sum(), n),
        share(hist[_OTHER].sum(), n),
        share(hist[_STOP].sum(), n),
        share(hist[_SPACE].sum(), n),
        share(hist[128:].sum(), n),
        share(ends, n_words),
        share(len(set(lines)), len(lines)),
        share(len(set(sentences)), len(sentences)),
        float(np.log1p(n_words / max(1, len(sentences)))),
        float(-(p * np.log(p)).sum()) if len(p) else 0.0,
    ]


@dataclass
class QualityModel:
    """Two Gaussians over standardised statistics, as means and Cholesky factors."""

    centre: np.ndarray
    spread: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_prior: list[float]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Posterior of class 1 from the difference of Mahalanobis log densities."""
        x = np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), FEATURES)
        x = np.clip((x - self.centre) / self.spread, -FAR, FAR)
        logs = []
        for mean, factor, prior in zip(self.means, self.factors, self.log_prior, strict=True):
            y = np.linalg.solve(factor, (x - mean).T)
            logs.append(prior - np.log(np.diag(factor)).sum() - 0.5 * (y * y).sum(axis=0))
        return 1.0 / (1.0 + np.exp(-np.clip(logs[1] - logs[0], -60, 60)))


def fit_gaussians(x: np.ndarray, y: np.ndarray, rates: list[float]) -> QualityModel | None:
    """Class means and shrunken covariances; None unless both classes have rows."""
    if not (y == 0).any() or not (y == 1).any():
        return None
    centre, spread = np.median(x, axis=0), x.std(axis=0) + 1e-3
    z = np.clip((x - centre) / spread, -FAR, FAR)
    means = [z[y == c].mean(axis=0) for c in (0, 1)]
    pooled = np.mean(np.concatenate([(z[y == c] - means[c]) ** 2 for c in (0, 1)]), axis=0) + 1e-2
    factors = []
    for c in (0, 1):
        d = z[y == c] - means[c]
        own = len(d) / (len(d) + 2.0 * FEATURES) * (1 - SHRINKAGE)
        factors.append(np.linalg.cholesky(own * (d.T @ d) / len(d) + (1 - own) * np.diag(pooled)))
    return QualityModel(centre, spread, means, factors, [float(np.log(max(r, 1e-6))) for r in rates])


def fit_quality(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> QualityModel | None:
    """The model of at most ``SAMPLE`` labelled texts of each class outside the held-out fold.

    Class priors come from all labels that may be learnt from. Statistics are made
    where the texts lie; of the sample, ``FEATURES`` numbers a text reach the driver.
    """
    known = labels_of(labels, "quality", "doc_id", modulus, held_out)
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    total = max(1, sum(counts.values()))
    chosen = [seeded_first(known.where(F.col("_label") == c), SAMPLE, 3) for c in (0, 1)]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"_id": pdf["_id"], "_label": pdf["_label"], "x": [statistics(t) for t in pdf["_text"]]})

    rows = texts_of(docs, chosen[0].union(chosen[1]), id_col, text_col).mapInPandas(measure, "_id long, _label int, x array<double>").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["_id"], r["x"]))
    x, y = np.array([r["x"] for r in rows]), np.array([r["_label"] for r in rows])
    return fit_gaussians(x, y, [counts.get(c, 0) / total for c in (0, 1)])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document.

    Rows whose crc32(doc_id) leaves ``held_out`` modulo ``modulus`` are never learnt
    from. Only whole texts are scored. A null text counts as empty and is scored as
    such; a null id is never learnt from and counts as not held out; repeated rows are
    scored each; an empty table gives no rows. Without labels of both classes every
    score is the share of class 1, or one half. Other columns are not read.
    """
    model = fit_quality(docs, labels, modulus, held_out)
    flat = 0.5
    if model is None:
        rate = labels_of(labels, "quality", "doc_id", modulus, held_out).agg(F.avg("_label").alias("p")).first()["p"]
        flat = 0.5 if rate is None else float(rate)

    def score(texts: list[str | None]) -> list:
        return [model.scores([t or "" for t in texts]) if model else [flat] * len(texts)]

    fold = F.coalesce(id_remainder("doc_id", modulus) == held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = add_columns(rows, ["text"], "score double", score, drop=("text",))
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
