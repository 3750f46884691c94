"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.labelled import id_remainder, labels_of, seeded_first, texts_of
from carestrata.llm.rows import add_columns, give_back

#: Bounds of the samples: confirmed toxic examples and unlabelled texts.
POSITIVES, UNLABELLED = 4000, 8000
#: Features looked at by the classifier, and how clearly they must differ (G statistic).
FEATURES, CLEAR = 256, 20.0
#: Words of a text per repetition that counts as one.
PER = 500
_WORD = re.compile(r"\w+")


def features_of(text: str) -> set[str]:
    """The words of a text, lower-cased, and how they begin (their first four and five letters).

    A beginning that several different words share is a feature of its own as well,
    and so is a word that occurs more than once: more than once per ``PER`` words in
    longer texts, where chance brings them together.
    """
    words = Counter(_WORD.findall(text.lower()))
    few = 1 + words.total() // PER
    starts = Counter(["^" + w[:4] for w in words if len(w) > 4] + ["^" + w[:5] for w in words if len(w) > 5])
    more = [f + "+" for f, n in starts.items() if n > few] + [w + "+" for w, n in words.items() if n > few]
    return {*words, *starts, *more}


@dataclass
class ToxicityModel:
    """A logistic model over the presence of words and their beginnings."""

    weights: dict[str, float]
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        known = self.weights.keys()
        z = np.array([self.bias + sum(map(self.weights.__getitem__, sorted(known & features_of(t)))) for t in texts], dtype=np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def frequent_features(texts: list[str], least: int) -> Counter:
    """In how many texts each feature is, for those in ``least`` or more.

    A first pass counts by hash, so that the many features of one text alone take no
    room in the second.
    """
    mask = (1 << 22) - 1
    rough = bytearray(mask + 1)
    for text in texts:
        for feature in features_of(text):
            at = hash(feature) & mask
            rough[at] = min(least, rough[at] + 1)
    counts = Counter(f for t in texts for f in features_of(t) if rough[hash(f) & mask] >= least)
    return Counter({f: n for f, n in counts.items() if n >= least})


def telling_features(positive: list[str], unlabelled: list[str]) -> list[str]:
    """Features more frequent among the positive texts, by the G statistic of presence."""
    n, m = max(1, len(positive)), max(1, len(unlabelled))
    in_p = frequent_features(positive, 3)
    in_u = Counter(f for t in unlabelled for f in features_of(t) & in_p.keys())
    found = []
    for feature, a in in_p.items():
        b = in_u[feature]
        if a / n <= b / m:
            continue
        cells = ((a, n), (b, m), (n - a, n), (m - b, m))
        rate = (a + b) / (n + m)
        expected = (n * rate, m * rate, n * (1 - rate), m * (1 - rate))
        g = 2 * sum(c[0] * np.log(c[0] / e) for c, e in zip(cells, expected, strict=True) if c[0] > 0)
        if g >= CLEAR:
            found.append((-g, feature))
    return [f for _, f in sorted(found)[:FEATURES]]


def presence(texts: list[str], features: list[str]) -> np.ndarray:
    """One row per text, one column per feature."""
    out = np.zeros((len(texts), len(features)))
    at = {f: i for i, f in enumerate(features)}
    for row, text in zip(out, texts, strict=True):
        row[[at[f] for f in features_of(text) & at.keys()]] = 1.0
    return out


def train_nnpu(x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05, decay: float = 3e-4) -> np.ndarray:
    """Weights (the last one the bias) that minimise the non-negative PU risk.

    With logistic loss l, positives P and unlabelled U the risk is
    ``prior*E_P[l(z)] + max(0, E_U[l(-z)] - prior*E_P[l(-z)])``. Where the second
    part falls below zero, a step goes up on it instead, so that the model does not
    fit the unlabelled texts by calling positives negative. Adam, full batches.
    """
    x_p, x_u = (np.hstack([x, np.ones((len(x), 1))]) for x in (x_p, x_u))
    w = np.zeros(x_p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    keep = np.ones_like(w)
    keep[-1] = 0.0
    for t in range(1, steps + 1):
        s_p, s_u = (1 / (1 + np.exp(-np.clip(x @ w, -60, 60))) for x in (x_p, x_u))
        negative = np.mean(-np.log1p(-np.minimum(s_u, 1 - 1e-12))) - prior * np.mean(-np.log1p(-np.minimum(s_p, 1 - 1e-12)))
        up = x_p.T @ (s_p - 1) / len(x_p)
        down = x_u.T @ s_u / len(x_u) - prior * (x_p.T @ s_p) / len(x_p)
        grad = prior * up + down + decay * keep * w if negative >= 0 else -down
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """A model from confirmed toxic examples and unlabelled texts outside the held-out fold.

    At most ``POSITIVES`` toxic examples and ``UNLABELLED`` texts, chosen by a hash of
    the id; copies of a text count once. The class prior is the share of toxic rows
    among all labels that may be learnt from. The sample is trained on in one task;
    only the weights of at most ``FEATURES`` features reach the driver. Without toxic or
    without unlabelled examples every score is the prior.
    """
    known = labels_of(labels, "toxic", "doc_id", modulus, held_out)
    rate = known.agg(F.avg("_label").alias("p")).first()["p"]
    prior = min(0.99, max(1e-4, rate if rate is not None else 1e-4))
    toxic = seeded_first(known.where("_label = 1").select("_id"), POSITIVES, 1).withColumn("_kind", F.lit(1))
    others = docs.where(id_remainder(id_col, modulus) != held_out).select(F.col(id_col).cast("long").alias("_id"))
    free = seeded_first(others.distinct(), UNLABELLED, 2).withColumn("_kind", F.lit(0))
    sample = texts_of(docs, toxic, id_col, text_col).union(texts_of(docs, free, id_col, text_col))

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts: dict[int, set[str]] = {0: set(), 1: set()}
        for pdf in batches:
            for kind, text in zip(pdf["_kind"], pdf["_text"], strict=True):
                texts[kind].add(text)
        positive, unlabelled = sorted(texts[1]), sorted(texts[0])
        if not positive or not unlabelled:
            return
        chosen = telling_features(positive, unlabelled)
        weights = train_nnpu(presence(positive, chosen), presence(unlabelled, chosen), prior)
        yield pd.DataFrame({"word": [*chosen, None], "weight": weights})
        texts.clear()
        del positive, unlabelled
        give_back()

    rows = sample.select("_kind", "_text").repartition(1).mapInPandas(train, "word string, weight double").collect()
    weights = {r["word"]: r["weight"] for r in rows if r["word"] is not None}
    bias = next((r["weight"] for r in rows if r["word"] is None), float(np.log(prior / (1 - prior))))
    return ToxicityModel(weights, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for the whole text (null: empty)."""
    return add_columns(docs, [text_col], f"`{score_col}` double", lambda texts: [model.scores([t or "" for t in texts])])


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document.

    Rows whose crc32(doc_id) leaves ``held_out`` modulo ``modulus`` are never learnt
    from. Texts alone are scored: whole, lower-cased, by the words they hold and how these begin. Null and
    empty texts have the bias as score; a null id is never learnt from and counts as
    not held out; repeated rows are scored each; an empty table gives no rows; without
    labels all scores are low. Other columns are not read.
    """
    model = fit_toxicity(docs, labels, modulus, held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fold = F.coalesce(id_remainder("doc_id", modulus) == held_out, F.lit(False))
    scored = score_toxicity(rows, model)
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
