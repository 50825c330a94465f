"""Quality scores from pairwise preferences (Bradley-Terry)."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corral.llm.common import map_batches, text_batches, texts_of
from corral.llm.labelled import id_remainder, labelled_sample

_SYMBOLS = re.compile(r"[*$%&#@^~<>{}\[\]|\\/=+_]")
_DIGITS = re.compile(r"[0-9]")
_MARKS = re.compile(r"[.,;:!?]")


def features(text: str) -> list[float]:
    """Shares that tell running text from junk, each once as it is and once on a
    root scale (small shares count), and the logarithm of the word count."""
    words = text.split()
    m = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(len(lines), 1)
    by_line = Counter(lines)
    chars = max(len(text), 1)
    shouted = [x for x in lines if x.isupper() and len(x) > 20]
    tables = [x for x in lines if x.count("|") >= 2]
    noisy = [x for x in lines if len(_SYMBOLS.findall(x)) * 8 > len(x)]
    shares = [
        sum(map(str.isupper, words)) / m,
        sum(map(str.istitle, words)) / m,
        len(_SYMBOLS.findall(text)) / chars,
        len(_DIGITS.findall(text)) / chars,
        len(_MARKS.findall(text)) / chars,
        text.count("!") / m,
        text.count("|") / m,
        sum(a == b for a, b in zip(words, words[1:])) / m,
        1 - len(counts) / m,
        1 - len(set(zip(words, words[1:], words[2:]))) / max(m - 2, 1),
        max(counts.values(), default=0) / m,
        1 - len(by_line) / n_lines,
        sum(len(x) for x in shouted) / chars,
        sum(len(x) for x in tables) / chars,
        sum(len(x) for x in noisy) / chars,
        min(sum(map(len, words)) / m / 20, 1.0),
        sum(len(w) > 18 for w in words) / m,
        n_lines / m,
        float(len(words) < 20),
    ]
    shares = [min(max(x, 0.0), 1.0) for x in shares]
    return [*shares, *[math.sqrt(x) for x in shares], math.log1p(len(words)) / 10]


class RankModel:
    """Linear document score; ``cut`` is the score quantile below which a document
    is rejected."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, texts: list[str]) -> list[float]:
        if not texts:
            return []
        s = self.raw(np.array([features(t) for t in texts])) - self.cut
        return (1.0 / (1.0 + np.exp(-np.clip(s, -40, 40)))).tolist()


def train(sample: list[tuple[str, int]], pairs_each: int = 40, ridge: float = 3.0, seed: int = 5) -> RankModel:
    """Bradley-Terry: P(a before b) = sigmoid(w . (x_a - x_b)), fitted by Newton
    steps on the logistic loss of ``pairs_each`` pairs (good, bad) for every
    document of the rarer label.  The cut is the sample's score quantile at the
    share of rejected labels.  A sample of one class (or none) scores every text
    the same, on the side of that class.
    """
    x = np.array([features(t) for t, _ in sample], dtype=np.float64)
    y = np.array([label for _, label in sample], dtype=np.int64)
    d = len(features(""))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        keep = not len(bad)
        return RankModel(np.zeros(d), np.ones(d), np.zeros(d), -1.0 if keep else 1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.02
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
    one = np.repeat(few, pairs_each)
    other = rng.choice(many, size=len(one))
    better, worse = (other, one) if few is bad else (one, other)
    diff = z[better] - z[worse]
    w = np.zeros(d)
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(diff @ w, -40, 40)))
        grad = diff.T @ (p - 1) + ridge * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    ranked = np.sort(z @ w)
    n_bad = len(bad)
    cut = float((ranked[n_bad - 1] + ranked[n_bad]) / 2) if n_bad < len(ranked) else float(ranked[-1])
    return RankModel(mean, scale, w, cut)


def quality_model(docs: DataFrame, labels: DataFrame, max_rows: int = 4000) -> RankModel:
    """Train on at most ``max_rows`` labelled documents whose id remainder mod 3 is
    not 1."""
    return train(labelled_sample(docs, labels, "quality", id_remainder(3) != 1, max_rows))


def score_quality(docs: DataFrame, model: RankModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Whole texts, one pass, no shuffle.  Null text: empty, scored by its (zero)
    features.  Null id: not held out.  Repeated rows are scored each.  Empty
    table: no rows.
    """

    def run(batches):
        for ids, texts in text_batches(batches):
            yield {"doc_id": ids, "score": model.score(texts)}

    scored = map_batches(texts_of(docs, id_col, text_col), run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
