"""Toxicity scores from averaged subword vectors and a linear softmax."""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterable
from functools import partial
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corral.llm.common import map_batches, text_batches, texts_of
from corral.llm.labelled import id_remainder, labelled_sample

_WORD = re.compile(r"[^\W_]+")
SCALE = 50.0  # of the averaged vector, so that a few words in a hundred can decide


PRIOR_WORDS = 5  # neutral words added to every average, so that one word of three does not decide


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def subwords(word: str, buckets: int, low: int = 3, high: int = 5) -> list[int]:
    """Buckets of the word itself and of its character n-grams with edge marks."""
    marked = f"<{word}>"
    grams = {marked[i : i + n] for n in range(low, high + 1) for i in range(len(marked) - n + 1)}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % buckets for g in sorted(grams | {marked})]


class CountedWords(NamedTuple):
    """Documents as counted words, in arrays: a sample's words as Python objects
    would take several hundred MB."""

    totals: np.ndarray  # words of each document
    doc: np.ndarray  # of each entry, a distinct word of a document, in ascending order
    word: np.ndarray  # of each entry: its place among the words in order
    times: np.ndarray  # of each entry: how often the document has the word
    sizes: np.ndarray  # of each word: how many subwords it has
    flat: np.ndarray  # the subwords of all words

    def of(self, chosen: np.ndarray) -> CountedWords:
        """The documents that are true in ``chosen``; the words stay."""
        held = chosen[self.doc]
        place = np.cumsum(chosen, dtype=np.int32) - 1
        return self._replace(
            totals=self.totals[chosen], doc=place[self.doc[held]], word=self.word[held], times=self.times[held]
        )


def counted_words(texts: Iterable[str], buckets: int) -> CountedWords:
    places: dict[str, int] = {}
    totals, entries, word, times = array("i"), array("i"), array("i"), array("i")
    for text in texts:
        counts = Counter(words_of(text))
        totals.append(counts.total())
        entries.append(len(counts))
        word.extend([places.setdefault(w, len(places)) for w in counts])
        times.extend(counts.values())
    rank = np.zeros(len(places), dtype=np.int32)
    sizes, flat = array("i"), array("i")
    for i, w in enumerate(sorted(places)):
        rank[places[w]] = i
        parts = subwords(w, buckets)
        sizes.append(len(parts))
        flat.extend(parts)
    whole = lambda values: np.frombuffer(values, dtype=np.int32)
    doc = np.repeat(np.arange(len(totals), dtype=np.int32), whole(entries))
    return CountedWords(whole(totals), doc, rank[whole(word)], whole(times), whole(sizes), whole(flat))


class SubwordModel:
    """Vectors of subword buckets and the softmax weights over their average."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray, shift: float = 0.0):
        self.vectors, self.weights, self.bias, self.shift = vectors, weights, bias, shift
        self._of_bucket: list[float] = (vectors @ (weights[:, 1] - weights[:, 0])).tolist()
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def _word(self, word: str) -> float:
        """What the word adds to the toxic logit over the other one."""
        parts = [self._of_bucket[b] for b in subwords(word, len(self._of_bucket))]
        return sum(parts) / len(parts)

    def logit(self, text: str) -> float:
        """Toxic logit over the other one; a text without words gets the bias alone."""
        words, known = words_of(text), self._known
        if len(known) > 400_000:
            known.clear()
        total = 0.0
        for w in words:
            s = known.get(w)
            if s is None:
                s = known[w] = self._word(w)
            total += s
        return self._logit(total, len(words))

    def _logit(self, total: float, n_words: int) -> float:
        return SCALE * total / (n_words + PRIOR_WORDS) + float(self.bias[1] - self.bias[0]) + self.shift

    def counted_logits(self, docs: CountedWords) -> np.ndarray:
        """``logit`` of documents as counted words."""
        of_word = docs.sizes.astype(np.float64)
        if len(of_word):
            starts = np.cumsum(docs.sizes) - docs.sizes
            of_word = np.add.reduceat(np.array(self._of_bucket)[docs.flat], starts) / of_word
        parts = of_word[docs.word] * docs.times
        ends = np.cumsum(np.bincount(docs.doc, minlength=len(docs.totals))).tolist()
        return np.array(
            [self._logit(sum(parts[i:j].tolist()), n) for i, j, n in zip([0, *ends], ends, docs.totals.tolist())]
        )

    def score(self, text: str) -> float:
        """Probability of label 1."""
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(text), -40, 40))))


#: Thresholds that the folds choose from: quantiles of the chi-square distribution
#: with one degree of freedom, at 1 in 1,000, at 1 in 50,000, and at 1 in 20 over all
#: buckets together (0.05 / 2 ** 17).
SIGNALS = (10.83, 16.45, 25.84)

#: Runs jobs (threshold, fold) and returns the out-of-fold scores of each.
FoldRunner = Callable[[Callable[[float, int], np.ndarray], list[tuple[float, int]]], list[np.ndarray]]


def here(score: Callable[[float, int], np.ndarray], jobs: list[tuple[float, int]]) -> list[np.ndarray]:
    return [score(*job) for job in jobs]


def as_tasks(spark: SparkSession) -> FoldRunner:
    """Every job is a Spark task: folds are trained side by side, off the driver."""

    def run(score: Callable[[float, int], np.ndarray], jobs: list[tuple[float, int]]) -> list[np.ndarray]:
        def one(batches):
            for batch in batches:
                done = batch.column("id").to_pylist()
                yield {"job": done, "scores": [score(*jobs[i]).astype("<f8").tobytes() for i in done]}

        rows = map_batches(spark.range(0, len(jobs), 1, len(jobs)), one, "job long, scores binary").collect()
        by_job = {r["job"]: np.frombuffer(bytes(r["scores"]), dtype="<f8") for r in rows}
        return [by_job[i] for i in range(len(jobs))]

    return run


def train(
    sample: list[tuple[str, int]],
    buckets: int = 1 << 17,
    dim: int = 2,
    rounds: int = 40,
    rate: float = 0.2,
    signals: tuple[float, ...] = SIGNALS,
    min_docs: int = 2,
    folds: int = 3,
    seed: int = 3,
    run: FoldRunner = here,
) -> SubwordModel:
    """Joint training of vectors and softmax by Adam over the whole sample.

    Words of at least ``min_docs`` sample documents take part (two: a word of one
    document says nothing of others); the average is over
    all words of a document.  Classes weigh the same.  Vectors start at zero;
    those of subwords whose documents' classes differ from the sample's by a
    log-likelihood ratio under a threshold stay there, so that the many
    neutral subwords do not learn documents by heart.  The threshold is the one
    of ``signals`` (the highest, if equal) by which the fewest sample documents are
    on the wrong side, each scored by a model of the other ``folds``; ``shift`` puts
    0.5 where those scores part the classes best.  A sample of one class gives
    the constant score of that class's share.  An empty sample gives the constant
    score 0.25: without evidence no text is called toxic.
    """
    y = np.array([label for _, label in sample], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        p = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.25
        return SubwordModel(np.zeros((buckets, dim)), np.zeros((dim, 2)), np.array([0.0, np.log(p / (1 - p))]))
    fit = partial(_fit, buckets=buckets, dim=dim, rounds=rounds, rate=rate, min_docs=min_docs, seed=seed)

    def out_of_fold(signal: float, fold: int) -> np.ndarray:
        docs = counted_words((text for text, _ in sample), buckets)
        others = np.arange(len(y)) % folds != fold
        part = fit(docs.of(others), y[others], min_signal=signal)
        scores = np.zeros(len(y))
        scores[~others] = part.counted_logits(docs.of(~others))
        return scores

    jobs = [(signal, fold) for signal in signals for fold in range(folds)]
    done = run(out_of_fold, jobs)
    scores = {signal: sum(s for (own, _), s in zip(jobs, done) if own == signal) for signal in signals}
    best = min(signals, key=lambda signal: (_best_cut(scores[signal], y)[1], -signal))
    model = fit(counted_words((text for text, _ in sample), buckets), y, min_signal=best)
    model.shift = -_best_cut(scores[best], y)[0]
    return model


def _fit(
    docs: CountedWords,
    y: np.ndarray,
    buckets: int,
    dim: int,
    rounds: int,
    rate: float,
    min_docs: int,
    seed: int,
    min_signal: float,
) -> SubwordModel:
    """One training run, without the shift."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((buckets, dim))
    weights = rng.normal(scale=0.5, size=(dim, 2))
    bias = np.zeros(2)
    spread = np.bincount(docs.word, minlength=len(docs.sizes)) >= min_docs  # words that take part
    if not spread.any() or len(set(y.tolist())) < 2:
        return SubwordModel(vectors, weights, bias)
    known = spread[docs.word]
    doc, word = docs.doc[known], (np.cumsum(spread, dtype=np.int32) - 1)[docs.word[known]]
    share = docs.times[known] * SCALE / (docs.totals + float(PRIOR_WORDS))[doc]
    sizes, flat = docs.sizes[spread], docs.flat[np.repeat(spread, docs.sizes)]
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    class_weight = len(y) / (2.0 * np.bincount(y, minlength=2))
    target = np.eye(2)[y]

    # subwords with a signal, and the words and entries that hold them
    n = len(sizes)
    ends = np.cumsum(sizes)
    own = [flat[i:j] for i, j in zip((ends - sizes).tolist(), ends.tolist())]
    with_class = np.zeros((2, buckets))
    last = np.cumsum(np.bincount(doc, minlength=len(y))).tolist()
    for d, (i, j) in enumerate(zip([0, *last], last)):
        if held := [own[w] for w in word[i:j].tolist()]:
            with_class[y[d], np.unique(np.concatenate(held))] += 1
    del own
    keep = (_class_signal(with_class, np.bincount(y, minlength=2) / len(y)) > min_signal)[flat]
    flat, owner = flat[keep], owner[keep]
    live, owner = np.unique(owner, return_inverse=True)
    place = np.full(n, -1)
    place[live] = np.arange(len(live))
    held = place[word] >= 0
    doc, word, share, sizes = doc[held], place[word[held]], share[held], sizes[live].astype(np.float64)

    def add_up(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(index, weights=values[:, k], minlength=size) for k in range(dim)], axis=1)

    def average() -> np.ndarray:
        of_word = add_up(owner, vectors[flat], len(live)) / sizes[:, None]
        return add_up(doc, of_word[word] * share[:, None], len(y))

    params = [vectors, weights, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, rounds + 1):
        pooled = average()
        logits = pooled @ weights + bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) * class_weight[y][:, None] / len(y)
        d_pooled = error @ weights.T
        d_word = add_up(word, d_pooled[doc] * share[:, None], len(live)) / sizes[:, None]
        grads = [add_up(flat, d_word[owner], buckets), pooled.T @ error, error.sum(axis=0)]
        for param, (m, v), g in zip(params, moments, grads):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return SubwordModel(vectors, weights, bias)


def _class_signal(seen: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each bucket's documents per class (``seen``: classes x
    buckets) against the sample's class shares."""
    expected = shares[:, None] * seen.sum(axis=0)
    return 2 * np.sum(seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1)), axis=0)


def _best_cut(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Middle of the gap between neighbouring scores with the fewest wrong sides (the
    highest such gap), and how many are wrong there."""
    order = np.argsort(scores, kind="stable")
    s, t = scores[order], y[order]
    wrong = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([np.cumsum((1 - t)[::-1])[::-1], [0]])
    wrong = wrong.astype(np.float64)
    wrong[1:-1][s[1:] <= s[:-1]] = np.inf  # equal scores are not parted
    best = len(wrong) - 1 - int(np.argmin(wrong[::-1]))
    low = s[best - 1] if best else s[0] - 1
    high = s[best] if best < len(s) else s[-1] + 1
    return float((low + high) / 2), float(wrong[best])


def toxicity_model(docs: DataFrame, labels: DataFrame, max_rows: int = 5000) -> SubwordModel:
    """Train on at most ``max_rows`` labelled documents whose id remainder mod 5 is
    not 0; the folds are tasks."""
    return train(labelled_sample(docs, labels, "toxic", id_remainder(5) != 0, max_rows), run=as_tasks(docs.sparkSession))


def score_toxicity(docs: DataFrame, model: SubwordModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Whole texts, one pass, no shuffle; the model (a fixed number of buckets) goes
    to the tasks.  Null text: empty, scored by the bias.  Null id: not held out.
    Repeated rows are scored each.  Empty table: no rows.
    """

    def run(batches):
        for ids, texts in text_batches(batches):
            yield {"doc_id": ids, "score": [model.score(t) for t in texts]}

    scored = map_batches(texts_of(docs, id_col, text_col), run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
