"""Quality by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its text features. Preference
pairs (a good document over a bad one) are fitted with the logistic loss on the
difference of their features. The threshold is a quantile of the scores of all
documents, labelled or not. Its level is learned from every eligible label: the
share of documents below the point that parts the scores of the good from those
of the bad with the fewest mistakes, both read from one histogram of ``bins``
steps. The score is placed so that the quantile lies at ``threshold_score``.

Features come from the whole text: shares of capitals, symbols, bars,
exclamation marks and digits, of words that repeat the word before, of distinct
words, the mean word length and the length; their means and spreads are taken
over all documents. The fit reads a bounded sample of labelled rows
(``max_labelled``, smallest hashes of their ids first) and ``max_pairs`` pairs;
the level is then taken from every labelled document, by its lowest score where
its id has several rows, and the quantile over every row of the documents.

Null or empty text has all features zero. Null ids are scored, never fitted on.
Null labels say nothing; of several labels of one document the lowest counts.
With only one class to learn from every score is the good ones' share (or 0.5).
Rows repeated are scored each. An empty table gives no rows. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare

FEATURES = ("capitals", "symbols", "bars", "shouts", "digits", "repeats", "distinct", "word_length", "length")
_BYTE = np.arange(256)
UPPER = (_BYTE >= 65) & (_BYTE <= 90)
DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
BLANK = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
SYMBOL = (_BYTE > 32) & (_BYTE < 127) & ~UPPER & ~DIGIT & ~((_BYTE >= 97) & (_BYTE <= 122))


@dataclass(frozen=True)
class QualityParams:
    max_labelled: int = 20000
    max_pairs: int = 40000
    l2: float = 1e-3
    threshold_score: float = 0.7
    seed: int = 17
    bins: int = 1 << 16


@dataclass(frozen=True)
class QualityModel:
    """score = logistic((weights . (features - mean) / spread - cut) / scale + logit(threshold_score)).

    ``cut`` is the quantile of all documents' raw scores at ``level``.
    """
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]
    level: float
    cut: float
    scale: float
    threshold_score: float


def text_features(data: bytes) -> list[float]:
    """The features of a UTF-8 text; shares are of bytes or words, under a square root to open up small ones."""
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    solid = max(1, len(data) - int(counts[BLANK].sum()))
    n = len(words)
    shares = (counts[UPPER].sum() / solid, counts[SYMBOL].sum() / solid, counts[124] / solid, counts[33] / solid,
              counts[DIGIT].sum() / solid, sum(map(eq, words, words[1:])) / n, len(set(words)) / n)
    return [*(float(x) ** 0.5 for x in shares), float(min(solid / n, 40.0)), float(np.log1p(n))]


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats = [text_features(t or b"") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(feats, pa.list_(pa.float64()))], ["doc_id", "features"])

    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, features array<double>")


def fit_pairs(better: np.ndarray, worse: np.ndarray, l2: float) -> np.ndarray:
    """Bradley-Terry weights: Newton steps on mean log(1 + exp(-w . (better - worse))) + l2/2 |w|^2."""
    d = better - worse
    w = np.zeros(d.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        grad = -(d.T @ q) / len(d) + l2 * w
        hess = (d * (q * (1 - q))[:, None]).T @ d / len(d) + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        w -= step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def level_bounds(good: np.ndarray, bad: np.ndarray) -> tuple[int, int]:
    """(last step below, first step above) of the cut between ascending steps with the fewest mistakes.

    ``good`` and ``bad`` are the labels of each step; each class is weighed alike. Steps
    without labels between the two belong to neither. -1 and the number of steps
    stand for the ends.
    """
    # cut before place k: good below it and bad from it on are mistakes
    wrong = np.concatenate([[0], np.cumsum(good)]) / max(1, good.sum()) + (
        bad.sum() - np.concatenate([[0], np.cumsum(bad)])) / max(1, bad.sum())
    places = np.nonzero(wrong <= wrong.min() + 1e-12)[0]
    first = int(places[0])
    marked = np.nonzero(good[first:] + bad[first:])[0]  # only unlabelled steps lie before the next label
    return first - 1, first + int(marked[0]) if len(marked) else len(good)


def quantile_level(total: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The share of all documents (``total`` of each step) that the least-error cut leaves below.

    Between the last bad and the first good score it lies nearer the bad one: new
    documents that are good in an unusual way fall between the two.
    """
    below, above = level_bounds(good, bad)
    upto = np.concatenate([[0], np.cumsum(total)])
    return float(0.75 * upto[below + 1] + 0.25 * upto[above]) / max(1, int(upto[-1]))


def step_quantile(low: np.ndarray, high: np.ndarray, total: np.ndarray, level: float) -> float:
    """The quantile of all scores at a level, from ascending steps: least and greatest score and rows of each.

    Where the level falls between two steps, the quantile lies between their
    scores, nearer the lower one; inside a step it goes up in a straight line.
    Below all scores at level 0, above them at level 1.
    """
    upto = np.cumsum(total)
    rank = level * int(upto[-1])
    if rank <= 1e-9 * upto[-1]:
        return float(low[0]) - 1.0
    if rank >= upto[-1] * (1 - 1e-9):
        return float(high[-1]) + 1.0
    k = int(np.searchsorted(upto, rank - 1e-9 * upto[-1]))
    if abs(upto[k] - rank) <= 1e-9 * upto[-1]:
        return float(0.75 * high[k] + 0.25 * low[k + 1])
    return float(low[k] + (high[k] - low[k]) * (rank - (upto[k] - total[k])) / total[k])


def score_quantile(scores: DataFrame, labelled: DataFrame, bins: int) -> tuple[float, float]:
    """(level, cut): the level learned from ``labelled`` (s, quality) and the quantile of all ``scores`` (s) there.

    One histogram of at most ``bins`` equal steps of the scores' range reaches the driver.
    """
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    step = F.least(F.floor((F.col("s") - F.lit(low)) * F.lit(bins / max(high - low, 1e-300))), F.lit(bins - 1)).alias("step")
    good = F.col("quality") >= 1
    every = scores.groupBy(step).agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count(F.lit(1)).alias("n"))
    marks = labelled.groupBy(step).agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    rows = sorted(every.join(marks, "step", "left").na.fill(0, ["good", "bad"]).collect(), key=lambda r: r["step"])
    low, high, n, good, bad = (np.array([r[c] for r in rows]) for c in ("low", "high", "n", "good", "bad"))
    level = quantile_level(n, good, bad)
    return level, step_quantile(low, high, n, level)


def fit_quality(features: DataFrame, labels: DataFrame, eligible: Column,
                p: QualityParams = QualityParams()) -> QualityModel | float:
    """Fit on the eligible labelled rows; a number (the constant score) where one class is missing."""
    k = len(FEATURES)
    stats = features.agg(*[f(F.get("features", i)).alias(f"{n}{i}") for i in range(k)
                           for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stats[f"m{i}"] or 0.0 for i in range(k)])
    spread = np.array([stats[f"s{i}"] or 0.0 for i in range(k)])
    spread[spread < 1e-9] = 1.0
    marked = (labels.filter("quality is not null and doc_id is not null").filter(eligible)
              .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality")))
    first = (marked.join(features.select("doc_id"), "doc_id", "left_semi")
             .orderBy(F.xxhash64(F.lit(13), "doc_id"), "doc_id").limit(p.max_labelled))
    # at most max_labelled distinct ids; one row of features each
    sample = (features.join(F.broadcast(first), "doc_id").groupBy("doc_id", "quality")
              .agg(F.min("features").alias("features")).orderBy("doc_id").collect())
    x = (np.array([r["features"] for r in sample]).reshape(-1, k) - mean) / spread
    good = np.array([r["quality"] >= 1 for r in sample], bool)
    if not good.any() or good.all():
        return 1.0 if len(good) and good.all() else 0.0 if len(good) else 0.5
    rng = np.random.default_rng(p.seed)
    a, b = np.nonzero(good)[0], np.nonzero(~good)[0]
    w = fit_pairs(x[rng.choice(a, p.max_pairs)], x[rng.choice(b, p.max_pairs)], p.l2)
    scores = features.select("doc_id", raw_score(F.col("features"), mean, spread, w).alias("s"))
    labelled = (scores.filter("doc_id is not null").groupBy("doc_id").agg(F.min("s").alias("s"))
                .join(marked, "doc_id").select("s", "quality"))
    level, cut = score_quantile(scores.select("s"), labelled, p.bins)
    return QualityModel(tuple(mean), tuple(spread), tuple(w), level, cut,
                        max(float((x @ w).std()) / 2, 1e-9), p.threshold_score)


def raw_score(features: Column, mean: Sequence[float], spread: Sequence[float], weights: Sequence[float]) -> Column:
    return sum((F.lit(float(w)) * (F.get(features, i) - F.lit(float(mu))) / F.lit(float(sd))
                for i, (mu, sd, w) in enumerate(zip(mean, spread, weights))), F.lit(0.0))


def quality_score(features: Column, m: QualityModel | float) -> Column:
    if not isinstance(m, QualityModel):
        return F.lit(float(m))
    s = raw_score(features, m.mean, m.spread, m.weights) - F.lit(float(m.cut))
    at = float(np.log(m.threshold_score / (1 - m.threshold_score)))
    return 1 / (1 + F.exp(-(s / F.lit(m.scale) + F.lit(at))))


def score_quality(docs: DataFrame, labels: DataFrame, eligible: Column,
                  p: QualityParams = QualityParams()) -> DataFrame:
    """(doc_id, score) of every row."""
    features = feature_table(docs).checkpoint()
    model = fit_quality(features, labels, eligible, p)
    return features.select("doc_id", quality_score(F.col("features"), model).alias("score"))
