"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed toxic; everything else is unlabelled text, a
mixture that holds toxic documents too. With class prior pi and loss l the risk
of a scorer g is

    pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

The second part estimates the risk on clean text from the mixture; where it
falls below zero (overfitting), the step goes the other way. Several numpy
logistic classifiers are trained this way, each in a task of its own on the
positives and its own draw of unlabelled documents, and their weights averaged.

A document's features are the words of its whole text and their 4 to 6 byte
beginnings, hashed. Each counts twice: as occurrences per ``UNIT`` words (short
texts are eased by ``EASE`` words more) and, where that is no coincidence, as
occurrences up to ``FEW``, which a long harmless remainder does not dilute. The
fit keeps features that are, by the class prior, mostly in positives and found in
at least ``min_share`` of these or, however rare, in more of them than chance
explains; of those the ``features`` with the largest mean amount. The score is the logistic of the weighted sum.

Fitting reads a bounded sample (``max_positive`` and ``bags`` times
``max_unlabelled`` documents, smallest hashes of their ids first); scoring reads
every document. Null or empty text has no features and gets the base score. Null
ids are scored, never fitted on. Null labels say nothing; several labels of one
document make it positive if one does. Without positives or other documents to
learn from, every score is the class prior or 0. Rows repeated are scored each.
An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare
from marquee.llm.decontaminate import text_hash, words_of

PREFIXES = (4, 5, 6)
SPACE = (1 << 22) - 1
CACHE = 1 << 17
UNIT, EASE, FEW = 100, 50, 3


@dataclass(frozen=True)
class ToxicParams:
    max_positive: int = 3000
    max_unlabelled: int = 4000
    bags: int = 3
    features: int = 512
    min_share: float = 0.02
    min_purity: float = 0.6
    min_evidence: float = 12.0
    steps: int = 400
    rate: float = 0.1
    l2: float = 1e-4


@dataclass(frozen=True)
class ToxicModel:
    """Weights of hashed features, by amount and by occurrence, and the bias."""
    weights: dict[int, tuple[float, float]]
    bias: float


def word_features(word: bytes) -> tuple[int, ...]:
    return (crc32(word) & SPACE, *(crc32(word[:k] + b"*") & SPACE for k in PREFIXES if len(word) > k))


def text_features(data: bytes) -> tuple[dict[int, int], int]:
    """Feature -> occurrences, and the number of words."""
    words = words_of(data)
    out: dict[int, int] = {}
    for w, n in Counter(words).items():
        for f in word_features(w):
            out[f] = out.get(f, 0) + n
    return out, len(words)


def feature_rows(docs: DataFrame) -> DataFrame:
    """(bag, positive, features, counts, words) of the sampled documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats = [text_features(t or b"") for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([list(x) for x, _ in feats], pa.list_(pa.int32())),
                 pa.array([list(x.values()) for x, _ in feats], pa.list_(pa.int32())), pa.array([n for _, n in feats], pa.int64())],
                ["bag", "positive", "features", "counts", "words"])

    own = docs.select("bag", "positive", F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(run, "bag int, positive boolean, features array<int>, counts array<int>, words long")


Rows = list[tuple[np.ndarray, np.ndarray, float]]  # features, occurrences, UNIT / (words + EASE)


def totals(rows: Rows, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per feature: how many rows have it, and its mean amount over all rows."""
    place = np.searchsorted(ids, np.concatenate([np.zeros(0, np.int32), *(r[0] for r in rows)]))
    amounts = np.concatenate([np.zeros(0), *(r[1] * r[2] for r in rows)])
    return (np.bincount(place, minlength=len(ids)),
            np.bincount(place, weights=amounts, minlength=len(ids)) / len(rows))


def chosen_features(pos: Rows, unl: Rows, prior: float, p: ToxicParams) -> tuple[np.ndarray, np.ndarray]:
    """Features whose amount in unlabelled text the positives in it explain, most telling first, and which of them may count by occurrence.

    The latter need presence that is as pure, and evidence beyond chance: the
    positives times the divergence of the two presence rates (the exponent of
    the chance that so many positives have the feature at the unlabelled rate).
    The same evidence admits features of less than ``min_share``.
    """
    ids = np.unique(np.concatenate([np.zeros(0, np.int32), *(r[0] for r in (*pos, *unl))]))
    (in_p, mean_p), (in_u, mean_u) = totals(pos, ids), totals(unl, ids)
    purity = prior * mean_p / np.maximum(mean_u, 1e-12)
    a, b = np.minimum(in_p / len(pos), 1 - 1e-9), np.minimum((in_u + 1) / (len(unl) + 1), 1 - 1e-9)
    evidence = len(pos) * (a * np.log(np.maximum(a, 1e-300) / b) + (1 - a) * np.log((1 - a) / (1 - b)))
    shown = (a > b) & (evidence >= p.min_evidence)
    fit = (in_p >= 2) & ((in_p >= p.min_share * len(pos)) | shown) & (purity >= p.min_purity)
    gain = np.where(fit, mean_p, 0)
    best = np.argsort(-gain, kind="stable")[:p.features]
    best = np.sort(best[gain[best] > 0])
    return ids[best], (shown & (prior * a / b >= p.min_purity))[best]


def dense(rows: Rows, chosen: np.ndarray, by_count: np.ndarray) -> np.ndarray:
    """Matrix of the chosen features' amounts, then their occurrences (0 where these don't count), and ones for the bias."""
    k = len(chosen)
    x = np.zeros((len(rows), 2 * k + 1), np.float32)
    x[:, -1] = 1
    if k:
        for i, (f, count, scale) in enumerate(rows):
            at = np.minimum(np.searchsorted(chosen, f), k - 1)
            hit = chosen[at] == f
            x[i, at[hit]] = count[hit] * scale
            x[i, k + at[hit]] = np.minimum(count[hit], FEW) / FEW * by_count[at[hit]]
    return x


def fit_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int, rate: float, l2: float) -> np.ndarray:
    """Weights minimising the non-negative PU risk with logistic loss, by Adam on the full sample."""
    w = np.zeros(xp.shape[1], np.float64)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    pen = np.full_like(w, l2)
    pen[-1] = 0
    for t in range(1, steps + 1):
        gp, gu = xp @ w.astype(np.float32), xu @ w.astype(np.float32)
        sp, su = 1 / (1 + np.exp(-np.clip(gp, -30, 30))), 1 / (1 + np.exp(-np.clip(gu, -30, 30)))
        # loss log(1 + e^-g) on positives as positives; log(1 + e^g) as negatives
        clean_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        on_pos = prior * (xp.T @ (sp - 1)) / len(xp)
        on_clean = (xu.T @ su) / len(xu) - prior * (xp.T @ sp) / len(xp)
        grad = (on_pos + on_clean if clean_risk >= 0 else -on_clean) + pen * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def training_sample(docs: DataFrame, labels: DataFrame, eligible: Column, p: ToxicParams) -> DataFrame:
    """(bag, positive, text) of the sampled documents: positives in every bag, unlabelled ones dealt to one.

    Ids are chosen first (smallest hashes, so at most the stated numbers); the
    chosen ids, bounded by the parameters, are broadcast to the documents. Of the
    rows that repeat an id the one with the smallest text is taken.
    """
    order = F.xxhash64(F.lit(11), "doc_id")
    pos = (labels.filter("toxic = 1 and doc_id is not null").filter(eligible).select("doc_id").distinct()
           .join(docs.select("doc_id"), "doc_id", "left_semi")
           .orderBy(order, "doc_id").limit(p.max_positive)
           .select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(p.bags - 1))).alias("bag"), F.lit(True).alias("positive")))
    # the limit counts ids, not rows; repeated ones combine before the shuffle
    unl = (docs.filter("doc_id is not null").filter(eligible).select("doc_id").distinct()
           .orderBy(order, "doc_id").limit(p.max_unlabelled * p.bags)
           .select("doc_id", F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(p.bags)).cast("int").alias("bag"),
                   F.lit(False).alias("positive")))
    chosen = pos.unionByName(unl).checkpoint()
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min("text").alias("text")))
    return texts.join(F.broadcast(chosen), "doc_id").select("bag", "positive", "text")


def fit_toxicity(docs: DataFrame, labels: DataFrame, eligible: Column, p: ToxicParams = ToxicParams(),
                 prior: float | None = None) -> ToxicModel:
    """Train the classifiers. ``eligible`` (over doc_id) says which rows may be learned from.

    The class prior is the share of toxic ones among the eligible labels unless given.
    """
    prepare(docs.sparkSession)
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    if prior is None:
        per_doc = labels.filter(eligible & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("t"))
        prior = per_doc.agg(F.avg(F.col("t").cast("double"))).first()[0] or 0.0
    if not 0 < prior < 1:
        return ToxicModel({}, -30.0 if prior <= 0 else 30.0)
    share = float(prior)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(np.asarray(f, np.int32), np.asarray(c, np.int64), UNIT / (n + EASE))
                for f, c, n in zip(pdf["features"], pdf["counts"], pdf["words"])]
        pos = [r for r, y in zip(rows, pdf["positive"]) if y]
        unl = [r for r, y in zip(rows, pdf["positive"]) if not y]
        if not pos or not unl:
            return pd.DataFrame({"feature": [-1], "weight": [np.log(share / (1 - share))], "few": [0.0]})
        chosen, by_count = chosen_features(pos, unl, share, p)
        w = fit_nnpu(dense(pos, chosen, by_count), dense(unl, chosen, by_count), share, p.steps, p.rate, p.l2)
        k = len(chosen)
        return pd.DataFrame({"feature": [*chosen.tolist(), -1], "weight": [*w[:k], w[-1]], "few": [*w[k:2 * k], 0.0]})

    rows = feature_rows(training_sample(docs, labels, eligible, p))
    fitted = rows.groupBy("bag").applyInPandas(fit, "feature int, weight double, few double").collect()  # bags * (features + 1) rows
    bags = max(1, sum(r["feature"] == -1 for r in fitted))
    sums: dict[int, tuple[float, float]] = {}
    for r in fitted:
        a, f = sums.get(r["feature"], (0.0, 0.0))
        sums[r["feature"]] = a + r["weight"] / bags, f + r["few"] / bags
    bias, _ = sums.pop(-1, (float(np.log(share / (1 - share))), 0.0))
    return ToxicModel(sums, bias)


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """(doc_id, text_hash, score) of every row, from its whole text."""
    prepare(docs.sparkSession)
    # plain values: executors need not know the model's class
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        known: dict[bytes, tuple[int, ...]] = {}

        def marks(word: bytes) -> tuple[int, ...]:
            if len(known) > CACHE:
                known.clear()
            got = known[word] = tuple(f for f in word_features(word) if f in weights)
            return got

        for b in batches:
            scores = []
            for t in b.column(2).to_pylist():
                words = words_of(t or b"")
                hits: dict[bytes, tuple[int, ...]] = {}
                for w in set(words):
                    hit = known.get(w)
                    if hit is None:
                        hit = marks(w)
                    if hit:
                        hits[w] = hit
                # most texts have no marked word, many marked ones are counted in one go
                often = Counter(w for w in words if w in hits) if hits else {}
                counts: dict[int, int] = {}
                for w, n in often.items():
                    for f in hits[w]:
                        counts[f] = counts.get(f, 0) + n
                scale = UNIT / (len(words) + EASE)
                scores.append(bias + sum(weights[f][0] * n * scale + weights[f][1] * min(n, FEW) / FEW
                                         for f, n in sorted(counts.items())))
            g = np.clip(np.array(scores, np.float64), -500, 500)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(1 / (1 + np.exp(-g)))],
                                             ["doc_id", "text_hash", "score"])

    own = docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, text_hash bigint, score double")


def drop_toxic(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """The documents scored below the threshold, all columns kept."""
    bad = (score_toxicity(docs, model).filter(F.col("score") >= threshold)
           .select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["g_id"]) & (text_hash() == bad["g_hash"]), "left_anti")
