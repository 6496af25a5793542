"""KMeans search in batches: all models of all k and restarts advance together.

One iteration is one pass over the rows: Arrow batches meet the centres of every
model that still moves, and an aggregate with one row per centre (count, sums,
squared distance) gives the next centres. Models that have stopped moving drop
out. Seeding is k-means|| for all models together: two passes a round draw rows
in proportion to their squared distance from the candidates so far, one more
weighs the candidates, and the driver reduces each model's few candidates to k.

Only centres, candidates (about 2k a round and model) and one row per centre
reach the driver. Draws follow the seed, the partition and the batch, so a task
that runs again draws the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A model has converged when its centres' squared moves sum to no more than this share of the features' mean
# variance (the usual default of such searches).
MOVE = 1e-4
SEED_ROUNDS = 2


@dataclass(frozen=True)
class Centres:
    """A fitted model: its centres (one row each, in the order of the feature columns) and its cost."""

    names: tuple[str, ...]
    values: np.ndarray
    cost: float

    def label(self) -> Column:
        """The nearest centre's number (the smallest on ties) from the feature columns."""
        dist = F.array(*[sum(((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(self.names, row)), F.lit(0.0)) for row in self.values])
        return (F.array_position(dist, F.array_min(dist)) - 1).cast("int")

    def distance(self) -> Column:
        """The squared distance to the nearest centre."""
        return F.array_min(F.array(*[sum(((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(self.names, row)), F.lit(0.0))
                                     for row in self.values]))


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]) if width else np.zeros((batch.num_rows, 0))


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(rows, centres) squared distances, from differences: exact zeros, no cancellation."""
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        out += (x[:, j, None] - centres[None, :, j]) ** 2
    return out


def centre_sums(rows: DataFrame, models: list[np.ndarray], weigh_only: bool = False) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per model: rows, feature sums and cost of its centres' cells, by one pass over ``rows``."""
    names = rows.columns
    width, starts = len(names), np.cumsum([0] + [len(m) for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((starts[-1], width + 2))
        for batch in batches:
            x = matrix(batch, width)
            for model, at in zip(models, starts):
                d = squared(x, model)
                near = d.argmin(axis=1)
                total[at:at + len(model), 0] += np.bincount(near, minlength=len(model))
                total[at:at + len(model), 1] += np.bincount(near, d[np.arange(len(x)), near], len(model))
                if not weigh_only:
                    for j in range(width):
                        total[at:at + len(model), 2 + j] += np.bincount(near, x[:, j], len(model))
        hit = np.nonzero(total[:, 0])[0]
        yield pa.RecordBatch.from_arrays([pa.array(hit), *[pa.array(total[hit, j]) for j in range(width + 2)]],
                                         ["slot", "n", "cost", *[f"s{j}" for j in range(width)]])

    sums = [f"s{j}" for j in range(width)]
    found = (rows.mapInArrow(run, ", ".join(["slot long", "n double", "cost double", *[f"{s} double" for s in sums]]))
             .groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *sums)]).collect())
    table = np.zeros((starts[-1], width + 2))
    for r in found:
        table[r["slot"]] = r[1:]
    return [(table[a:b, 0], table[a:b, 2:], float(table[a:b, 1].sum())) for a, b in zip(starts, starts[1:])]


def draw(rows: DataFrame, models: list[np.ndarray], rate: np.ndarray, seed: int) -> list[np.ndarray]:
    """Per model: rows drawn with probability rate x squared distance from its candidates."""
    width = len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            x = matrix(batch, width)
            rng = np.random.default_rng([seed, part, number])
            for m, model in enumerate(models):
                hit = np.nonzero(rng.random(len(x)) < rate[m] * squared(x, model).min(axis=1))[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), m)), pa.array(x[hit].tolist(), pa.list_(pa.float64()))],
                                                 ["model", "row"])

    got: list[list] = [[] for _ in models]
    for r in rows.mapInArrow(run, "model long, row array<double>").collect():
        got[r["model"]].append(r["row"])
    return [np.array(sorted(g)).reshape(-1, width) for g in got]


def reduce_candidates(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted candidates, drawn as in k-means++, then moved by weighted Lloyd steps."""
    chosen = [candidates[rng.choice(len(candidates), p=weights / weights.sum())]]
    while len(chosen) < k:
        pull = weights * squared(candidates, np.array(chosen)).min(axis=1)
        if not pull.sum() > 0:  # fewer different rows than centres
            chosen.append(chosen[-1])
            continue
        chosen.append(candidates[rng.choice(len(candidates), p=pull / pull.sum())])
    centres = np.array(chosen)
    for _ in range(30):
        near = squared(candidates, centres).argmin(axis=1)
        mass = np.bincount(near, weights, k)
        moved = np.column_stack([np.bincount(near, weights * candidates[:, j], k) for j in range(candidates.shape[1])])
        moved = np.where(mass[:, None] > 0, moved / np.maximum(mass, 1e-300)[:, None], centres)
        if np.abs(moved - centres).max() <= MOVE:
            break
        centres = moved
    return centres


def seed_models(rows: DataFrame, kinds: list[int], seed: int) -> list[np.ndarray]:
    """First centres of one model for each k of ``kinds``, by k-means||."""
    names = rows.columns
    firsts = rows.orderBy(F.xxhash64(F.lit(seed), *names)).limit(len(kinds)).collect()
    if not firsts:
        raise ValueError("no rows to cluster")
    models = [np.array([list(firsts[m % len(firsts)])], float) for m in range(len(kinds))]
    for turn in range(SEED_ROUNDS):
        costs = np.array([cost for _, _, cost in centre_sums(rows, models, weigh_only=True)])
        rate = np.where(costs > 0, 2.0 * np.array(kinds) / np.maximum(costs, 1e-300), 0.0)
        models = [np.unique(np.vstack([old, new]), axis=0) for old, new in zip(models, draw(rows, models, rate, seed * 31 + turn))]
    weights = [n for n, _, _ in centre_sums(rows, models, weigh_only=True)]
    return [reduce_candidates(c, w, k, np.random.default_rng([seed, m]))
            for m, (c, w, k) in enumerate(zip(models, weights, kinds))]


def fit_all(rows: DataFrame, kinds: list[int], seed: int, iterations: int) -> list[Centres]:
    """One converged model for each k of ``kinds``; ``rows`` has the feature columns alone."""
    names = tuple(rows.columns)
    centres = seed_models(rows, kinds, seed)
    spread = rows.agg(*[F.coalesce(F.var_pop(c), F.lit(0.0)).alias(c) for c in names]).first()
    enough = MOVE * float(np.mean(list(spread)))
    costs = [0.0] * len(kinds)
    moving = list(range(len(kinds)))
    for turn in range(iterations + 1):
        still = []
        for m, (n, sums, cost) in zip(moving, centre_sums(rows, [centres[m] for m in moving])):
            costs[m] = cost  # of the centres as they are, before the step
            step = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[m])
            if turn < iterations and ((step - centres[m]) ** 2).sum() > enough:
                centres[m] = step
                still.append(m)
        moving = still
        if not moving:
            break
    return [Centres(names, c, cost) for c, cost in zip(centres, costs)]


def best_per_k(rows: DataFrame, ks, restarts: int, seed: int, iterations: int) -> dict[int, Centres]:
    """For each k the model of least cost among ``restarts``."""
    kinds = [int(k) for k in ks for _ in range(restarts)]
    out: dict[int, Centres] = {}
    for k, model in zip(kinds, fit_all(rows, kinds, seed, iterations)):
        if k not in out or model.cost < out[k].cost:
            out[k] = model
    return out
