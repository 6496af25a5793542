"""Mean silhouette with Euclidean distance, from all pairs of rows; or, if asked for, an estimate from samples.

All pairs (``silhouettes`` without ``t``): rows equal in features and labels are
one row with a number. These are dealt by their hash into blocks of at most
``BLOCK_ROWS`` rows; a task takes two blocks and adds up, for every row of both,
its distances to the other block's rows, per cluster of every labelling: a pair's
distance is taken once for all labellings. The sums of a row's block pairs give its
score. The work grows with the square of the rows, the shuffle with rows times blocks.

The estimate (``silhouettes`` with ``t``) is linear in the rows: each cluster is
sampled once: row j of cluster C stays with probability

    p_j = min(1, t x max(d(j, c) / W, 1 / |C|)),   c the cluster's mean, W the sum of all d(j, c),

at most 2t rows expected. The sum of d(x, j) / p_j over the sample estimates the
sum of x's distances to C without bias. As d(x, c) is at most x's mean distance to C
and W at most twice the sum of x's distances, d(x, j) is at most 3 p_j / t of that
sum for every x, near or far, so no row's estimate hangs on few sample rows. Clusters of
up to t rows are taken whole and are exact.

The bound: the estimates' variances (from the same sample) give each row's
standard errors of its mean distances; ``SIGMAS`` of them are carried through the
row's score and averaged. Rows share the sample, so errors are added, not averaged out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.kmeans import matrix, squared

BLOCK_ROWS = 65_536    # of all pairs: rows of a block
BLOCK_SUMS = 2 ** 21   # of all pairs: sums that a block's rows hold at once
LEAST_ROWS = 8_192     # of all pairs: blocks are no smaller for the sake of more tasks
TILE = 128, 256        # rows of two blocks that meet at once: their distances stay in a core's cache
NEAR = 1e-6            # share of the squared norms below which a squared distance is taken from differences
SIGMAS = 3.0
BLOCK = 512       # rows that meet a sample at once


def cluster_samples(features: DataFrame, names: list[str], labels: list[str], key: str, t: int,
                    max_clusters: int = 1000) -> dict[str, dict]:
    """Per labelling and cluster: (rows, sample as a matrix, probabilities)."""
    # features go by their number, so that no name of theirs can clash
    own = [f"x{j}" for j in range(len(names))]
    tall = features.select(F.col(key).alias("key"), *[F.col(c).alias(x) for c, x in zip(names, own)], F.explode(F.array(*[
        F.struct(F.lit(x).alias("by"), F.col(x).cast("string").alias("c")) for x in labels])).alias("l")).select("key", *own, "l.by", "l.c")
    # one row per labelling and cluster, at most max_clusters a labelling
    means = tall.groupBy("by", "c").agg(F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m_{x}") for x in own])
    near = tall.join(F.broadcast(means.limit(max_clusters * len(labels) + 1)), ["by", "c"]).withColumn(
        "d", F.sqrt(sum(((F.col(x) - F.col(f"m_{x}")) ** 2 for x in own), F.lit(0.0))))
    sums = near.groupBy("by", "c").agg(F.sum("d").alias("w"), F.count(F.lit(1)).alias("rows"))
    found = sums.limit(max_clusters * len(labels) + 1).collect()
    if len(found) > max_clusters * len(labels):
        raise ValueError(f"more than {max_clusters} clusters in a labelling")
    weights = features.sparkSession.createDataFrame(
        [(r["by"], r["c"], r["w"]) for r in found], "by string, c string, w double")
    p = F.least(F.lit(1.0), t * F.greatest(F.when(F.col("w") > 0, F.col("d") / F.col("w")).otherwise(0.0), 1 / F.col("n")))
    chance = F.xxhash64(F.lit(271828), "by", "key") / F.lit(2.0 ** 64) + 0.5
    drawn = (near.join(F.broadcast(weights), ["by", "c"]).withColumn("p", p).filter((F.col("p") >= 1) | (chance < F.col("p")))
             .select("by", "c", "p", *own).toPandas())
    out: dict[str, dict] = {x: {} for x in labels}
    for r in found:
        mine = drawn[(drawn["by"] == r["by"]) & (drawn["c"] == r["c"])]
        out[r["by"]][r["c"]] = (int(r["rows"]), mine[own].to_numpy(float), mine["p"].to_numpy(float))
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(rows of x, rows of y) distances by one matrix product; pairs too near for it by their differences."""
    norms = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
    d = norms - 2.0 * (x @ y.T)
    i, j = np.nonzero(d < 1e-4 * norms)
    d[i, j] = ((x[i] - y[j]) ** 2).sum(axis=1)
    return np.sqrt(np.maximum(d, 0.0))


def row_scores(x: np.ndarray, label: np.ndarray, clusters: dict) -> tuple[np.ndarray, np.ndarray]:
    """Silhouette and error of each row, given its cluster."""
    order = list(clusters)
    mean, error = np.empty((len(x), len(order))), np.empty((len(x), len(order)))
    own = np.zeros((len(x), len(order)), bool)
    for j, c in enumerate(order):
        n, sample, p = clusters[c]
        own[:, j] = label == c
        d = distances(x, sample)
        count = np.where(own[:, j], max(n - 1, 1), n)
        mean[:, j] = (d @ (1 / p)) / count
        error[:, j] = SIGMAS * np.sqrt((d * d) @ ((1 - p) / p ** 2)) / count
    return scores(mean, error, own, np.array([clusters[c][0] for c in order]))


def scores(mean: np.ndarray, error: np.ndarray, own: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Silhouette and error of each row, from its mean distances to the clusters, their errors, its own cluster and the clusters' rows."""
    a, a_error = mean[own], error[own]
    others = np.where(own, np.inf, mean)
    nearest = others.argmin(axis=1)
    b = others[np.arange(len(mean)), nearest]
    b_error = np.where(own, 0.0, error).max(axis=1)  # of any other cluster, as another may be the true nearest
    most = np.maximum(a, b)
    alone = size[own.argmax(axis=1)] == 1
    score = np.where(alone | (most == 0), 0.0, (b - a) / np.where(most == 0, 1.0, most))
    # moving the larger mean by e changes the score by less / most times e / most, the smaller by e / most
    less = np.minimum(a, b)
    larger_error, smaller_error = np.where(a > b, a_error, b_error), np.where(a > b, b_error, a_error)
    spread = np.where(most == 0, 0.0, (smaller_error + less / np.where(most == 0, 1.0, most) * larger_error) / np.where(most == 0, 1.0, most))
    return score, np.where(alone, 0.0, np.minimum(spread, 2.0))


def runs(slots: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(from, to, slots) of consecutive rows with equal slots."""
    edges = np.flatnonzero((slots[1:] != slots[:-1]).any(axis=1)) + 1
    return [(i, j, slots[i]) for i, j in pairwise([0, *edges.tolist(), len(slots)])] if len(slots) else []


def tiles(rows: int, step: int, parts: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int, list]]:
    """(from, to, the (run, from, to) inside it) of every ``step`` rows."""
    out, first = [], 0
    for i in range(0, rows, step):
        j = min(i + step, rows)
        while parts[first][1] <= i:
            first += 1
        last = first
        while last + 1 < len(parts) and parts[last + 1][0] < j:
            last += 1
        out.append((i, j, [(g, max(parts[g][0], i) - i, min(parts[g][1], j) - i) for g in range(first, last + 1)]))
    return out


def block_sums(x: np.ndarray, n: np.ndarray, x_slots: np.ndarray, y: np.ndarray, m: np.ndarray, y_slots: np.ndarray,
               width: int, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """(slots, rows) sums of each row's distances to the other block's rows, for the rows of x and, if ``both``, of y.

    A row counts n (or m) times and in each of its slots, one per labelling. Rows of equal slots stand together.
    """
    centre = (x.mean(axis=0) + y.mean(axis=0)) / 2
    x, y = x - centre, y - centre
    x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
    left, right = np.column_stack([x, x2, np.ones(len(x))]), np.vstack([-2.0 * y.T, np.ones(len(y)), y2])
    of_x, of_y = np.zeros((width, len(x))), np.zeros((width, len(y) if both else 0))
    x_runs, y_runs = runs(x_slots), runs(y_slots)
    spread = np.zeros((width, len(y_runs)))  # a run's sums go to each of its slots
    for g, (_, _, slot) in enumerate(y_runs):
        spread[slot, g] = 1.0
    room = np.empty(TILE[0] * TILE[1])
    columns = [(k, l, parts, right[:, k:l].copy(), y2[k:l].max()) for k, l, parts in tiles(len(y), TILE[1], y_runs)]
    for i, j, x_parts in tiles(len(x), TILE[0], x_runs):
        x_most, mine, theirs = x2[i:j].max(), np.zeros((len(y_runs), j - i)), np.zeros((len(x_parts), of_y.shape[1]))
        for k, l, y_parts, turned, y_most in columns:
            d = room[:(j - i) * (l - k)].reshape(j - i, l - k)
            np.dot(left[i:j], turned, out=d)
            least = NEAR * (x_most + y_most)
            if not d.min() > least:  # too near for a difference of norms
                near = np.flatnonzero(~(d > least))
                if len(near) > d.size // 16:
                    d[:] = squared(x[i:j], y[k:l])
                else:
                    r, c = np.divmod(near, l - k)
                    d[r, c] = ((x[i + r] - y[k + c]) ** 2).sum(axis=1)
            np.sqrt(d, out=d)
            for g, a, b in y_parts:
                mine[g] += d[:, a:b] @ m[k + a:k + b]
            if both:
                for p, (_, a, b) in enumerate(x_parts):
                    theirs[p, k:l] = n[i + a:i + b] @ d[a:b]
        of_x[:, i:j] = spread @ mine
        if both:
            for (g, _, _), sums in zip(x_parts, theirs):
                of_y[x_runs[g][2]] += sums
    return of_x, of_y


def all_pairs(features: DataFrame, names: list[str], labels: list[str], max_clusters: int = 1000) -> dict[str, float]:
    """Per labelling: the mean Euclidean silhouette, from all pairs of rows."""
    # features and labels go by their number, so that no name of theirs can clash
    own, marks = [f"x{j}" for j in range(len(names))], [f"l{k}" for k in range(len(labels))]
    rows = features.select(*[F.col(c).cast("double").alias(x) for c, x in zip(names, own)],
                           *[F.col(c).cast("string").alias(x) for c, x in zip(labels, marks)]).groupBy(*own, *marks).agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        # one row per labelling and cluster, at most max_clusters a labelling
        found = (rows.select("n", F.explode(F.array(*[F.struct(F.lit(k).alias("by"), F.col(x).alias("c")) for k, x in enumerate(marks)])).alias("l"))
                 .groupBy("l.by", "l.c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).limit(max_clusters * len(labels) + 1).collect())
        if len(found) > max_clusters * len(labels):
            raise ValueError(f"more than {max_clusters} clusters in a labelling")
        if any(r["c"] is None for r in found):
            raise ValueError("a row has no cluster")
        sizes = [{r["c"]: r["n"] for r in found if r["by"] == k} for k in range(len(labels))]
        if any(len(s) < 2 for s in sizes):
            raise ValueError("silhouette needs at least two clusters")
        total = sum(r["kinds"] for r in found if r["by"] == 0)
        slots = sum(len(s) for s in sizes)
        most = max(1024, min(BLOCK_ROWS, BLOCK_SUMS // slots))
        tasks = ceil((8 * features.sparkSession.sparkContext.defaultParallelism) ** 0.5)  # blocks whose pairs are four tasks a core
        blocks = max(ceil(total / most), min(tasks, ceil(total / LEAST_ROWS)))
        sums = _pair_sums(rows, own, marks, sizes, blocks)
        return dict(zip(labels, _mean_scores(sums, marks, sizes)))
    finally:
        rows.unpersist()


def _pair_sums(rows: DataFrame, own: list[str], marks: list[str], sizes: list[dict], blocks: int) -> DataFrame:
    """Per row (block, its place there, number, its cluster's slot in each labelling): its distances' sums, one column a slot."""
    starts = np.cumsum([0] + [len(s) for s in sizes]).tolist()
    slot = [(F.array_position(F.lit(list(s)), F.col(x)) + F.lit(at - 1)).cast("int").alias(x) for s, x, at in zip(sizes, marks, starts)]
    width = starts[-1]
    cells = [f"s{j}" for j in range(width)]
    kept = ["block", "place", "n", *marks]

    def run(table: pa.Table) -> pa.Table:
        low, high = divmod(table.column("pair")[0].as_py(), blocks)
        block = table.column("block").to_numpy()
        x = np.column_stack([table.column(c).to_numpy() for c in own]) if own else np.zeros((len(block), 0))
        marked = np.column_stack([table.column(c).to_numpy() for c in marks])
        n = table.column("n").to_numpy().astype(float)
        sides = []
        for b in sorted({low, high}):
            at = np.flatnonzero(block == b)
            # the same order in every task that has the block, so that a row's place names it
            at = at[np.lexsort([*x[at].T[::-1], *marked[at].T[::-1]])]
            sides.append((x[at], n[at], marked[at]))
        first, second = sides[0], sides[-1]
        got = [np.zeros((width, len(s[1]))) for s in sides]  # of a block alone in its table
        if len(first[1]) and len(second[1]):
            got = block_sums(*first, *second, width, low != high)
        out = [pa.table([pa.array(np.full(len(m), b, np.int32)), pa.array(np.arange(len(m), dtype=np.int32)), pa.array(m),
                         *[pa.array(k[:, j]) for j in range(len(marks))], *[pa.array(g[j]) for j in range(width)]], names=[*kept, *cells])
               for b, (_, m, k), g in zip(sorted({low, high}), sides, got)]
        return pa.concat_tables(out)

    dealt = rows.select(*own, *slot, "n", F.pmod(F.xxhash64(*own, *marks), F.lit(blocks)).cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    paired = dealt.select("*", other).select(
        *own, *marks, "n", "block", (F.least("block", "other") * F.lit(blocks) + F.greatest("block", "other")).alias("pair"))
    # a number stated, as each group is little to read and much to do; several times the pairs, so that few share a task
    return (paired.repartition(2 * blocks * (blocks + 1), "pair").groupBy("pair")
            .applyInArrow(run, ", ".join(["block int, place int, n double", *[f"{x} int" for x in marks], *[f"{c} double" for c in cells]]))
            .groupBy(*kept).agg(*[F.sum(c).alias(c) for c in cells]))


def _mean_scores(sums: DataFrame, marks: list[str], sizes: list[dict]) -> list[float]:
    """Per labelling the mean score of the rows of ``_pair_sums``."""
    starts = np.cumsum([0] + [len(s) for s in sizes])
    cells = [f"s{j}" for j in range(starts[-1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(marks), 2))
        for batch in batches:
            table = matrix(batch, 1 + len(marks) + len(cells))
            n, slot, all_sums = table[:, 0], table[:, 1:1 + len(marks)], table[:, 1 + len(marks):]
            for k, size in enumerate(sizes):
                rows = np.array(list(size.values()), float)
                mine = slot[:, k, None] == np.arange(starts[k], starts[k + 1])[None]
                mean = all_sums[:, starts[k]:starts[k + 1]] / np.where(mine, np.maximum(rows - 1, 1), rows)
                total[k] += (n.sum(), n @ scores(mean, np.zeros_like(mean), mine, rows)[0])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(marks))), *[pa.array(total[:, j]) for j in range(2)]], ["by", "n", "score"])

    found = (sums.select("n", *marks, *cells).mapInArrow(run, "by long, n double, score double")
             .groupBy("by").agg(F.sum("n").alias("n"), F.sum("score").alias("score")).collect())
    means = {r["by"]: r["score"] / r["n"] for r in found}
    return [means[k] for k in range(len(marks))]


def silhouettes(features: DataFrame, names: list[str], labels: list[str], key: str, t: int | None = None) -> dict[str, tuple[float, float]]:
    """Per labelling (a column of ``features``): mean Euclidean silhouette and its error bound.

    From all pairs of rows, with 0 as the bound; with ``t`` from samples of the
    clusters (see above). A labelling of one cluster is an error.
    """
    if t is None:
        return {x: (score, 0.0) for x, score in all_pairs(features, names, labels).items()}
    # three passes for the samples, one for the scores
    samples = cluster_samples(features, names, labels, key, t)
    if any(len(s) < 2 for s in samples.values()):
        raise ValueError("silhouette needs at least two clusters")
    shared = features.sparkSession.sparkContext.broadcast(samples)
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(labels), 3))
        for batch in batches:
            x = matrix(batch, width)
            for k, by in enumerate(labels):
                label = np.array(batch.column(width + k).to_pylist(), object)
                for at in range(0, len(x), BLOCK):
                    score, error = row_scores(x[at:at + BLOCK], label[at:at + BLOCK], shared.value[by])
                    total[k] += (len(score), score.sum(), error.sum())
        yield pa.RecordBatch.from_arrays([pa.array(labels), *[pa.array(total[:, j]) for j in range(3)]], ["by", "n", "score", "error"])

    rows = (features.select(*names, *[F.col(x).cast("string").alias(x) for x in labels]).mapInArrow(run, "by string, n double, score double, error double")
            .groupBy("by").agg(F.sum("n").alias("n"), F.sum("score").alias("score"), F.sum("error").alias("error")).collect())
    return {r["by"]: (r["score"] / r["n"], r["error"] / r["n"]) for r in rows}
