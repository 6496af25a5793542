"""Exact top-k by inner product with one KD-tree per shard.

Vectors are dealt into shards of about ``shard_rows``. Each shard builds a
KD-tree: median splits along the widest side, down to leaves of ``leaf_rows``,
every node with its tight bounding box. No vector in a box scores above

    sum_i max(q_i * low_i, q_i * high_i)

A query walks a tree best bound first and stops when no box can still reach its
kth score. That score is carried along: from the query's home shard, which is
searched first, to all others, and from shard to shard inside a task. It counts
distinct ids, whatever the lengths of their vectors.

Queries come in blocks of about ``block_rows``; each block meets each tree once.
Trees and blocks are rows of bounded size, written to the checkpoint folder, so a
lost executor costs only its own shards.

Scores are integer inner products, exact in 64 bits (float64 arithmetic where
it is exact, integer arithmetic beyond that). Equal scores rank by smaller id.
Vectors that are null or hold null or non-finite components take no part, nor
do rows without id. A candidate must have the query's length. Rows repeated
count once; ids with several vectors are judged by the best pair. An empty table
gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import heavy_values, prepare

LEAST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class TopKParams:
    k: int = 20
    shard_rows: int = 8192
    leaf_rows: int = 512
    block_rows: int = 128
    scale: int = 64


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, vec): floor(scale * x) of every component, without unusable rows."""
    v = F.col(vec_col).cast("array<double>")
    return (vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .filter("id is not null and v is not null")
            .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .select("id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("long")).alias("vec")))


# --- trees ------------------------------------------------------------------

class Tree:
    """A KD-tree in arrays: rows in leaf order; per node its box, row range and children (-1: leaf)."""

    def __init__(self, ids, rows, low, high, first, last, left, right):
        self.ids, self.rows, self.low, self.high = ids, rows, low, high
        self.first, self.last, self.left, self.right = first, last, left, right
        top = max((int(np.abs(x).max()) for x in (low, high) if x.size), default=0)
        self.top = top
        self.copies = int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else 1

    def pack(self) -> list[bytes]:
        return [x.tobytes() for x in (self.ids, self.rows, self.low, self.high, self.first, self.last, self.left, self.right)]

    @staticmethod
    def unpack(parts: list[bytes], dim: int) -> Tree:
        flat = [np.frombuffer(x, np.int64) for x in parts]
        for i in (1, 2, 3):
            flat[i] = flat[i].reshape(len(flat[0]) if i == 1 else len(flat[4]), dim)
        return Tree(*flat)


def build_tree(ids: np.ndarray, rows: np.ndarray, leaf_rows: int) -> Tree:
    """Median splits along the widest side of the tight box; equal points may fall on both sides."""
    order = np.arange(len(ids))
    low, high, first, last, left, right = [], [], [], [], [], []

    def add(a: int, b: int) -> int:
        part = rows[order[a:b]]
        low.append(part.min(axis=0))
        high.append(part.max(axis=0))
        first.append(a)
        last.append(b)
        left.append(-1)
        right.append(-1)
        return len(first) - 1

    todo = [add(0, len(ids))]
    while todo:
        node = todo.pop()
        a, b = first[node], last[node]
        if b - a <= leaf_rows or not rows.shape[1] or (low[node] == high[node]).all():
            continue
        axis = int(np.argmax(high[node] - low[node]))
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(rows[order[a:b], axis], mid)]
        left[node], right[node] = add(a, a + mid), add(a + mid, b)
        todo += [left[node], right[node]]
    ints = lambda x: np.array(x, np.int64)
    return Tree(ints(ids[order]), np.ascontiguousarray(rows[order]), ints(low), ints(high),
                ints(first), ints(last), ints(left), ints(right))


def search_block(tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int,
                 floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate id, score) of each query's best k, and none below its ``floor`` (a known kth score)."""
    dim = queries.shape[1]
    reach = max(int(np.abs(queries).max()) if queries.size else 0, 1) * max(tree.top, 1) * max(dim, 1)
    kind = np.float64 if reach < 1 << 52 else np.int64
    q, rows = queries.astype(kind), tree.rows.astype(kind)
    bounds = np.maximum(q, 0) @ tree.high.astype(kind).T + np.minimum(q, 0) @ tree.low.astype(kind).T
    left, right, first, last = (x.tolist() for x in (tree.left, tree.right, tree.first, tree.last))
    k_all = k * tree.copies  # an id with several vectors may take several places
    out_q, out_i, out_s = [], [], []
    for i in range(len(ids)):
        bound = bounds[i].tolist()
        kth = kind(floor[i]) if floor[i] != LEAST else -np.inf if kind is np.float64 else LEAST
        heap = [(-bound[0], 0)]
        best_s, best_i = np.zeros(0, kind), np.zeros(0, np.int64)
        while heap:
            b, node = heappop(heap)
            if -b < kth:
                break
            if left[node] >= 0:
                for child in (left[node], right[node]):
                    if bound[child] >= kth:
                        heappush(heap, (-bound[child], child))
                continue
            a, z = first[node], last[node]
            s = rows[a:z] @ q[i]
            ok = np.nonzero(s >= kth)[0]
            if not len(ok):
                continue
            own = tree.ids[a + ok]
            s, other = s[ok], own != ids[i]
            best_s, best_i = np.concatenate([best_s, s[other]]), np.concatenate([best_i, own[other]])
            if len(best_s) > k_all:
                top = np.lexsort((best_i, -best_s))[:k_all]
                best_s, best_i = best_s[top], best_i[top]
            if len(best_s) >= k_all:
                kth = max(kth, best_s.min())
        out_q.append(np.full(len(best_s), i))
        out_i.append(best_i)
        out_s.append(best_s.astype(np.int64))
    return (np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)) if out_q else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def kth_scores(n: int, q: np.ndarray, cand: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Per query row the kth best score over distinct candidates, LEAST where there are fewer."""
    out = np.full(n, LEAST)
    order = np.lexsort((-score, q))
    q, cand, score = q[order], cand[order], score[order]
    starts = np.searchsorted(q, np.arange(n + 1))
    for i in range(n):
        a, b = starts[i], starts[i + 1]
        if b - a >= k:
            seen = np.unique(cand[a:b], return_index=True)[1]
            if len(seen) >= k:
                out[i] = np.sort(score[a:b][np.sort(seen)])[::-1][k - 1]
    return out


# --- the distributed search -------------------------------------------------

TREE_COLS = ("ids", "rows", "low", "high", "first", "last", "left", "right")


def shard_trees(vecs: DataFrame, shards: int, p: TopKParams) -> DataFrame:
    """(dim, shard, ids, rows, ...): one tree per shard and vector length."""
    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        ids = pdf["id"].to_numpy(np.int64)
        rows = np.array(pdf["vec"].tolist(), np.int64).reshape(len(pdf), dim)
        both = np.unique(np.column_stack([ids, rows]), axis=0)
        tree = build_tree(both[:, 0], both[:, 1:], p.leaf_rows)
        return pd.DataFrame([[dim, int(key[1]), *tree.pack()]], columns=["dim", "shard", *TREE_COLS])

    kinds = ", ".join(f"`{c}` binary" for c in TREE_COLS)
    return (vecs.withColumn("dim", F.size("vec")).withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "id", "vec"), F.lit(shards)))
            .groupBy("dim", "shard").applyInPandas(build, f"dim int, shard long, {kinds}"))


def query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """(dim, block, qids, qvecs): about ``block_rows`` queries in one row."""
    return (queries.distinct().withColumn("dim", F.size("vec"))
            .withColumn("block", F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(blocks)))
            .groupBy("dim", "block").agg(F.array_sort(F.collect_list(F.struct("id", "vec"))).alias("qs"))
            .select("dim", "block", F.col("qs.id").alias("qids"), F.flatten("qs.vec").alias("qvecs")))


def search(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score, dim, block) of each (block, tree) pair; ``floors`` are the queries' scores to beat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beaten: dict[tuple[int, int], np.ndarray] = {}
        held: tuple[int, int] | None = None
        tree = None
        for b in batches:
            for r in range(b.num_rows):
                row = {n: b.column(n)[r] for n in b.schema.names}
                dim, block, shard = (row[n].as_py() for n in ("dim", "block", "shard"))
                if (dim, shard) != held:
                    tree = Tree.unpack([row[c].as_py() for c in TREE_COLS], dim)
                    held = dim, shard
                ids = row["qids"].values.to_numpy().astype(np.int64)
                vecs = row["qvecs"].values.to_numpy().astype(np.int64).reshape(len(ids), dim)
                floor = np.array([LEAST if x is None else x for x in row["floors"].as_py()], np.int64)
                if len(beaten) > 4096:
                    beaten.clear()
                floor = np.maximum(floor, beaten.get((dim, block), floor))
                q, cand, score = search_block(tree, ids, vecs, k, floor)
                floor = np.maximum(floor, kth_scores(len(ids), q, cand, score, k))
                beaten[dim, block] = floor
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[q]), pa.array(cand), pa.array(score), pa.array(np.full(len(q), dim, np.int32)),
                     pa.array(np.full(len(q), block, np.int64))],
                    ["query_id", "vec_id", "score", "dim", "block"])

    cols = ["dim", "block", "qids", "qvecs", "floors", "shard", *TREE_COLS]
    return pairs.select(*cols).mapInArrow(run, "query_id long, vec_id long, score long, dim int, block long")


def top_k(vectors: DataFrame, is_query: Column, p: TopKParams = TopKParams(),
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per query its k best other rows: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition over a column ``id``.
    """
    prepare(vectors.sparkSession)
    vecs = quantised(vectors, id_col, vec_col, p.scale)
    n = vecs.count()
    # rows repeated under one id would fill a shard: ids that many rows share are reduced to distinct rows first
    many = F.broadcast(heavy_values(vecs.groupBy("id").agg(F.count(F.lit(1)).alias("n")), n).select("id"))
    vecs = vecs.join(many, "id", "left_anti").unionByName(vecs.join(many, "id").distinct())
    shards = max(1, -(-n // p.shard_rows))
    trees = shard_trees(vecs, shards, p).checkpoint()
    queries = vecs.filter(is_query)
    blocks = query_blocks(queries, max(1, -(-queries.count() // p.block_rows))).checkpoint()

    # Each block first meets one tree, which gives every query a score to beat ...
    home = F.pmod(F.xxhash64(F.lit(7), "block"), F.lit(shards))
    nothing = F.transform("qids", lambda _: F.lit(None).cast("long"))
    seeded = search(blocks.withColumn("shard", home).withColumn("floors", nothing).join(trees, ["dim", "shard"]), p.k).checkpoint()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    # the kth of distinct candidates: an id found at several vector lengths counts once, as in the result
    first = (seeded.groupBy("query_id", "block", "vec_id").agg(F.max("score").alias("score"))
             .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == p.k)
             .groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("known")))
    floors = F.transform("qids", lambda x: F.try_element_at(F.coalesce("known", F.create_map().cast("map<bigint,bigint>")), x))
    # ... and then all the other trees.
    rest = (blocks.join(first, "block", "left").withColumn("floors", floors).drop("known")
            .withColumn("home", home).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
            .filter("shard <> home"))
    found = search(rest.join(trees, ["dim", "shard"]), p.k).unionByName(seeded)
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
