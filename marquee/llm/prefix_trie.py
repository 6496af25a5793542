"""Prefix trie of conversations: range minima over sorted LCPs give each prefix its interval of members.

Conversations become sequences of 128-bit turn hashes. Equal sequences are
merged (copies are counted, not repeated) and the distinct ones sorted. In
sorted order the conversations that share a prefix stand side by side. A sorted
run is cut into pieces of about ``piece_turns`` turns; per piece, numpy takes the
LCPs of neighbours, builds a sparse table of their minima, and every candidate
prefix binary-searches its left and its right extent in it, each for itself: no
stack, no order among prefixes. Members, smallest member, leaves and savings of
the interval are differences of running sums and range minima.

Only prefixes of a piece's first or last sequence can have members beyond the
piece. Such edge nodes leave the piece as partial sums under a 128-bit hash of
the prefix and are put together by Spark aggregates; what lies below an edge
node is summed along the chain of prefixes it stands on.

A group of copies however large is one sequence with a count; the digest of its
ids is streamed over range-sorted chunks, never held. A common first turn only
makes wide intervals. One conversation's turns (20 bytes each, without text)
travel in one row.

Turns are ordered by turn (null first), role and text; null role or text becomes
empty; rows repeated are turns each; rows without conv_id belong to no
conversation and are left out. An empty table gives no nodes. Only conv_id,
turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import prepare

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SORT_TURNS = 64  # turns of a sequence that decide its partition; inside it the whole sequence counts


@dataclass(frozen=True)
class TrieParams:
    piece_turns: int = 1 << 18


# --- sequences --------------------------------------------------------------

def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs (h1, h2, words)."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = (conversations.filter("conv_id is not null")
            .select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
            .withColumn("pos", F.row_number().over(order))
            .select("conv_id", F.struct(
                "pos", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(7919), "role", "text").alias("h2"),
                F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).alias("words")).alias("t")))
    # the window's partitioning serves this aggregate too; a group is one conversation without its text
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["h1"].alias("h1"), t["h2"].alias("h2"), t["words"].alias("words")))
        .alias("turns"))


def share_openings(sequences: DataFrame, every: int = 20, spread: int = 4) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c % every, then its own after its first h.

    h = crc32(c as text) % spread. Where that conversation is absent its turns are none.
    A remainder has the sign of c, as in SQL.
    """
    heads = sequences.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, spread - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    none = F.slice("turns", 1, 0)
    return (sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(heads, "base", "left")
            .withColumn("h", h)
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns")))


# --- digests of ids, streamed ----------------------------------------------

def id_digests(members: DataFrame) -> DataFrame:
    """(k1, k2, ids_sha256): SHA-256 of each key's conv_ids, ascending, comma-joined.

    Ids are range-sorted, so a large group is sorted and joined to chunks by many
    tasks; the chunks then pass through one running digest per group.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(ids):
                continue
            starts = np.nonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])[0]
            ends = np.r_[starts[1:], len(ids)]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(k1[starts]), pa.array(k2[starts]), pa.array(ids[starts]), pa.array(texts)],
                                             ["k1", "k2", "at", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if now == (k1, k2):
                    running.update(b",")
                else:
                    if now is not None:
                        done.append((*now, running.hexdigest()))
                    now, running = (k1, k2), hashlib.sha256()
                running.update(ids.encode())
            yield table(done)
        if now is not None:
            yield table([(*now, running.hexdigest())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                          ["k1", "k2", "ids_sha256"])

    ranged = members.select("k1", "k2", "conv_id").repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    return (ranged.mapInArrow(chunks, "k1 long, k2 long, at long, ids string")
            .repartition("k1", "k2").sortWithinPartitions("k1", "k2", "at")
            .mapInArrow(digest, "k1 long, k2 long, ids_sha256 string"))


# --- one sorted piece -------------------------------------------------------

def neighbour_lcps(turns: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """lcp[i]: turns shared by sequences i - 1 and i; lcp[0] = -1. ``turns`` is (all turns, 2)."""
    upto = np.minimum(lengths[1:], lengths[:-1])
    lcp = np.r_[-1, upto]
    if upto.sum():
        place = np.arange(int(upto.sum())) - np.repeat(np.cumsum(upto) - upto, upto)
        pair = np.repeat(np.arange(len(upto)), upto)
        apart = (turns[starts[pair] + place] != turns[starts[pair + 1] + place]).any(axis=1)
        np.minimum.at(lcp, pair[apart] + 1, place[apart])
    return lcp


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """levels[k][i] = min(values[i : i + 2^k])."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        last, step = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[:-step], last[step:]))
    return levels


def range_min(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """min(values[left .. right]), both ends included."""
    k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), levels[0].dtype)
    for level in np.unique(k).tolist():
        at = k == level
        row = levels[level]
        out[at] = np.minimum(row[left[at]], row[right[at] - (1 << level) + 1])
    return out


def extents(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The widest [left, right] around each ``at`` whose LCPs are all at least ``depth``, by binary search on both sides."""
    left, right = at.copy(), at.copy()
    m = len(levels[0])
    for k in reversed(range(len(levels))):
        step, row = 1 << k, levels[k]
        ahead = np.nonzero(right + step <= m - 1)[0]
        ahead = ahead[row[right[ahead] + 1] >= depth[ahead]]
        right[ahead] += step
        back = np.nonzero(left - step >= 0)[0]
        back = back[row[left[back] - step + 1] >= depth[back]]
        left[back] -= step
    return left, right


def prefix_keys(turns: np.ndarray) -> np.ndarray:
    """(len + 1, 2) polynomial hashes of all prefixes of one sequence."""
    out = np.zeros((len(turns) + 1, 2), np.uint64)
    for c, base in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        powers = np.cumprod(np.full(len(turns), base, np.uint64))
        out[1:, c] = np.cumsum(turns[:, c].view(np.uint64) * powers)
    return out.view(np.int64)


NODE_SCHEMA = ("edge boolean, place long, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, "
               "n_leaves long, saved_tokens long, words long, ends_sha256 string, k1 long, k2 long, p1 long, p2 long")


def piece_nodes(turns: np.ndarray, words: np.ndarray, lengths: np.ndarray, n: np.ndarray, least: np.ndarray,
                shas: np.ndarray, place: int) -> dict[str, np.ndarray]:
    """Rows of NODE_SCHEMA for one sorted piece of distinct sequences.

    Inner nodes are whole; one whose parent is an edge node names the parent's
    place and has no parent_conv_id yet. Edge nodes come once per chain (even
    place: prefixes of the first sequence, odd: of the last), with their sums
    in one of them.
    """
    m = len(lengths)
    starts = np.cumsum(lengths) - lengths
    lcp = neighbour_lcps(turns, starts, lengths)
    levels, least_levels = sparse_table(lcp), sparse_table(least)
    # candidates: of each sequence the prefixes that it does not share with the one before
    count = lengths - lcp
    first = np.cumsum(count) - count
    pos = np.repeat(np.arange(m), count)
    depth = np.arange(len(pos)) - first[pos] + lcp[pos] + 1
    left, right = extents(levels, pos, depth)
    upto = np.r_[0, np.cumsum(n)]
    n_convs = upto[right + 1] - upto[left]
    conv = range_min(least_levels, left, right)
    last_words = np.zeros(len(pos), np.int64)
    deep = depth > 0
    last_words[deep] = words[starts[pos[deep]] + depth[deep] - 1]
    edge = (left == 0) | (right == m - 1)
    inner = ~edge
    leaf = np.r_[lcp[1:] < lengths[:-1], True]
    leaf[[0, -1]] = False  # those nodes are edges
    leaves = np.r_[0, np.cumsum(leaf)]
    own = np.where(inner, (n_convs - 1) * last_words, 0)
    saved = np.r_[0, np.cumsum(own)]
    ends = np.r_[first, len(pos)]
    below = ends[right + 1]  # candidates of a subtree lie together
    n_leaves = leaves[right + 1] - leaves[left]
    saved_tokens = saved[below] - saved[np.arange(len(pos))]
    up_left, up_right = extents(levels, pos, np.maximum(depth - 1, 0))
    up_conv = range_min(least_levels, up_left, up_right)
    up = first[up_left] + depth - 1 - lcp[up_left] - 1
    under_edge = inner & ((up_left == 0) | (up_right == m - 1))
    children = np.bincount(up[inner], minlength=len(pos))
    ended = depth == lengths[pos]
    sha = np.where(ended, shas[pos], None)
    zero = np.zeros(len(pos), np.int64)
    every = {"edge": edge, "place": np.where(under_edge, 2 * place + (up_left > 0), -1), "depth": depth, "conv_id": conv,
             "parent_conv_id": up_conv, "n_convs": n_convs, "n_children": children, "n_leaves": n_leaves,
             "saved_tokens": saved_tokens, "words": last_words, "ends_sha256": sha,
             "k1": zero, "k2": zero, "p1": zero, "p2": zero}
    out = [{k: v[inner] for k, v in every.items()}]
    for side, whole in ((0, edge & (left == 0)), (1, edge & (right == m - 1))):
        if side and m == 1:
            continue
        # the chain's nodes are candidates of the sequence itself or of those before it; by depth they are 0, 1, 2, ...
        chain = np.nonzero(whole)[0]
        chain = chain[np.argsort(depth[chain], kind="stable")]
        seq = 0 if side == 0 else m - 1
        keys = prefix_keys(turns[starts[seq]:starts[seq] + lengths[seq]])
        rows = {k: v[chain] for k, v in every.items()}
        again = side == 1
        twice = (left[chain] == 0) & again
        for k in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            rows[k] = np.where(twice, 0, rows[k])
        rows["place"] = np.full(len(chain), 2 * place + side)
        rows["k1"], rows["k2"] = keys[:, 0], keys[:, 1]
        rows["p1"], rows["p2"] = np.r_[0, keys[:-1, 0]], np.r_[0, keys[:-1, 1]]
        out.append(rows)
    return {k: np.concatenate([r[k] for r in out]) for k in every}


def cut_pieces(sorted_classes: DataFrame, p: TrieParams) -> DataFrame:
    """Rows of NODE_SCHEMA of all pieces of a range-partitioned, sorted table (seq, words, n, least, ids_sha256)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, piece = 0, TaskContext.get().partitionId() << 32

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal piece
            t = pa.Table.from_batches(held).combine_chunks()
            seq, words = (t[c].combine_chunks() for c in ("seq", "words"))
            got = piece_nodes(seq.flatten().to_numpy().reshape(-1, 2), words.flatten().to_numpy().astype(np.int64),
                              np.diff(words.offsets.to_numpy()).astype(np.int64), t["n"].to_numpy(), t["least"].to_numpy(),
                              t["ids_sha256"].to_numpy(), piece)
            piece += 1
            types = {"edge": pa.bool_(), "depth": pa.int32(), "ends_sha256": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in got.items()], list(got))

        for batch in batches:
            held.append(batch)
            size += len(batch.column(1).flatten()) + batch.num_rows
            if size >= p.piece_turns:
                yield from emit()
                held, size = [], 0
        if size:
            yield from emit()

    return sorted_classes.mapInArrow(run, NODE_SCHEMA)


# --- the trie ---------------------------------------------------------------

def prefix_trie(sequences: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """Per distinct prefix of the sequences (conv_id, turns), the empty one included: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prepare(sequences.sparkSession)
    flat = F.flatten(F.transform("turns", lambda t: F.array(t["h1"], t["h2"])))
    all_rows = sequences.select("conv_id", flat.alias("seq"), F.transform("turns", lambda t: t["words"]).alias("words")).withColumn(
        "k1", F.xxhash64("seq")).withColumn("k2", F.xxhash64(F.lit(7919), "seq")).checkpoint()
    # copies combine before the shuffle, then each distinct sequence is fetched from its smallest member
    counts = all_rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    classes = counts.join(id_digests(all_rows), ["k1", "k2"]).select("n", "least", "ids_sha256")
    distinct = all_rows.join(classes, F.col("conv_id") == F.col("least")).select("seq", "words", "n", "least", "ids_sha256")
    in_order = distinct.repartitionByRange(F.slice("seq", 1, 2 * SORT_TURNS)).sortWithinPartitions("seq")
    nodes = cut_pieces(in_order, p).checkpoint()

    edges = nodes.filter("edge")
    key = ["depth", "k1", "k2"]
    merged = edges.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("words").alias("words"), F.max("ends_sha256").alias("ends_sha256"), F.min("place").alias("place"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    edge_children = merged.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("more"))
    merged = (merged.join(edge_children, key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
              .withColumn("own_leaf", (F.col("n_children") == 0).cast("long"))
              .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("words")).drop("more").checkpoint())
    # each edge node counts on one of its chains; every prefix of it is on the same chain, above it
    upwards = Window.partitionBy("place").orderBy(F.col("depth").desc())
    below = (edges.select("place", *key).join(merged.select("place", "depth", "own_leaf", "own_saved"), ["place", "depth"], "left")
             .select(*key, *[F.sum(F.coalesce(c, F.lit(0))).over(upwards).alias(c) for c in ("own_leaf", "own_saved")])
             .groupBy(*key).agg(F.sum("own_leaf").alias("leaves"), F.sum("own_saved").alias("saved")))
    # the smallest member of each chain's nodes: the parents of edge nodes and of inner nodes right under one
    named = edges.select("place", *key).join(merged.select(*key, "conv_id"), key).select(
        "place", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("found")).checkpoint()
    whole = (merged.drop("own_leaf", "own_saved").join(below, key)
             .withColumn("n_leaves", F.col("n_leaves") + F.col("leaves"))
             .withColumn("saved_tokens", F.col("saved_tokens") + F.col("saved")).drop("leaves", "saved")
             .join(named, ["place", "depth"], "left").withColumn("parent_conv_id", F.col("found")))
    inner = nodes.filter("not edge")
    placed = inner.filter("place >= 0").join(named, ["place", "depth"]).withColumn("parent_conv_id", F.col("found"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parts = [x.select(*names) for x in (inner.filter("place < 0"), placed, whole)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))


def conversation_trie(conversations: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """The trie of the conversations as logged."""
    return prefix_trie(turn_sequences(conversations), p)
