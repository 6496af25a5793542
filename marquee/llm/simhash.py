"""SimHash near-de-duplication with bit-sliced comparison.

Fingerprint: the text's A-Z are lower-cased, its words (``[^\\x20\\x09-\\x0D]+``)
form shingles of ``shingle`` words joined by blanks, repeats included; a bit is
1 where it is set in over half the shingles' XXH64 hashes. Shorter texts hash
their whole word sequence, texts without words have fingerprint zero.

Equal fingerprints are merged first. The 64 bits are cut into m > ``radius``
blocks; two fingerprints within ``radius`` bits agree on at least m - radius of
them, so comparisons run inside buckets of equal bits, one table for every choice
of m - radius blocks. More blocks make longer keys and more tables: m follows from
the number of distinct fingerprints, so that the comparisons of one fingerprint
stay bounded while the corpus grows; the links are the same for every m. A bucket
beyond ``chunk`` members is cut into chunks, and each pair of chunks becomes a
group of its own. In a group the fingerprints lie
vertically, one machine word per bit and 64 members; a fingerprint meets 64
others at once, distances add up in carry-save counters, and a block is
abandoned as soon as all of its 64 distances exceed the radius. A group gives a
star of links per local component (not all pairs), which keeps every
connection; the stars are joined by connected components.

Null text counts as empty. Null ids are fingerprinted and linked but never name
a component unless all its ids are null. Rows repeated are documents each. An
empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare, spread_join
from marquee.llm.components import connected_components

ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 4
    radius: int = 4
    seed: int = 42
    chunk: int = 4096
    blocks: int | None = None  # None: chosen by the number of distinct fingerprints
    row_cost: int = 1000  # what dealing a fingerprint into a bucket costs, in comparisons


# --- fingerprints -----------------------------------------------------------

def fingerprint(data: bytes, shingle: int, seed: int) -> int:
    """The 64-bit fingerprint of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    tokens = data.translate(ASCII_LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = len(tokens) - shingle + 1
    if n <= 1:
        return xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1:].tolist())),
                         np.uint64, n)
    set_in = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k:k + (1 << 16)]
        set_in += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint's bit pattern as a signed long, text_hash tells rows of one id apart."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t or b"", p.shingle, p.seed) for t in batch.column(2).to_pylist()),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])

    own = docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


# --- bit-sliced comparison --------------------------------------------------

def bit_planes(tiles: np.ndarray) -> np.ndarray:
    """(tiles, 64) fingerprints -> (64, tiles) words: bit m of word [b, t] is bit b of member m of tile t."""
    bits = np.unpackbits(tiles.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    words = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(np.ascontiguousarray(words).view("<u8")[:, :, 0].T)


def exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count is above the radius (counters hold its binary digits, low first)."""
    above, same = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            above |= same & counters[k]
            same &= ~counters[k]
    return above


def compare_lanes(rows: np.ndarray, tiles: np.ndarray, planes: np.ndarray, open_lanes: np.ndarray,
                  radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept, lanes): of the given (row, tile) blocks those with a lane within the radius, and these lanes as bits.

    ``rows`` are fingerprints, ``tiles`` indices into the planes, ``open_lanes`` the lanes that count.
    """
    kept = np.arange(len(rows))
    digits = max(1, radius.bit_length())
    counters = [np.zeros(len(rows), np.uint64) for _ in range(digits)]
    over = ~open_lanes
    one = np.uint64(1)
    for bit in range(0, 64, 2):
        x, y = (planes[b][tiles] ^ (np.uint64(0) - (rows >> np.uint64(b) & one)) for b in (bit, bit + 1))
        odd = x ^ y
        carry = (x & y) | (counters[0] & odd)
        counters[0] = counters[0] ^ odd
        for k in range(1, digits):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over = over | carry
        if bit >= 14 and bit % 8 == 6:
            alive = exceeds(counters, over, radius) != FULL
            if alive.sum() < 0.7 * len(rows):
                kept, rows, tiles, over = kept[alive], rows[alive], tiles[alive], over[alive]
                counters = [c[alive] for c in counters]
    lanes = ~exceeds(counters, over, radius)
    found = lanes != 0
    return kept[found], lanes[found]


def local_roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of ``label`` (smallest index of each class) along the links a-b."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def group_links(values: np.ndarray, sizes: np.ndarray, radius: int, step: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Star links (fingerprint, local root) of consecutive groups of distinct fingerprints.

    Groups are padded to whole tiles of 64; a row meets its own tile's later
    lanes and its group's later tiles, ``step`` (row, tile) blocks at a time.
    """
    n_tiles = -(-sizes // 64)
    first_tile = np.cumsum(n_tiles) - n_tiles
    first = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - first[group]
    cell = (first_tile[group] + place // 64) * 64 + place % 64
    padded = np.zeros(int(n_tiles.sum()) * 64, np.uint64)
    valid = np.zeros(len(padded), bool)
    padded[cell], valid[cell] = values, True
    planes = bit_planes(padded.reshape(-1, 64))
    used = np.packbits(valid.reshape(-1, 64), axis=1, bitorder="little").view("<u8")[:, 0]
    own_tile, lane = cell // 64, (cell % 64).astype(np.uint64)
    last_tile = (first_tile + n_tiles)[group]
    meets = last_tile - own_tile
    upto = np.cumsum(meets)
    label = np.arange(len(padded))
    at = 0
    while at < len(values):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + step, side="right")))
        count = meets[at:end]
        row = np.repeat(np.arange(at, end), count)
        tile = own_tile[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        later = np.where(tile == own_tile[row], (FULL << lane[row]) & ~(np.uint64(1) << lane[row]), FULL)
        kept, lanes = compare_lanes(values[row], tile, planes, used[tile] & later, radius)
        if len(kept):
            hit, bit = np.nonzero(np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            label = local_roots(label, cell[row[kept[hit]]], tile[kept[hit]] * 64 + bit)
        at = end
    root = label[cell]
    linked = root != cell
    return values[linked], padded[root[linked]]


def block_masks(blocks: int, radius: int) -> list[int]:
    """A 64-bit mask for every choice of ``blocks - radius`` out of ``blocks`` consecutive, nearly equal blocks."""
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    own = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(own, blocks - radius)]


def expected_comparisons(blocks: int, radius: int, total: int) -> float:
    """Comparisons of one fingerprint over all tables, were the ``total`` fingerprints spread evenly."""
    return comb(blocks, radius) * total / 2 ** (64 * (blocks - radius) / blocks)


def chosen_blocks(total: int, p: SimHashParams) -> int:
    """The number of blocks with the least cost: rows dealt into tables and comparisons inside them."""
    if p.blocks:
        return p.blocks
    return min(range(p.radius + 1, min(64, p.radius + 6) + 1),
               key=lambda m: comb(m, p.radius) * p.row_cost + expected_comparisons(m, p.radius, total))


def near_links(fps: DataFrame, p: SimHashParams) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that keep every component of the radius graph."""
    total = fps.count()
    blocks = chosen_blocks(total, p)
    masks = block_masks(blocks, p.radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    bands = F.array(*[F.struct(F.lit(k).alias("band"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                      for k, m in enumerate(signed)])
    keyed = fps.select("fp", F.explode(bands).alias("b")).select("fp", "b.band", "b.key")
    counts = (keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("band", "key", F.ceil(F.col("n") / p.chunk).alias("chunks"), "n"))
    if blocks == p.radius + 1:
        # At most (radius + 1) * 2^ceil(64 / (radius + 1)) buckets, 36,864 for radius 4: small by construction.
        placed = keyed.join(F.broadcast(counts.drop("n")), ["band", "key"])
    else:
        placed = spread_join(keyed, counts.checkpoint(), ["band", "key"], "n", max(1, total * len(masks)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    grouped = (placed.withColumn("own", own)
               .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
               .groupBy("band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
               .agg(F.array_sort(F.collect_list("fp")).alias("fps")).filter(F.size("fps") > 1).select("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(column.offsets.to_numpy())
            values = column.flatten().to_numpy().astype(np.int64).view(np.uint64)
            a, b = group_links(values, sizes, p.radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return grouped.mapInArrow(run, "a bigint, b bigint")


def components(docs: DataFrame, p: SimHashParams) -> DataFrame:
    """Per row: doc_id, text_hash, fp (signed long), component_id (smallest doc_id of its component), root (a fingerprint of it)."""
    prints = fingerprints(docs, p).checkpoint()
    total = prints.count()
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")).checkpoint()
    roots = connected_components(near_links(classes.select("fp"), p))
    placed = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")).checkpoint())
    comps = placed.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("members")).checkpoint()
    named = spread_join(placed.select("fp", "n", "root"), comps, "root", "members", max(1, total)).checkpoint()
    return (spread_join(prints, named.select("fp", "component_id", "root", "n"), "fp", "n", max(1, total))
            .select("doc_id", "text_hash", "fp", "component_id", "root"))


def near_duplicates(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """Per row: doc_id, text_hash, fp (signed long), component_id (smallest doc_id of its component)."""
    return components(docs, p).drop("root")


def hex_fingerprint(fp):
    """A signed long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """One document of every component: the one of the smallest (doc_id, text_hash), null ids last.

    All columns are kept. Of rows that repeat both any one stays.
    """
    keys = (components(docs, p).groupBy("root", F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
            .agg(F.count(F.lit(1)).alias("n")).checkpoint())
    own = F.struct(F.col("k_id").isNull().alias("lost"), "k_id", "k_hash")
    first = keys.groupBy("root").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("keys"))
    kept = spread_join(keys, first, "root", "keys", max(1, keys.count())).withColumn("gone", ~own.eqNullSafe(F.col("first")))
    # only documents that go and those that come again are joined
    marks = kept.filter("gone or n > 1").select("k_id", "k_hash", "gone").checkpoint()
    # the row travels in a struct, so that none of its names can clash
    row = F.struct(*[f"`{c}`" for c in docs.columns])
    own = docs.select(row.alias("row"), F.col("doc_id").alias("r_id"), text_hash().alias("r_hash"))
    found = own.join(marks, F.col("r_hash").eqNullSafe(F.col("k_hash")) & F.col("r_id").eqNullSafe(F.col("k_id")), "left")
    again = found.filter("not gone").dropDuplicates(["r_id", "r_hash"])
    return found.filter("gone is null").unionByName(again).select(*[F.col(f"row.`{c}`") for c in docs.columns])
