"""Benchmark decontamination by a prefix-filtered set join.

An item's words are cut into windows of ``window`` consecutive words (an item
of fewer words is one window). A document contains a window only if it contains
all of the window's shingles (``shingle`` consecutive words each), so at full
containment the necessary prefix, in the order of rarity, is one shingle: the
rarest. The join runs on that shingle's hash alone. The length bound (the
document has room for the window) and the positional bound (the shingle's place
in the window fixes where the window begins) discard candidates before the
words are compared one by one.

One pass reads the documents: it counts words and emits, for every shingle
whose hash lies in a bit filter of the benchmark's shingles, the place and the
words around it (window - 1 to either side at most). The filter has a fixed
size, whatever the benchmark holds, and may pass too much but never too little.
How rare a shingle is, is counted over all documents from these places.

Words are maximal runs of ASCII letters and digits and non-ASCII characters,
A-Z lower-cased. Null or empty text has no words; an item without words has no
windows. A null doc_id is an id like any other; a document is a (doc_id, text)
pair, and rows repeated get the same answer each. Items that share an item_id
count as one item; an item without id finds its hits but is not listed. Empty
tables give no rows, or no hits. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare

# Every byte below 0x80 but ASCII letters and digits separates words; all bytes
# of non-ASCII characters are 0x80 or more and belong to words.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(128)) + bytes(range(128, 256))
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in WORD_BYTES)

# Bits of the shingle filter: 2 MB, sent to every task.
FILTER_BITS = 1 << 24


@dataclass(frozen=True)
class DeconParams:
    window: int = 10
    shingle: int = 5
    batch_bytes: int = 2 << 20


def words_of(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint64, len(words))


def shingle_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each ``size`` consecutive words, by multiply-xorshift over the words' codes."""
    n = max(0, len(codes) - size + 1)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h ^ codes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def filter_slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64)  # 24 bits


def benchmark_windows(benchmark: DataFrame, p: DeconParams) -> DataFrame:
    """(item_id, win, size, words, at, hash): every window's shingles; ``at`` is the shingle's place in the window.

    Equal windows of an item count once; ``win`` names a window by its words' hash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("item_id", "size", "words", "at", "hash")}
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(data or b"")
                codes = word_codes(words)
                size = min(p.window, len(words))
                for s in range(len(words) - size + 1 if words else 0):
                    text = b" ".join(words[s:s + size])
                    for at, h in enumerate(shingle_hashes(codes[s:s + size], min(p.shingle, size)).view(np.int64).tolist()):
                        for k, v in zip(out, (item, size, text, at, h)):
                            out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item_id"], batch.column(0).type), pa.array(out["size"], pa.int32()),
                 pa.array(out["words"], pa.binary()), pa.array(out["at"], pa.int32()), pa.array(out["hash"], pa.int64())],
                list(out))

    own = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    kind = own.schema["item_id"].dataType.simpleString()
    return (own.mapInArrow(run, f"item_id {kind}, size int, words binary, at int, hash bigint").distinct()
            .withColumn("win", F.xxhash64("words")))


def shingle_filter(windows: DataFrame) -> bytes:
    """The fixed-size bit filter of all shingle hashes (at most 512 maps of 4 KB reach the driver)."""
    slot = F.shiftrightunsigned("hash", 40)
    bits = bytearray(FILTER_BITS // 8)
    maps = windows.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("m"))
    # bucket 1 holds slots 1..32768, bucket 0 slot 0 alone
    for row in maps.collect():
        if row["b"] == 0:
            bits[0] |= 1
            continue
        first = (row["b"] - 1) * 32768 + 1
        ones = np.nonzero(np.unpackbits(np.frombuffer(bytes(row["m"]), np.uint8), bitorder="little"))[0] + first
        for x in ones[ones < FILTER_BITS].tolist():
            bits[x >> 3] |= 1 << (x & 7)
    return bytes(bits)


def scan_documents(docs: DataFrame, bits: bytes, sizes: list[int], p: DeconParams) -> DataFrame:
    """(doc_id, text_hash, n_words, hits): one row per document.

    ``hits`` are structs (hash, pos, first, words): a shingle's place in words,
    and the words from place ``first`` on around it.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(bits)
    reach = p.window - 1

    def hits_of(datas: list[bytes]) -> Iterator[tuple[int, list]]:
        """Words and hits of each text; the texts are hashed as one array."""
        table = np.frombuffer(shared.value, np.uint8)
        words: list[bytes] = []
        ends = []
        for d in datas:
            words += words_of(d)
            ends.append(len(words))
        codes = word_codes(words)
        bounds = np.array(ends, np.int64)
        found = []
        for size in sizes:
            h = shingle_hashes(codes, size)
            slot = filter_slot(h)
            at = np.nonzero(table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)[0]
            doc = np.searchsorted(bounds, at, side="right")
            inside = at + size <= bounds[doc]  # no shingle across two texts
            found.append((at[inside], doc[inside], np.full(int(inside.sum()), size), h[at[inside]].view(np.int64)))
        per_doc: list[list] = [[] for _ in datas]
        for at, doc, size, h in found:
            for x, k, n, y in zip(at.tolist(), doc.tolist(), size.tolist(), h.tolist()):
                begin = ends[k - 1] if k else 0
                lo, hi = max(begin, x - reach), min(ends[k], x + n + reach)
                per_doc[k].append({"hash": y, "pos": x - begin, "first": lo - begin, "words": b" ".join(words[lo:hi])})
        begin = 0
        for k, hits in enumerate(per_doc):
            yield ends[k] - begin, hits
            begin = ends[k]

    hit = pa.struct([("hash", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            start = 0
            while start < batch.num_rows:  # a few texts at a time, by their bytes
                datas, held = [], 0
                while start + len(datas) < batch.num_rows and (not datas or held < p.batch_bytes):
                    datas.append(texts[start + len(datas)].as_py() or b"")
                    held += len(datas[-1])
                done = list(hits_of(datas))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(datas)), batch.column(1).slice(start, len(datas)),
                     pa.array([n for n, _ in done], pa.int64()), pa.array([x for _, x in done], pa.list_(hit))],
                    ["doc_id", "text_hash", "n_words", "hits"])
                start += len(datas)

    own = docs.select("doc_id", text_hash().alias("text_hash"), F.col("text").cast("binary").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, text_hash bigint, n_words bigint, "
                               "hits array<struct<hash:bigint,pos:int,first:int,words:binary>>")


def text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def contaminated_spans(scanned: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, start, size): verified occurrences of windows in documents.

    Rarity is the number of places of a shingle in all documents; a window's
    anchor is its rarest shingle (ties to the first place in the window).
    """
    places = scanned.select("doc_id", "text_hash", "n_words", F.explode("hits").alias("h")).select(
        "doc_id", "text_hash", "n_words", "h.*")
    rarity = places.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    # A shingle that no document has rules its window out.
    anchors = (windows.join(rarity, "hash", "left")
               .groupBy("item_id", "win", "size", "words")
               .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "hash")).alias("a"))
               .filter("a.n > 0")
               .select("item_id", "size", F.col("words").alias("w_words"), F.col("a.at").alias("at"), F.col("a.hash").alias("hash")))
    start = F.col("pos") - F.col("at")
    fits = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    have = F.slice(F.split(F.col("words").cast("string"), " "), start - F.col("first") + 1, F.col("size"))
    return (places.join(anchors, "hash").filter(fits)
            .filter(F.array_join(have, " ") == F.col("w_words").cast("string"))
            .select("doc_id", "text_hash", "item_id", start.alias("start"), "size").distinct())


def find_contamination(docs: DataFrame, benchmark: DataFrame, p: DeconParams = DeconParams()) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): (doc_id, text_hash, n_words) of every row, and the verified occurrences."""
    prepare(docs.sparkSession)
    windows = benchmark_windows(benchmark, p).checkpoint()
    # shingle lengths in use: the full one, and shorter ones of items with fewer words
    sizes = sorted(r[0] for r in windows.select(F.least("size", F.lit(p.shingle))).distinct().collect())
    scanned = scan_documents(docs, shingle_filter(windows), sizes, p).checkpoint()
    return scanned.select("doc_id", "text_hash", "n_words"), contaminated_spans(scanned, windows)


def contamination_report(docs: DataFrame, benchmark: DataFrame, p: DeconParams = DeconParams()) -> DataFrame:
    """Per row: doc_id, text_hash, n_words, n_hit (words inside any occurrence), items (sorted ids as text)."""
    rows, spans = find_contamination(docs, benchmark, p)
    # Occurrences of one document; bounded by its own words and the items they match.
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("size") - 1))))
    hit = spans.groupBy("doc_id", "text_hash").agg(
        F.size(covered).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    g = hit.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), "n_hit", "items")
    return (rows.join(g, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("text_hash") == F.col("g_hash")), "left")
            .select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, p: DeconParams = DeconParams()) -> DataFrame:
    """The documents without any occurrence, all columns kept."""
    _, spans = find_contamination(docs, benchmark, p)
    bad = spans.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["g_id"]) & (text_hash() == bad["g_hash"]), "left_anti")
