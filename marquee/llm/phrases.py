"""Phrase collocation mining with Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these
into words ``[^\\x20\\x09]+``. Per block of texts numpy keeps running polynomials
over the words' hashes (modulo 2^64, with a start value per language), so the
fingerprint of every n-gram is a difference of two of them. A task counts equal
fingerprints before anything is shuffled; the shuffle carries fingerprint, an
independent check hash, count and a pointer to a text that holds the n-gram.

N-grams are counted by length, shortest first. One is counted only if both its
parts without the last and without the first word are frequent, by a bit filter
of the frequent fingerprints of the length before. The filter's size follows
their number up to a fixed bound; it passes too much at times, never too little,
so counts of frequent n-grams are complete.

Fingerprints whose check hashes differ are collisions: their n-grams are counted
again by their words. The words of all other frequent n-grams are read from the
text pointed to, which is fingerprinted again and must show both hashes. Only
frequent phrases ever become strings.

Scores, the best cut and the drop rule are joins and aggregates over frequent
phrases alone, in 38-digit integers. A null language is ``und``. Null and empty
texts have no words; very long texts are one block of their own; repeated rows
count each; empty tables give no phrases. Only text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import prepare, spread_join

# A-Z lower-cased, piece separators to line ends, tab to blank: no upper-case
# letter is left, so the words "A" and "B" can mark the ends of pieces and texts.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in SEPARATORS else 32 if b == 9 else b for b in range(256))
END_OF_PIECE, END_OF_TEXT = b"A", b"B"
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class PhraseParams:
    longest: int = 4
    least: int = 30
    covered: int = 80        # per cent of a phrase's count that a longer one must have to replace it
    top: int = 2000
    block_bytes: int = 5 << 20   # of text hashed together
    bits: int = 64           # of a fingerprint; fewer only to test collisions
    filter_bits: int = 1 << 28   # at most: 32 MB, whatever the corpus holds


# --- words and fingerprints -------------------------------------------------

def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """(words, 2) 64-bit hashes: sums over a word's bytes of a mixed value of byte and place."""
    ends = np.frombuffer(words.buffers()[1], np.int64 if pa.types.is_large_binary(words.type) else np.int32)[
        words.offset:words.offset + len(words) + 1].astype(np.int64)
    size = np.diff(ends)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], size)
    out = np.zeros((len(words), 2), np.uint64)
    some = np.nonzero(size)[0]
    for c, base in enumerate(BASES):
        value = mixed(data + np.uint64(1) + place.astype(np.uint64) * np.uint64(256) + np.uint64(base))
        out[some, c] = np.add.reduceat(value, (ends[:-1] - ends[0])[some]) if len(some) else 0
    return mixed(out + size[:, None].astype(np.uint64))


class Powers:
    """Powers of both bases and of their inverses modulo 2^64, kept for the longest block so far."""

    def __init__(self):
        self.up = self.down = np.ones((2, 0), np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.up.shape[1] < n:
            # the bases are odd, so they have inverses
            self.up, self.down = (np.stack([np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(base, sign, 1 << 64), np.uint64)])
                                            for base in BASES]) for sign in (1, -1))
        return self.up[:, :n], self.down[:, :n]


class Block:
    """The words of some texts and the running polynomials over their hashes."""

    def __init__(self, texts: list[bytes], langs: list[str], powers: Powers | None = None):
        data = b" A B ".join([t.translate(FOLD).replace(b"\n", b" A ") for t in texts] + [b""])
        split = pc.split_pattern(pa.array([data], pa.large_binary()), b" ").flatten().dictionary_encode()
        del data
        self.dictionary, codes = split.dictionary, split.indices.to_numpy()
        known = pc.index_in(pa.array([b"", END_OF_PIECE, END_OF_TEXT], self.dictionary.type), self.dictionary).to_pylist()
        nothing, piece, text = (-1 if k is None else k for k in known)
        if nothing >= 0:
            codes = codes[codes != nothing]  # from blanks in a row
        self.codes, self.langs = codes, langs
        over = codes == text
        self.text = np.minimum(np.cumsum(over) - over, max(len(texts) - 1, 0)).astype(np.int32)
        self.ends = np.r_[0, np.cumsum((codes == piece) | over)].astype(np.int32)
        hashes = word_hashes(self.dictionary)
        up, self.unshift = (powers or Powers()).upto(len(codes))
        self.sums = np.zeros((2, len(codes) + 1), np.uint64)
        for c in (0, 1):
            np.cumsum(hashes[:, c][codes] * up[c], out=self.sums[c, 1:])
        seeds = np.frombuffer(b"".join(blake2b(x.encode(), digest_size=16, person=b"lang").digest() for x in langs), "<u8")
        self.seeds = seeds.reshape(-1, 2)

    def places(self, n: int) -> np.ndarray:
        """Where an n-gram within a piece begins."""
        at = np.arange(max(0, len(self.codes) - n + 1))
        return at[self.ends[at + n] == self.ends[at]]

    def hashed(self, at: np.ndarray, n: int, c: int) -> np.ndarray:
        """Fingerprints (c = 0) or check hashes (c = 1) of the n-grams at these places."""
        poly = (self.sums[c][at + n] - self.sums[c][at]) * self.unshift[c][at]
        return mixed(poly + self.seeds[self.text[at], c] * np.uint64(2 * n + 1))

    def fingerprints(self, at: np.ndarray, n: int, bits: int) -> np.ndarray:
        return self.hashed(at, n, 0) >> np.uint64(64 - bits)

    def phrase(self, at: int, n: int) -> str:
        return b" ".join(self.dictionary[int(c)].as_py() for c in self.codes[at:at + n]).decode()


def blocks(batches: Iterator[pa.RecordBatch], p: PhraseParams) -> Iterator[tuple[Block, np.ndarray]]:
    """Batches of (lang, pointer, text, ...) in blocks of about ``block_bytes`` of text, each with its rows' pointers."""
    texts: list[bytes] = []
    langs: list[str] = []
    pointers: list[int] = []
    size, powers = 0, Powers()
    for batch in batches:
        lang, pointer, text = (batch.column(c).to_pylist() for c in range(3))
        for one, at, t in zip(lang, pointer, text):
            texts.append(t)
            langs.append(one)
            pointers.append(at)
            size += len(t)
            if size >= p.block_bytes:
                yield Block(texts, langs, powers), np.array(pointers, np.int64)
                texts, langs, pointers, size = [], [], [], 0
    if texts:
        yield Block(texts, langs, powers), np.array(pointers, np.int64)


def sources(docs: DataFrame) -> DataFrame:
    """(lang, pointer, text): the pointer is the hash of language and text, so equal rows share it."""
    prepare(docs.sparkSession)
    return (docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .select("lang", F.xxhash64("lang", "text").alias("pointer"), F.col("text").cast("binary").alias("text")))


# --- counting ---------------------------------------------------------------

def slots(fp: np.ndarray, size: int) -> np.ndarray:
    """The bit of each fingerprint in a filter of ``size`` bits (a power of two)."""
    return (mixed(fp) & np.uint64(size - 1)).astype(np.int64)


def in_filter(fp: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = slots(fp, len(bits) * 8)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def bit_filter(frequent: DataFrame, count: int, p: PhraseParams) -> np.ndarray:
    """The filter of the fingerprints ``fp``: tasks set bits, the driver gets one row per used 4 KB of it."""
    size = max(1 << 15, min(p.filter_bits, 1 << (16 * max(1, count) - 1).bit_length()))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(slots(batch.column(0).to_numpy().view(np.uint64), size))
            yield pa.RecordBatch.from_arrays([pa.array(slot)], ["slot"])

    # bitmap_bucket_number counts from slot 1, so slots go one up
    one = F.col("slot") + 1
    maps = (frequent.select("fp").mapInArrow(pages, "slot long").groupBy(F.bitmap_bucket_number(one).alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("m")))
    bits = np.zeros(size // 8, np.uint8)
    for row in maps.toLocalIterator():
        page = np.frombuffer(bytes(row["m"]), np.uint8)
        at = (row["b"] - 1) * 4096
        bits[at:at + 4096] = page[:max(0, len(bits) - at)]
    return bits


def ngram_counts(docs: DataFrame, n: int, shorter: np.ndarray | None, p: PhraseParams) -> DataFrame:
    """(fp, check, n_seen, pointer): n-grams with both parts in the filter ``shorter``, counted per block."""
    shared = docs.sparkSession.sparkContext.broadcast(shorter) if shorter is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, pointers in blocks(batches, p):
            at = block.places(n)
            if shared is not None:
                where = block.places(n - 1)
                held = np.zeros(len(block.codes) + 1, bool)
                held[where] = in_filter(block.fingerprints(where, n - 1, p.bits), shared.value)
                at = at[held[at] & held[at + 1]]
            fp = block.fingerprints(at, n, p.bits)
            order = np.argsort(fp)
            fp, at = fp[order], at[order]
            check = block.hashed(at, n, 1)
            new, other = fp[1:] != fp[:-1], check[1:] != check[:-1]
            if (other & ~new).any():  # n-grams that share a fingerprint in this block
                order = np.lexsort((check, fp))
                fp, at, check = fp[order], at[order], check[order]
                new, other = fp[1:] != fp[:-1], check[1:] != check[:-1]
            first = np.nonzero(np.r_[True, new | other])[0] if len(fp) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[first].view(np.int64)), pa.array(check[first].view(np.int64)), pa.array(np.diff(np.r_[first, len(fp)])),
                 pa.array(pointers[block.text[at[first]]])], ["fp", "check", "n_seen", "pointer"])

    return sources(docs).mapInArrow(run, "fp long, check long, n_seen long, pointer long")


def frequent_fingerprints(docs: DataFrame, p: PhraseParams) -> DataFrame:
    """(n, fp, check, a, pointer, clash): fingerprints seen ``least`` times or more; ``clash`` if n-grams share it."""
    out, shorter = None, None
    for n in range(1, p.longest + 1):
        # counted per block already, so rows go to their partition as they are
        found = (ngram_counts(docs, n, shorter, p).repartition("fp").groupBy("fp")
                 .agg(F.sum("n_seen").alias("a"), F.min("check").alias("check"), F.max("check").alias("other"),
                      F.min("pointer").alias("pointer"))
                 .filter(F.col("a") >= p.least)
                 .select(F.lit(n).alias("n"), "fp", "check", "a", "pointer", (F.col("check") != F.col("other")).alias("clash"))
                 .checkpoint())
        out = found if out is None else out.unionByName(found)
        if n < p.longest:
            shorter = bit_filter(found, found.count(), p)
    return out


# --- from fingerprints to words ---------------------------------------------

def read_phrases(docs: DataFrame, frequent: DataFrame, p: PhraseParams) -> DataFrame:
    """(lang, phrase, n, a) of fingerprints without clash, from the texts they point to."""
    wanted = frequent.filter("not clash").groupBy("pointer").agg(F.collect_list(F.struct("n", "fp", "check", "a")).alias("wanted"))
    # texts nobody points to are left where they are; the filter is of bounded size
    marks = wanted.select(F.col("pointer").alias("fp")).checkpoint()
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(marks, marks.count(), p))

    def pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(batch.column(1).to_numpy().view(np.uint64), bits.value)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            out: list[tuple] = []
            for lang, text, asked in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "wanted"))):
                block = Block([text], [lang], powers)
                for n in sorted({w["n"] for w in asked}):
                    counts = {(w["fp"], w["check"]): w["a"] for w in asked if w["n"] == n}
                    at = block.places(n)
                    fp = block.fingerprints(at, n, p.bits).view(np.int64)
                    hit = np.isin(fp, np.array([k[0] for k in counts], np.int64))
                    at, fp = at[hit], fp[hit]
                    check = block.hashed(at, n, 1).view(np.int64)
                    for place, *both in zip(at.tolist(), fp.tolist(), check.tolist()):
                        a = counts.pop(tuple(both), None)
                        if a is not None:
                            out.append((lang, block.phrase(place, n), n, a))
            yield phrase_batch(out)

    texts = sources(docs).mapInArrow(pointed, "lang string, pointer long, text binary").dropDuplicates(["pointer"])
    return texts.join(wanted, "pointer").select("lang", "text", "wanted").mapInArrow(run, PHRASES)


PHRASES = "lang string, phrase string, n int, a long"


def phrase_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64()))], ["lang", "phrase", "n", "a"])


def recount_clashes(docs: DataFrame, frequent: DataFrame, p: PhraseParams) -> DataFrame:
    """(lang, phrase, n, a) of the n-grams behind clashing fingerprints, counted by their words."""
    clashes = frequent.filter("clash").select("n", "fp").checkpoint()
    kinds = {r["n"]: r["count"] for r in clashes.groupBy("n").count().collect()}
    if not kinds:
        return docs.sparkSession.createDataFrame([], PHRASES)
    filters = {n: bit_filter(clashes.filter(F.col("n") == n), count, p) for n, count in kinds.items()}
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in blocks(batches, p):
            for n, bits in shared.value.items():
                at = block.places(n)
                hit = at[in_filter(block.fingerprints(at, n, p.bits), bits)]
                seen: dict[tuple, int] = {}
                for k in hit.tolist():
                    key = (block.langs[block.text[k]], block.phrase(k, n), n)
                    seen[key] = seen.get(key, 0) + 1
                yield phrase_batch([(*key, a) for key, a in seen.items()])

    return (sources(docs).mapInArrow(run, PHRASES).groupBy("lang", "phrase", "n").agg(F.sum("a").alias("a"))
            .filter(F.col("a") >= p.least))


def frequent_phrases(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """(lang, phrase, n, a): every phrase of 1 to ``longest`` words seen ``least`` times or more in its language."""
    frequent = frequent_fingerprints(docs, p)
    return read_phrases(docs, frequent, p).unionByName(recount_clashes(docs, frequent, p))


def word_totals(docs: DataFrame) -> DataFrame:
    """(lang, total): all words of each language."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit("[^\\x20\\x09.,;:!?\\x0A-\\x0D]+"))
    return (docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), words.cast("long").alias("w"))
            .groupBy("lang").agg(F.sum("w").alias("total")))


# --- scores -----------------------------------------------------------------

def part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def mine_phrases(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """Per language its best ``top`` phrases: lang, rank, phrase, a, l, r, n (words of the language), score."""
    found = frequent_phrases(docs, p).checkpoint()
    candidates = found.filter("n >= 2").withColumn("words", F.split("phrase", " "))
    # every way to cut a candidate in two; both parts are frequent, as they occur wherever it does
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
            .select("lang", "phrase", "a", "k", part(F.col("words"), F.lit(1), F.col("k")).alias("first"),
                    part(F.col("words"), F.col("k") + 1, F.col("n") - F.col("k")).alias("rest")).checkpoint())
    total = max(1, cuts.count())
    for side, name in (("first", "l"), ("rest", "r")):
        # a common word is a part of many candidates: such parts are sent to them
        uses = cuts.groupBy(F.struct("lang", F.col(side).alias("phrase")).alias("part")).agg(F.count(F.lit(1)).alias("uses"))
        parts = uses.join(found.select(F.struct("lang", "phrase").alias("part"), F.col("a").alias(name)), "part")
        cuts = spread_join(cuts.withColumn("part", F.struct("lang", F.col(side).alias("phrase"))), parts, "part", "uses", total).drop("part")
    wide = "decimal(38,0)"
    score = F.expr(f"(cast(a as {wide}) * 2000000) div (cast(l as {wide}) + cast(r as {wide}))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    inner = candidates.filter("n >= 3").select("lang", "a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("n") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("n") - size + 1), lambda at: part(F.col("words"), at, size))))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    covered = F.expr(f"100 * cast(longest as {wide}) >= {p.covered} * cast(a as {wide})")
    left = best.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    top = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.top)
    # one row per language
    totals = word_totals(docs).select("lang", F.col("total").alias("n"))
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
