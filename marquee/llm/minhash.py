"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

The text's A-Z are lower-cased and its words (``[^\\x20\\x09-\\x0D]+``) form
shingles of ``shingle`` words (a shorter text is one shingle of all its words).
Each shingle is hashed once: the top bits name its bin, the rest is its value,
and a bin keeps the least value. An empty bin borrows by optimal densification:
it walks a pseudorandom order of all bins, its own and the same for every
document, and takes the first that is not empty. The walk probes ``probes``
hashed places, then takes of the bins left the one of least hash, so it always
ends. Of the value a bin ends with, the low ``bits`` of its hash with the bin's
number are kept (so bins that borrow the same value still count apart), packed
into 64-bit words. Two fingerprints agree by chance in 2^-bits of their bins;
``likeness`` takes that share off: (equal - c) / (1 - c), not below 0.

A fingerprint is computed where its row is read, without a shuffle.

Null text is empty text. Texts without words have the zero fingerprint, which
is like itself (1) and like no other (0). Texts equal but for ASCII case and
blanks have equal fingerprints; rows repeated get the same one each. Long texts
take one array of 8 bytes a word. Empty tables give no rows. Extra columns do no
harm: ``add_fingerprints`` keeps them, ``edit_report`` does not read them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import heavy_cut, lower_ascii, prepare

BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class MinHashParams:
    shingle: int = 5
    bins: int = 256       # a power of two
    bits: int = 8         # 1, 2, 4, 8, 16 or 32
    probes: int = 8
    bucket_rows: int = 500    # documents that meet in one window when neighbours are found
    max_cells: int = 512      # quantiles of doc_id held as literals
    max_buckets: int = 400_000  # beyond it buckets grow instead
    task_buckets: int = 8     # buckets a task, about


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


# --- fingerprints -----------------------------------------------------------

def add_fingerprints(df: DataFrame, text: str, out: str, p: MinHashParams = MinHashParams()) -> DataFrame:
    """``df`` with the packed fingerprint of column ``text`` as ``out`` (array of longs); a column of that name is replaced."""
    # Columns named here are used more than once further down, so the optimiser
    # keeps each step as a projection of its own and evaluates it once a row.
    shift = 64 - (p.bins.bit_length() - 1)
    rest = (1 << shift) - 1
    ceilings = F.array(*[F.lit(_signed(((j - p.bins // 2) << shift) | rest)) for j in range(p.bins)])
    words, n, marks, mins, full, lanes = (f"__{out}_{x}" for x in ("words", "n", "marks", "mins", "full", "lanes"))
    trimmed = F.btrim(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(BLANKS))
    hashes = F.transform(F.filter(F.split(trimmed, "[ \\t-\\r]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    # hashing skips nulls, so in a short text the shingle is all its words
    shingles = F.transform(F.sequence(F.lit(0), F.greatest(F.col(n) - p.shingle, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(p.shingle)]))
    bin_of = lambda x: F.shiftright(x, shift)  # noqa: E731  (signed: -bins/2 .. bins/2 - 1)

    def borrowed(x: Column, j: Column) -> Column:
        own = j.cast("long")
        probes = [F.get(F.col(mins), F.xxhash64(F.lit(r).cast("long"), own).bitwiseAND(F.lit(p.bins - 1)).cast("int"))
                  for r in range(p.probes)]
        rest_of_walk = F.array_min(F.transform(F.col(full), lambda v: F.struct(
            F.xxhash64(F.lit(p.probes).cast("long"), own, bin_of(v)).alias("h"), v.alias("v"))))["v"]
        return F.coalesce(x, *probes, F.when(F.size(F.col(full)) > 0, rest_of_walk))

    per_word = 64 // p.bits
    packed = F.transform(F.sequence(F.lit(0), F.lit(p.bins // per_word - 1)), lambda w: reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.shiftleft(F.get(F.col(lanes), w * per_word + i), i * p.bits) for i in range(per_word)]))
    step = (df.withColumn(words, hashes).withColumn(n, F.size(words))
            # a ceiling per bin makes sure that each bin has a least value; an empty bin's is the ceiling
            .withColumn(marks, F.sort_array(F.concat(shingles, ceilings)))
            .withColumn(mins, F.transform(
                F.filter(F.col(marks), lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(marks), i - 1)))),
                lambda x: F.when(x.bitwiseAND(F.lit(rest)) != rest, x)))
            .withColumn(full, F.filter(F.col(mins), lambda x: x.isNotNull()))
            .withColumn(lanes, F.transform(F.col(mins), lambda x, j: F.xxhash64(borrowed(x, j), j.cast("long"))
                                           .bitwiseAND(F.lit((1 << p.bits) - 1)))))
    zero = F.array_repeat(F.lit(0).cast("long"), p.bins // per_word)
    return step.withColumn(out, F.when(F.col(n) == 0, zero).otherwise(packed)).drop(words, n, marks, mins, full, lanes)


def hex_words(fp: Column) -> Column:
    """A packed fingerprint as lowercase hex digits."""
    return F.array_join(F.transform(fp, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")


def likeness(a: Column, b: Column, p: MinHashParams = MinHashParams()) -> Column:
    """Estimated Jaccard similarity (0 to 1) of the texts behind two packed fingerprints."""
    lowest = _signed(sum(1 << i for i in range(0, 64, p.bits)))

    def unequal(x: Column, y: Column) -> Column:
        bits, k = x.bitwiseXOR(y), p.bits // 2
        while k:
            bits, k = bits.bitwiseOR(F.shiftrightunsigned(bits, k)), k // 2
        return F.bit_count(bits.bitwiseAND(F.lit(lowest)))

    apart = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x.cast("int"))
    chance = 2.0 ** -p.bits
    nothing = lambda fp: F.forall(fp, lambda w: w == 0)
    return (F.when(nothing(a) | nothing(b), (nothing(a) & nothing(b)).cast("double"))
            .otherwise(F.greatest(F.lit(0.0), ((1 - apart / p.bins) - chance) / (1 - chance))))


# --- neighbours by id -------------------------------------------------------

def _bucketing(keys: DataFrame, total: int, p: MinHashParams):
    """A function from (doc_id, text_hash) to a bucket number that grows with that order.

    Buckets are cells between quantiles of doc_id, cut evenly; an id that is a
    quantile itself has its cell's first bucket alone, cut by the (uniform) text
    hash, more finely the more quantiles fall on it. Null ids come first.
    """
    wanted = max(1, min(p.max_buckets, total // p.bucket_rows))
    cells = min(p.max_cells, wanted)
    found = keys.agg(F.count(F.lit(1)).alias("rows"), F.count("doc_id").alias("ids"),
                     F.percentile_approx("doc_id", [k / cells for k in range(cells + 1)], 10_000).alias("q")).first()
    quantiles = [int(x) for x in found["q"] or []]
    bounds = sorted(set(quantiles))
    cuts = -(-wanted // cells)
    parts = [max(1, (quantiles.count(x) - 1) * cuts) for x in bounds]
    null_parts = max(1, (found["rows"] - found["ids"]) * wanted // max(1, total))

    def bucket(doc_id: Column, text_hash: Column) -> Column:
        share = text_hash / F.lit(2.0 ** 64) + F.lit(0.5)
        if not bounds:
            cell = low = F.lit(0)
            part = F.floor(share * null_parts)
        else:
            array = F.array(*[F.lit(x) for x in bounds])
            cell = F.size(F.filter(array, lambda x: x <= doc_id))
            lo, hi = F.get(array, cell - 1), F.get(array, cell)
            inside = F.floor((doc_id.cast("double") - lo.cast("double")) / (hi.cast("double") - lo.cast("double")) * cuts)
            low = F.when(doc_id.isNull() | (doc_id == lo), 0).otherwise(
                1 + F.coalesce(F.least(inside, F.lit(cuts)), F.lit(0)))
            n_parts = F.when(doc_id == lo, F.get(F.array(*[F.lit(x) for x in parts]), cell - 1)).otherwise(1)
            part = F.floor(share * F.when(doc_id.isNull(), null_parts).otherwise(n_parts))
            cell = F.when(doc_id.isNull(), 0).otherwise(1 + cell)
        return (F.shiftleft(cell.cast("long"), 44) + F.shiftleft(low.cast("long"), 22) + part.cast("long"))

    return bucket


def with_next(docs: DataFrame, p: MinHashParams = MinHashParams()) -> DataFrame:
    """(doc_id, text, fp, next_text, next_fp, copies): each document and the one after it, ascending by id, the first after the last.

    Null ids come first, rows of one id follow by the hash of their text. Rows
    alike in both are given as ``copies``, not repeated: up to two rows come
    back for them, of those followed by a copy and of the last one.

    Rows are dealt to buckets of neighbouring ids, each text once; the bucket's
    window takes the row after each, and the first row of a bucket is sent to
    the bucket before it too. Ids shared by many texts are cut by text hash,
    and copies beyond ``heavy_cut`` meet in an aggregate first.
    """
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select("doc_id", text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    keys = own.select("doc_id", "text_hash").checkpoint()
    total = keys.count()
    bucket = _bucketing(keys, total, p)
    placed = keys.withColumn("bucket", bucket(F.col("doc_id"), F.col("text_hash")))
    least = placed.groupBy("bucket").agg(F.min("doc_id").alias("f_id"))
    # one small row per bucket, at most some max_buckets of them
    firsts = (placed.join(F.broadcast(least.withColumnRenamed("bucket", "b")),
                          (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("f_id")))
              .groupBy("bucket", "f_id").agg(F.min("text_hash").alias("f_hash")).orderBy("bucket").collect())
    before = [(r["f_id"], r["f_hash"], firsts[k - 1]["bucket"]) for k, r in enumerate(firsts)]
    edges = spark.createDataFrame(before, f"f_id {keys.schema['doc_id'].dataType.simpleString()}, f_hash long, also long")
    copies = keys.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    heavy = (copies.filter(F.col("copies") > heavy_cut(total))
             .select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"), "copies").checkpoint())
    rows = own.withColumn("copies", F.lit(1).cast("long"))
    if not heavy.isEmpty():
        alike = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash"))
        once = (own.join(F.broadcast(heavy), alike).groupBy("doc_id", "text_hash", "copies")
                .agg(F.collect_set("text")[0].alias("text")))
        rows = own.join(F.broadcast(heavy), alike, "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(once)
    rows = add_fingerprints(rows, "text", "fp", p).withColumn("bucket", bucket(F.col("doc_id"), F.col("text_hash")))
    sent = (rows.join(F.broadcast(edges), F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash")), "left")
            .withColumn("to", F.explode(F.filter(F.array(
                F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
                F.struct(F.col("also").alias("bucket"), F.lit(True).alias("guest"))), lambda x: x["bucket"].isNotNull())))
            .select("doc_id", "text", "text_hash", "fp", "copies", "to.bucket", "to.guest"))
    # partitions as many as the table needs, so that a task's share does not grow with it; bucket numbers are
    # too regular to be dealt evenly as they are
    sent = (sent.withColumn("bucket", F.xxhash64("bucket"))
            .repartition(max(1, min(p.max_buckets, total // p.bucket_rows) // p.task_buckets), "bucket"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text_hash")
    after = (sent.withColumn("next", F.lead(F.struct("text", "fp")).over(order)).filter(~F.col("guest"))
             .select("doc_id", "text", "fp", "copies", "next"))
    both = F.filter(F.array(F.struct(F.col("next").alias("next"), F.lit(1).cast("long").alias("copies")),
                            F.struct(F.struct("text", "fp").alias("next"), (F.col("copies") - 1).alias("copies"))),
                    lambda x: x["copies"] > 0)
    return (after.withColumn("pair", F.explode(both)).select(
        "doc_id", "text", "fp", F.col("pair.next.text").alias("next_text"), F.col("pair.next.fp").alias("next_fp"),
        F.col("pair.copies").alias("copies")))


def edit_report(docs: DataFrame, p: MinHashParams = MinHashParams()) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how like it is to that and to the next document.

    The edited text has the last half of the code points (rounded down) replaced
    by as many from the start of the next document's text, or all it has.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    pairs = (with_next(docs, p).withColumn("n_chars", F.char_length("text").cast("long"))
             .withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"),
                                            F.substring(F.col("next_text"), F.lit(1), half))))
    edited = add_fingerprints(pairs, "edited", "edited_fp", p)
    out = edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), hex_words(F.col("fp")).alias("fingerprint"),
        hex_words(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp"), p).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp"), p).alias("near_next"), "copies")
    # rows alike are worked on once and repeated here
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy")
