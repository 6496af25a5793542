"""Mixing sources to target weights, with DataFrame functions only.

Texts are measured in words. Each source's words form one stream, cut into
blocks of ``block_words`` words; an output shard has ``shard_slots`` slots of
one block each. Every shard draws how many of its slots each source fills from
a multinomial: the whole part of the expected count is certain and the rest is
drawn (residual multinomial), which keeps each source close to its target. The
slots of a source are numbered through all shards, and slot j reads block
``perm(j mod blocks)`` of pass ``j div blocks``, where ``perm`` is a
pseudorandom permutation of the source's block indices, one per source and pass
(a swap-or-not shuffle: every round is its own inverse on 0..n-1, so any n
works and no sort is needed). Slots and blocks are joined by source and index.

Targets share all words by weight, but no source gives more than ``max_epochs``
times its words; what is cut is shared again among the others by weight.

Null text: size 0. A null source is a source of its own, ordered last. Empty
texts take no slots and come back with ``taken`` 0; an empty table gives no
rows. Rows repeated in the table are separate documents. Only doc_id, text and
source are read, so extra columns do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"

# Arithmetic hash: multiply-add modulo a Mersenne prime, products below 2^62.
PRIME = 2147483647


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = WEIGHTS
    max_epochs: int = 3
    block_words: int = 32
    shard_slots: int = 16384
    bucket_rows: int = 4096
    seed: int = 20240607
    rounds: int = 10


def mix_hash(value: Column, a: Column, b: Column) -> Column:
    """Multiply-add, fold, multiply-add: 0..PRIME-1, plain integer arithmetic in any SQL engine."""
    prime = F.lit(PRIME).cast("long")
    x = F.pmod(F.pmod(value, prime) * a + b, prime)
    x = F.shiftright(x * F.lit(40503).cast("long"), 7)
    return F.pmod(F.pmod(x, prime) * b + a, prime)


def constants(seed: int, k: int) -> tuple[int, int]:
    """Multiplier and addend of the k-th hash of a seed (a linear congruential sequence)."""
    x = (seed * 7919 + k * 104729 + 12345) % PRIME
    out = []
    for _ in range(2):
        for _ in range(3):
            x = (x * 48271 + 11) % PRIME
        out.append(x | 1)
    return out[0], out[1]


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "source",
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, p: MixParams) -> DataFrame:
    """One row per source: docs, source_size, target.

    The windows below run over one row per source, never over documents.
    Water-filling: order sources by cap/weight; source i is cut to its cap when
    the cap is at most the share of what the sources before it left over.
    """
    by_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"),
                                            F.sum("size").alias("source_size"))
    codepoint = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in p.weights]),
                          (F.pmod(F.col("rank"), F.lit(len(p.weights))) + 1).cast("int"))
    ranked = (by_source.withColumn("rank", F.row_number().over(codepoint) - 1)
              .withColumn("weight", weight)
              .withColumn("cap", F.col("source_size") * p.max_epochs))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank").asc())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    filled = (ranked.withColumn("left", total - F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(onward))
              .withColumn("full", F.col("cap") * F.col("weight_left") <= F.col("left") * F.col("weight")))
    everyone = Window.partitionBy()
    spare = total - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everyone)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everyone)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        (spare * F.col("weight")).cast("double") / open_weight.cast("double"))
    return filled.select("source", "rank", "docs", "source_size", target.alias("target"))


def token_offsets(sizes: DataFrame, targets: DataFrame, p: MixParams) -> DataFrame:
    """Where each non-empty document begins in its source's word stream.

    A running sum in two levels: documents are dealt into hash buckets of about
    ``bucket_rows`` within their source, the bucket totals are summed up over
    the buckets, and positions are summed up inside each bucket. No task needs a
    whole source, however large.
    """
    a, b = (F.lit(x).cast("long") for x in constants(p.seed, 900))
    src = targets.select(F.col("source").alias("t_source"), "rank", "docs")
    dealt = (sizes.filter("size > 0").join(src, F.col("source").eqNullSafe(F.col("t_source")))
             .withColumn("bucket", F.pmod(mix_hash(F.coalesce(F.col("doc_id"), F.lit(0)).cast("long"), a, b),
                                          F.greatest(F.lit(1), F.ceil(F.col("docs") / p.bucket_rows))))
             .select("doc_id", "rank", "bucket", "size"))
    totals = dealt.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    up_to = (Window.partitionBy("rank").orderBy("bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("rank", "bucket", F.coalesce(F.sum("words").over(up_to), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("rank", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (dealt.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, ["rank", "bucket"])
            .select("doc_id", "rank", "size", (F.col("base") + F.col("before")).alias("start")))


def blocks(offsets: DataFrame, p: MixParams) -> DataFrame:
    """One row per document and block it touches: (rank, block, doc_id, size, start, skip, words).

    ``skip`` and ``words`` say which words of the document lie in the block.
    """
    n = p.block_words
    first, last = F.floor(F.col("start") / n), F.floor((F.col("start") + F.col("size") - 1) / n)
    out = offsets.select("*", F.explode(F.sequence(first, last)).alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * n)
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * n)
    return out.select("rank", "block", "doc_id", "size", "start",
                      (lo - F.col("start")).alias("skip"), (hi - lo).alias("words"))


def slot_quotas(targets: DataFrame, p: MixParams) -> DataFrame:
    """Per source: its blocks, the slots it should fill, and those as a share of a shard in parts of 2^20.

    ``ticks_before`` is the running sum of the undecided parts in source order,
    against which the multinomial's draws are looked up.
    """
    rows = (targets.filter("source_size > 0")
            .withColumn("n_blocks", F.ceil(F.col("source_size") / p.block_words))
            .withColumn("want", F.col("target") * F.col("n_blocks") / F.col("source_size")))
    everyone = Window.partitionBy()
    rows = rows.withColumn("slots", F.ceil(F.round(F.sum("want").over(everyone), 3)).cast("long"))
    return rows.select("rank", "n_blocks", "want", "slots")


def shard_draws(quotas: DataFrame, p: MixParams) -> DataFrame:
    """(rank, n_blocks, shard, count, first): slots each source fills per shard, and its first slot number.

    Each shard has ``shard_slots`` slots (the last one the remainder). A source
    surely gets the whole part of its expected count; the slots then left are
    drawn independently with the fractional parts as probabilities.
    """
    size = F.least(F.lit(p.shard_slots), F.col("slots") - F.col("shard") * p.shard_slots)
    grid = (quotas.withColumn("shard", F.explode(F.expr(f"sequence(0L, (slots - 1) div {p.shard_slots})")))
            .withColumn("in_shard", size.cast("long")))
    expect = F.col("want") * F.col("in_shard") / F.col("slots")
    scale = 1 << 20
    grid = (grid.withColumn("sure", F.floor(expect + 1e-9))
            .withColumn("ticks", F.greatest(F.lit(0), F.floor((expect - F.col("sure")) * scale)).cast("long")))
    of_shard = Window.partitionBy("shard")
    upto = of_shard.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    grid = (grid.withColumn("rest", F.col("in_shard") - F.sum("sure").over(of_shard))
            .withColumn("all_ticks", F.sum("ticks").over(of_shard))
            .withColumn("low", F.coalesce(F.sum("ticks").over(upto), F.lit(0))))
    a, b = (F.lit(x).cast("long") for x in constants(p.seed, 901))
    # The draws of a shard: at most one per source, as the fractional parts sum to less than that.
    spare = (grid.filter("all_ticks > 0 and rest > 0").groupBy("shard")
             .agg(F.max("rest").alias("rest"), F.max("all_ticks").alias("all_ticks"))
             .select("shard", "all_ticks", F.explode(F.expr("sequence(0L, rest - 1)")).alias("draw"))
             .select("shard", F.pmod(mix_hash(F.col("shard") * 4099 + F.col("draw"), a, b),
                                     F.col("all_ticks")).alias("u")))
    drawn = (spare.join(grid.filter("ticks > 0").select("shard", "rank", "low", "ticks"), "shard")
             .filter("u >= low and u < low + ticks")
             .groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("extra")))
    counts = (grid.join(drawn, ["shard", "rank"], "left")
              .withColumn("count", F.col("sure") + F.coalesce(F.col("extra"), F.lit(0))))
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0)))
            .select("rank", "n_blocks", "shard", "count", "first"))


def permutation_key(rank: Column, epoch: Column) -> Column:
    return rank.cast("long") * 1009 + epoch * 31


def permutation_rounds(key: Column, n: Column, p: MixParams) -> Column:
    """The rounds of one permutation of 0..n-1: per round (k, a, b), all that does not depend on the index."""
    return F.array(*[F.struct(
        F.pmod(mix_hash(key, *(F.lit(v).cast("long") for v in constants(p.seed, 2 * r))), n).alias("k"),
        F.lit(constants(p.seed, 2 * r + 1)[0]).cast("long").alias("a"),
        mix_hash(key, *(F.lit(v).cast("long") for v in constants(p.seed, 2 * r + 1))).alias("b")) for r in range(p.rounds)])


def permute(index: Column, n: Column, rounds: Column) -> Column:
    """Swap-or-not: in each round an index x and its partner k - x (mod n) change
    places or not, by one pseudorandom bit of the larger of the two."""
    prime, one = F.lit(PRIME).cast("long"), F.lit(1).cast("long")

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(r["k"] - x, n)
        top = F.pmod(F.greatest(x, partner), prime)
        bit = F.shiftright(F.pmod(top * r["a"] + r["b"], prime), 10).bitwiseAND(one)
        return F.when(bit == one, partner).otherwise(x)

    return F.aggregate(rounds, index, swap)


def mix_slots(targets: DataFrame, p: MixParams) -> DataFrame:
    """(rank, shard, slot, pass, block): every output slot and the block it reads.

    Slot j of a source reads block ``perm(j mod n_blocks)`` of pass ``j div
    n_blocks``. Slots beyond ``max_epochs`` passes stay empty: no block is read
    more often than that.
    """
    # few rows that become many: spread them first, over a stated number of tasks, as
    # adaptive execution would put rows this small into one
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = F.col("n_blocks")
    last = F.least(F.col("first") + F.col("count"), (F.col("pass") + 1) * n) - 1
    parts = (shard_draws(slot_quotas(targets, p), p).filter("count > 0")
             .withColumn("pass", F.explode(F.array(*[F.lit(e).cast("long") for e in range(p.max_epochs)])))
             .select("rank", "shard", "n_blocks", "pass", F.greatest(F.col("first"), F.col("pass") * n).alias("lo"), last.alias("hi"))
             .filter("lo <= hi").repartition(tasks, "rank", "shard", "pass"))
    # Checkpointed (a row per source, shard and pass), as the optimiser would else compute the
    # rounds anew for every slot; and unfolded by an outer generator, as it would put a filter on
    # the permuted array below any other and compute it twice. No array is empty here.
    rounds = permutation_rounds(permutation_key(F.col("rank"), F.col("pass")), n, p)
    parts = parts.withColumn("rounds", rounds).checkpoint()
    blocks = F.transform(F.sequence("lo", "hi"), lambda j: permute(j - F.col("pass") * n, n, F.col("rounds")))
    return (parts.select("rank", "shard", "pass", "lo", F.posexplode_outer(blocks).alias("nth", "block"))
            .select("rank", "shard", (F.col("lo") + F.col("nth")).alias("slot"), "pass", "block"))


def measured(docs: DataFrame, p: MixParams) -> tuple[DataFrame, DataFrame]:
    """Sizes (three short columns, checkpointed so that texts are counted once) and targets."""
    sizes = document_sizes(docs).checkpoint()
    return sizes, source_targets(sizes, p).checkpoint()


def mix(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """The mixed corpus: one row per output slot and document piece.

    Columns shard, slot, source, block, doc_id, skip, words: words
    ``skip .. skip + words`` of the document fill part of the slot.
    """
    sizes, targets = measured(docs, p)
    pieces = blocks(token_offsets(sizes, targets, p), p)
    names = targets.select("rank", "source")
    # slots grow with the corpus but look small to the planner before they are unfolded: no broadcast
    return (mix_slots(targets, p).hint("merge").join(pieces, ["rank", "block"]).join(names, "rank")
            .select("shard", "slot", "source", "block", "doc_id", "skip", "words"))


def mix_report(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken.

    Slots are counted per block before they meet the pieces, and the words
    taken are summed per document (identified by its place in the stream).
    """
    sizes, targets = measured(docs, p)
    offsets = token_offsets(sizes, targets, p)
    reads = mix_slots(targets, p).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    # reads grow with the corpus but look small to the planner before they are unfolded: no broadcast
    taken = (blocks(offsets, p).join(reads.hint("merge"), ["rank", "block"], "left")
             .groupBy("rank", "start", "doc_id", "size")
             .agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken")))
    src = targets.select("source", "rank", "source_size", "target")
    filled = taken.join(src, "rank")
    empty = (sizes.filter("size = 0").withColumnRenamed("source", "d_source").withColumn("taken", F.lit(0).cast("long"))
             .join(src, F.col("d_source").eqNullSafe(F.col("source"))))
    cols = ("doc_id", "source", "size", "source_size", "target", "taken")
    return filled.select(*cols).unionByName(empty.select(*cols))
