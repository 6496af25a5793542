"""Chat formatting with cumulative-snapshot collapse, with DataFrame functions only.

A chat logged after every turn leaves one conversation per snapshot, each a
prefix of the next. Every turn gets a rolling hash of the conversation up to
and including it: running sums of three 40-bit hashes of (position, role,
text), 120 bits together. A conversation whose whole hash equals a proper
prefix of another one is a snapshot and goes, by an anti-join; of equal
conversations the one with the smallest id stays. What is left is rendered.

Copies meet in aggregates that combine before the shuffle (one row per prefix,
however common), so a first turn or a whole conversation shared by a third of
the log makes no large group. Long conversations: running sums go in two
levels, over blocks of ``BLOCK`` turn numbers and inside each block.

Rows repeated exactly count once. Order is by turn (null last), then role and
text; positions count from 1, whatever numbers the turns carry. Rows without
conv_id belong to no conversation and are left out. A null role renders as
``unknown``, a null text as empty. The markers in texts and roles are broken up by a
blank, so text cannot open a turn. Empty table: no rows. Extra columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SUMS = ("s1", "s2", "s3")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): distinct rows in order, positions from 1."""
    rows = (conversations.filter("conv_id is not null").select("conv_id", "turn", "role", "text").distinct()
            .withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(9223372036854775807))))
    before = _before(rows, "block", F.count(F.lit(1)).alias("n"), ["n"])
    inner = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    return (rows.withColumn("nth", F.row_number().over(inner)).join(before, ["conv_id", "block"])
            .select("conv_id", (F.col("b_n") + F.col("nth")).alias("pos"), "role", "text"))


def _before(rows: DataFrame, block: str, aggs, names: list[str]) -> DataFrame:
    """Per (conv_id, block): totals of the conversation's earlier blocks, as b_<name>."""
    aggs = aggs if isinstance(aggs, (list, tuple)) else [aggs]
    earlier = Window.partitionBy("conv_id").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("conv_id", block).agg(*aggs).select(
        "conv_id", block, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"b_{n}") for n in names])


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, s1, s2, s3): hash of the first ``pos`` turns of each conversation."""
    one = lambda k: F.shiftright(F.xxhash64(F.lit(k), "pos", F.coalesce("role", F.lit("unknown")),
                                            F.coalesce("text", F.lit(""))), 24)
    hashed = (turns.select("conv_id", "pos", *[one(k).alias(s) for k, s in enumerate(SUMS, 1)])
              .withColumn("block", F.floor(F.col("pos") / BLOCK)))
    before = _before(hashed, "block", [F.sum(s).alias(s) for s in SUMS], list(SUMS))
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = hashed.select("conv_id", "block", "pos", *[F.sum(s).over(upto).alias(f"r_{s}") for s in SUMS])
    return run.join(before, ["conv_id", "block"]).select(
        "conv_id", "pos", *[(F.col(f"b_{s}") + F.col(f"r_{s}")).alias(s) for s in SUMS])


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no proper prefix of another, one per content."""
    hashes = prefix_hashes(turns).checkpoint()
    length = hashes.groupBy("conv_id").agg(F.max(F.struct("pos", *SUMS)).alias("whole"))
    finals = (length.select("conv_id", "whole.*").groupBy("pos", *SUMS)
              .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")))
    ends = length.select("conv_id", F.col("whole.pos").alias("n_turns"))
    inner = (hashes.join(ends, "conv_id").filter("pos < n_turns").select("pos", *SUMS).distinct())
    return (finals.join(inner, ["pos", *SUMS], "left_anti")
            .select("conv_id", F.col("pos").alias("n_turns"), "n_copies"))


def render_turn(role: Column, text: Column) -> Column:
    def plain(c):
        return F.replace(F.replace(c, F.lit(OPEN), F.lit("<| im_start|>")), F.lit(CLOSE), F.lit("<| im_end|>"))
    return F.concat(F.lit(OPEN), plain(F.coalesce(role, F.lit("unknown"))), F.lit("\n"),
                    plain(F.coalesce(text, F.lit(""))), F.lit(CLOSE + "\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Per maximal conversation: conv_id, n_turns, n_copies (equal ones, itself included), rendered."""
    turns = numbered_turns(conversations).checkpoint()
    kept = maximal_conversations(turns)
    pieces = turns.join(kept, "conv_id").select(
        "conv_id", "n_turns", "n_copies", "pos", render_turn(F.col("role"), F.col("text")).alias("piece"))
    # One row per conversation is the result's own shape; a group is one conversation's text.
    return (pieces.groupBy("conv_id", "n_turns", "n_copies")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("turns"))
            .select("conv_id", "n_turns", "n_copies",
                    F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("rendered")))
