"""Rows of a CSV file whose quoted cells may hold line breaks, read in parallel splits.

A reader that starts in the middle of a file can't tell whether a line break
ends a row. But a line does one of four things to the question "inside a quoted
cell?": it keeps the answer, turns it round, or ends outside or inside whatever
the answer was. Such effects chain, so:

1. one pass reduces every split to its effect, and a fold over the splits of a
   file gives the state at the start of each;
2. splits that start outside and hold no line that ends inside need nothing
   more: their lines are rows. In the others the state of every line follows
   from the split's start, and lines that begin inside a cell are joined to the
   row begun before them, which may lie in an earlier split.

A quote opens a cell only at the cell's start; inside, a doubled quote is a
quote. Lines end with ``\\n``; a ``\\r`` before it is cut at the end of a row and
kept inside a cell. Text is UTF-8. A cell never closed runs to the file's end.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.session import checkpoint_root

# What a line does to the state (1: inside a quoted cell).
KEEP, TURN, OUTSIDE, INSIDE = 0, 1, 2, 3
SPLIT = ("archivo", "inicio")
# Split rows (a path and a few numbers, some 200 bytes) sent to every task; beyond that the join shuffles.
MAX_BROADCAST_SPLITS = 50_000


def line_effect(line: Column, sep: str, quote: str) -> Column:
    q, s = re.escape(quote), re.escape(sep)
    inside = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"            # up to the closing quote, or the line's end
    cell = f"(?:{q}{inside}{q}[^{s}]*+|[^{q}{s}][^{s}]*+|)"
    left_open = f"(?:{cell}{s})*+{q}{inside}$"           # whole cells, then one that is not closed
    from_outside = line.rlike(f"(?s)^{left_open}")
    from_inside = line.rlike(f"(?s)^{inside}(?:$|{q}[^{s}]*+{s}{left_open})")
    return F.when(~line.contains(quote), KEEP).otherwise(
        F.when(from_outside, F.when(from_inside, INSIDE).otherwise(TURN)).otherwise(F.when(from_inside, KEEP).otherwise(OUTSIDE)))


def after(state: Column, effect: Column) -> Column:
    """The state after a line (or split) of this effect."""
    return (F.when(effect == OUTSIDE, 0).when(effect == INSIDE, 1).when(effect == TURN, 1 - state).otherwise(state))


def then(first: Column, second: Column) -> Column:
    """The effect of one after the other."""
    fixed = F.when(second >= OUTSIDE, second)
    turned = F.when(first == KEEP, TURN).when(first == TURN, KEEP).when(first == OUTSIDE, INSIDE).otherwise(OUTSIDE)
    return fixed.otherwise(F.when(second == TURN, turned).otherwise(first))


def _lines(spark: SparkSession, path, sep: str, quote: str) -> DataFrame:
    """(archivo, inicio, n, line, effect): physical lines; n grows with the place in a split."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("archivo"), F.col("_metadata.file_block_start").alias("inicio"),
                    F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))
            .withColumn("effect", line_effect(F.col("line"), sep, quote)))


def _split_states(lines: DataFrame) -> DataFrame:
    """(archivo, inicio, state, quiet, head): the state at each split's start, whether every line of it is a row,
    and the first line that is not empty."""
    blank = F.col("line").isin("", "\r")
    # only lines that change something are gathered, of one split at a time, as one byte and a place each
    per_split = lines.groupBy(*SPLIT).agg(
        F.array_sort(F.collect_list(F.when(F.col("effect") != KEEP, F.struct("n", F.col("effect").cast("tinyint").alias("effect")))))
        .alias("changes"), F.min(F.when(~blank, F.col("n"))).alias("head"))
    folded = per_split.select(*SPLIT, "head", F.size("changes").alias("changes"), F.aggregate(
        "changes", F.lit(KEEP), lambda sofar, x: then(sofar, x["effect"].cast("int"))).alias("effect"))
    # a file's splits in order: one small row each
    before = Window.partitionBy("archivo").orderBy("inicio").rowsBetween(Window.unboundedPreceding, -1)
    state = F.aggregate(F.collect_list("effect").over(before), F.lit(0), lambda state, effect: after(state, effect))
    return (folded.withColumn("state", state)
            .select(*SPLIT, "state", ((F.col("state") == 0) & (F.col("changes") == 0)).alias("quiet"),
                    F.when(F.col("inicio") == 0, F.col("head")).alias("head")))


def _with_splits(lines: DataFrame, splits: DataFrame, few: bool) -> DataFrame:
    """The lines with their split's columns; the splits are broadcast if they are ``few``."""
    named = splits.select(*[F.col(c).alias(f"s_{c}") for c in SPLIT], *[c for c in splits.columns if c not in SPLIT])
    named = F.broadcast(named) if few else named
    return lines.join(named, (F.col("archivo") == F.col("s_archivo")) & (F.col("inicio") == F.col("s_inicio"))).drop(
        "s_archivo", "s_inicio")


def _row_starts(busy: DataFrame) -> DataFrame:
    """Add ``begun``: the line that begins the row a line belongs to, null where an earlier split has it."""
    split = Window.partitionBy(*SPLIT).orderBy("n")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    # the state before a line is that after the last fixed effect, turned round by every turn since
    turn = F.when(F.col("effect") == TURN, 1).otherwise(0)
    fixed = F.when(F.col("effect") >= OUTSIDE, F.struct(F.col("effect").alias("effect"), F.col("turns").alias("turns")))
    inside = F.when(F.col("last").isNull(), (F.col("state") + F.col("turns")) % 2).otherwise(
        (F.col("last.effect") - OUTSIDE + F.col("turns") - F.col("last.turns")) % 2) == 1
    return (busy.withColumn("turns", F.coalesce(F.sum(turn).over(before), F.lit(0)))
            .withColumn("last", F.last(fixed, ignorenulls=True).over(before))
            .withColumn("begun", F.last(F.when(~inside, F.col("n")), ignorenulls=True).over(
                split.rowsBetween(Window.unboundedPreceding, 0))).drop("turns", "last"))


def read_rows(spark: SparkSession, path, sep: str = ",", quote: str = '"') -> DataFrame:
    """(archivo, inicio, n, row, first): one row of text per CSV row, line breaks inside cells kept.

    (archivo, inicio, n) orders the rows; ``first`` marks the first row of each
    file. Empty lines between rows are left out. The pass over the splits runs
    when this is called.
    """
    checkpoint_root(spark)
    lines = _lines(spark, path, sep, quote)
    splits = _split_states(lines).checkpoint()
    found = splits.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("quiet")).alias("busy")).first()
    few = found["n"] <= MAX_BROADCAST_SPLITS
    placed = _with_splits(lines, splits, few)
    rows = placed.filter("quiet").select(*SPLIT, "n", F.col("line").alias("row"), "head")
    if found["busy"]:
        busy = _row_starts(placed.filter("not quiet"))
        # a row may go on in later splits: which row each split's first lines belong to
        ends = busy.groupBy(*SPLIT).agg(F.max("begun").alias("begun"))
        earlier = Window.partitionBy("archivo").orderBy("inicio").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.withColumn("row_from", F.last(
            F.when(F.col("begun").isNotNull(), F.struct("inicio", "begun")), ignorenulls=True).over(earlier)).drop("begun")
        own = F.col("begun").isNotNull()
        linked = (_with_splits(busy, carried, few)
                  .withColumn("piece", F.struct(F.col("inicio").alias("i"), F.col("n").alias("k"), "line"))
                  .withColumn("inicio", F.when(own, F.col("inicio")).otherwise(F.col("row_from.inicio")))
                  .withColumn("n", F.when(own, F.col("begun")).otherwise(F.col("row_from.begun"))))
        joined = linked.groupBy(*SPLIT, "n").agg(F.array_sort(F.collect_list("piece")).alias("pieces"), F.max("head").alias("head"))
        rows = rows.unionByName(joined.select(
            *SPLIT, "n", F.array_join(F.transform("pieces", lambda x: x["line"]), "\n").alias("row"), "head"))
    rows = rows.withColumn("row", F.regexp_replace("row", "\r$", "")).filter(F.col("row") != "")
    return rows.select(*SPLIT, "n", "row", F.coalesce(F.col("n") == F.col("head"), F.lit(False)).alias("first"))
