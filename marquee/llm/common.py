"""Helpers shared by the operators: columns, hashing, scratch data, ranking at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import checkpoint_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Rows per Arrow batch sent to Python. Documents can be over 100 KB, and a
# batch of the default 10,000 rows would not fit beside the JVM.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session and make sure checkpoints go to the shared folder."""
    checkpoint_root(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` has a fast path for pure ASCII text and agrees there; other text
    goes through ``translate``, which leaves non-ASCII capitals alone.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def hash128(c: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a column; together they stand for its value."""
    return F.xxhash64(c), F.xxhash64(F.lit(7919), c)


def held_out_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32(doc_id as text) mod ``modulus`` is ``remainder``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus)) == remainder


# A group of more rows than this is split up wherever it would meet in one task.
GROUP_ROWS = 500_000


def heavy_cut(total: int) -> int:
    """Rows from which a key counts as heavy: over 1/1000 of ``total``, or over GROUP_ROWS.

    At most max(1000, total / GROUP_ROWS) keys can be that frequent, whatever the
    data: a table of them is small enough to broadcast by construction.
    """
    return max(1, min(total // 1000, GROUP_ROWS))


def heavy_values(counts: DataFrame, total: int) -> DataFrame:
    """Rows of ``counts`` whose ``n`` (summing to ``total``) is over the cut."""
    return counts.filter(F.col("n") > heavy_cut(total))


def spread_join(left: DataFrame, right: DataFrame, on: str | list[str], n: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right``, whose ``on`` (a column or several) is unique and whose column ``n`` says how many left rows match.

    Heavy keys (see ``heavy_cut``) are broadcast, so that their rows stay where
    they are; the rest is left to Spark's join.
    """
    cut = heavy_cut(total)
    heavy = F.broadcast(right.filter(F.col(n) > cut).drop(n))
    light = right.filter(F.col(n) <= cut).drop(n)
    return left.join(heavy, on).unionByName(left.join(heavy.select(on), on, "left_anti").join(light, on))
