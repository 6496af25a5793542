"""Exact counts of different integer ids by bitmaps.

``count_distinct`` shuffles every id that a task has seen. Here a task sets one
bit per id in bitmaps of 32,768 ids and ships those: an id range that is well
filled costs a bit an id, and a hot id one bit, however many rows have it. 32-bit
ids fill at most 131,072 bitmaps of 4 KB, whatever the number of rows, and in
files sorted by the id every task touches a few of them only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def distinct_ids(df: DataFrame, key: str, sums: Mapping[str, Column] | None = None, name: str = "distintos") -> DataFrame:
    """One row: the different non-null integers in ``key`` as ``name``, and the sum of each column of ``sums``.

    Ids that 32 bits cannot hold are grouped by themselves: these may be
    scattered so thinly that a bitmap would hold one bit. An empty frame gives zeros.
    """
    sums = dict(sums or {})
    id_ = F.col(key).cast("long")
    near = F.when(id_.between(INT_MIN, INT_MAX), id_)
    far = F.when(near.isNull(), id_)
    per_bitmap = (df.groupBy(F.bitmap_bucket_number(near).alias("_bucket"), far.alias("_far"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(near)).alias("_bits"),
                       *[F.sum(c).alias(n) for n, c in sums.items()]))
    ids = F.when(F.col("_far").isNotNull(), F.lit(1).cast("long")).otherwise(F.bitmap_count("_bits"))
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in ((name, ids), *((n, F.col(n)) for n in sums))]
    return per_bitmap.agg(*total)
