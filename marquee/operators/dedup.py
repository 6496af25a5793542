"""Keep-first de-duplication, expressed as an aggregation.

``row_number() over (partition by key order by ord) = 1`` sends every row of
a key to one task and sorts it there; with one hot key that is a third of the
data in one task. ``min(struct(ord, rest))`` is an aggregate: each map task
keeps one candidate per key before the shuffle, so a hot key costs one row per
map partition on the wire, and every column travels once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str] = ("ord",),
                  drop_null_keys: bool = True) -> DataFrame:
    """One row per ``key``: the row that comes first by ``order_by``."""
    keys = [key] if isinstance(key, str) else list(key)
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    # Order columns first; the remaining columns break ties, so the result is
    # deterministic even when the arrival order is repeated.
    order = list(order_by)
    rest = [c for c in df.columns if c not in order and c not in keys]
    if not order and not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(*keys, "_first.*").select(*df.columns)


def duplicated_rows(df: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """Rows whose ``key`` appears more than once (every copy).

    ``keys`` may be a cheaper frame of the same rows that has the key alone; the
    counts come from it and combine map-side, the null keys' among them. Null
    keys repeat one another: they go round the join of the others (one group of
    them would be a single task) and meet the one row that says whether there
    are two or more. AQE splits a hot key's partition of the semi join.
    """
    keys = df.select(key) if keys is None else keys.select(key)
    repeated = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    out = df.join(repeated.where(F.col(key).isNotNull()).select(key), key, "left_semi").select(*df.columns)
    nulls = repeated.where(F.col(key).isNull()).select(F.lit(True).alias("_any"))  # one row or none
    lost = df.where(F.col(key).isNull()).withColumn("_null", F.lit(True))
    return out.unionByName(lost.join(F.broadcast(nulls), F.col("_null") == F.col("_any"), "left_semi").select(*df.columns))
