"""Exact order statistics without gathering a column.

``percentile``/``median`` buffer every value of a group in one task, and
``percentile_approx`` is approximate. ``exact_quantiles`` instead narrows the
candidate range with equal-width histograms: each pass is one distributed
aggregation returning at most ``buckets`` rows, and the final candidates are
collected only once they number at most ``final_limit``. Driver traffic is
bounded by those two constants whatever the data size. Infinities are counted
apart and take their places at the ends of the order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _clean(c: str):
    x = F.col(c).cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), x)


def _between(v_lo: float, v_hi: float, share: float) -> float:
    """Linear interpolation that keeps equal (also infinite) ends as they are."""
    return v_lo if v_lo == v_hi or share == 0 else v_lo * (1 - share) + v_hi * share


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float = 0.5, buckets: int = 1024,
                    final_limit: int = 20000) -> dict[str, float | None]:
    """Linear-interpolated quantiles of several columns over their non-null, non-NaN values.

    One aggregation gives every column's counts and finite range; then each
    round is at most two jobs for all columns at once: one histogram
    (``buckets`` rows per column still too wide) and one collection of the
    final candidates (at most ``final_limit`` values per column). The columns
    are unpivoted row-wise inside the scan stage, never materialised. A round
    that does not narrow a range is an error rather than an endless loop.
    """
    cols = list(cols)
    inf = float("inf")

    def finite(c: str):
        x = _clean(c)
        return F.when(F.abs(x) < inf, x)

    r = df.agg(*[e for i, c in enumerate(cols)
                 for e in (F.count(finite(c)).alias(f"n{i}"), F.min(finite(c)).alias(f"lo{i}"),
                           F.max(finite(c)).alias(f"hi{i}"),
                           F.count_if(_clean(c) == -inf).alias(f"below{i}"),
                           F.count_if(_clean(c) == inf).alias(f"above{i}"))]).collect()[0]
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), finite(c).alias("x"))
                                          for i, c in enumerate(cols)])).alias("v"))
            .select("v.i", "v.x").where(F.col("x").isNotNull()))
    ends: dict[int, dict[int, float]] = {}  # column -> rank -> value
    wanted: dict[int, tuple[int, int, float]] = {}
    state = {}  # column index -> [ranks still wanted, lo, hi, rows before lo, rows in range]
    result: dict[str, float | None] = {}
    for i, c in enumerate(cols):
        below, n, above = r[f"below{i}"], r[f"n{i}"], r[f"above{i}"]
        total = below + n + above
        if not total:
            result[c] = None
            continue
        pos = q * (total - 1)
        wanted[i] = math.floor(pos), math.ceil(pos), pos - math.floor(pos)
        ends[i] = {k: -inf if k < below else inf for k in wanted[i][:2] if k < below or k >= below + n}
        ranks = sorted({k for k in wanted[i][:2] if below <= k < below + n})
        if ranks:
            state[i] = [ranks, r[f"lo{i}"], r[f"hi{i}"], below, n]

    def in_range(idx):
        cond = None
        for j in idx:
            e = (F.col("i") == j) & (F.col("x") >= F.lit(state[j][1])) & (F.col("x") <= F.lit(state[j][2]))
            cond = e if cond is None else cond | e
        return long.where(cond)

    while state:
        for j in [j for j, st in state.items() if st[1] == st[2]]:
            ranks, lo = state.pop(j)[:2]
            ends[j].update({k: lo for k in ranks})
        ready = [j for j, st in state.items() if st[4] <= final_limit]
        wide = [j for j in state if j not in ready]
        if ready:
            vals: dict[int, list] = {j: [] for j in ready}
            for row in in_range(ready).collect():
                vals[row["i"]].append(row["x"])
            for j in ready:
                ranks, _, _, off, _ = state.pop(j)
                v = sorted(vals[j])
                ends[j].update({k: v[k - off] for k in ranks})
        if wide:
            lo_e = F.lit(None).cast("double")
            w_e = F.lit(None).cast("double")
            for j in wide:
                _, lo, hi, _, _ = state[j]
                width = hi / buckets - lo / buckets  # no overflow for ends of opposite sign
                if not width > 0:
                    raise ArithmeticError(f"the range of {cols[j]} is too narrow to divide: {lo} to {hi}")
                lo_e = F.when(F.col("i") == j, F.lit(lo)).otherwise(lo_e)
                w_e = F.when(F.col("i") == j, F.lit(width)).otherwise(w_e)
            b = F.least(F.floor(F.col("x") / w_e - lo_e / w_e).cast("int"), F.lit(buckets - 1))
            b = F.greatest(b, F.lit(0))
            hist = (in_range(wide).groupBy("i", b.alias("b"))
                    .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
                    .collect())
            for j in wide:
                ranks, lo, hi, seen, count = state[j]
                homes = {}
                for h in sorted((h for h in hist if h["i"] == j), key=lambda h: h["lo"]):
                    for k in ranks:
                        if seen <= k < seen + h["n"]:
                            homes[k] = h, seen
                    seen += h["n"]
                if len(ranks) == 2 and homes[ranks[0]][0] is not homes[ranks[1]][0]:
                    # Adjacent ranks in different buckets: the lower one is the
                    # top of its bucket, the upper one the bottom of the next.
                    ends[j].update({ranks[0]: homes[ranks[0]][0]["hi"], ranks[1]: homes[ranks[1]][0]["lo"]})
                    state.pop(j)
                    continue
                h, before = homes[ranks[0]]
                if h["n"] == count:
                    raise ArithmeticError(f"the values of {cols[j]} between {lo} and {hi} can't be told apart")
                state[j] = [ranks, h["lo"], h["hi"], before, h["n"]]
    for i, (k_lo, k_hi, share) in wanted.items():
        result[cols[i]] = _between(ends[i][k_lo], ends[i][k_hi], share)
    return result


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return exact_quantiles(df, cols, 0.5)
