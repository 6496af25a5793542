"""Exact distinct ids by bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from marquee.operators.distinct import INT_MAX, INT_MIN, distinct_ids
from marquee.operators.final import load_check


def counts(spark, ids, kind="long"):
    frame = spark.createDataFrame([(i,) for i in ids], f"id_pelicula {kind}")
    return tuple(distinct_ids(frame, "id_pelicula", {"filas": F.lit(1)}).first())


EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, INT_MAX, INT_MIN, INT_MAX + 1, INT_MIN - 1,
         2 ** 62, -(2 ** 62), 2 ** 63 - 1, -(2 ** 63)]


@pytest.mark.parametrize("ids", [[], [None], [None, None, 7], EDGES, EDGES * 3 + [None], [5] * 1000 + list(range(-40, 40))])
def test_edges_nulls_and_repeats(spark, ids):
    assert counts(spark, ids) == (len({i for i in ids if i is not None}), len(ids))


def test_random_ids_match_a_set(spark):
    rng = random.Random(11)
    ids = [rng.choice([rng.randint(-70000, 70000), rng.randint(-2 ** 63, 2 ** 63 - 1), 12]) for _ in range(4000)]
    assert counts(spark, ids) == (len(set(ids)), 4000)
    small = [rng.randint(INT_MIN, INT_MAX) for _ in range(300)]
    assert counts(spark, small, "int") == (len(set(small)), 300)


def test_a_hot_id_and_sorted_ids_ship_few_bitmaps(spark):
    """A third of the rows has one id: what is exchanged is a row per task and bitmap, not per id."""
    rows = spark.range(0, 300_000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id")).alias("id_pelicula"))
    out = distinct_ids(rows, "id_pelicula", {"filas": F.lit(1)})
    assert tuple(out.first()) == (rows.distinct().count(), 300_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("bitmap_construct_agg") >= 2 and "partial_bitmap_construct_agg" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "id_pelicula" not in exchanges[0]  # dealt by bitmap


def test_load_check_counts_repeats(spark):
    frame = spark.createDataFrame([(i,) for i in [1, 1, 2, 40000, 40000, 40000]], "id_pelicula int")
    assert load_check(frame).first().asDict() == {"total_cargado": 6, "ids_duplicados": 3}
    assert load_check(frame.limit(0)).first().asDict() == {"total_cargado": 0, "ids_duplicados": 0}
