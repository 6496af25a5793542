"""Model operators: golden values, exact statistics, split, metrics, persistence."""

import math
import os

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from marquee import config as C
from marquee.operators import classifier as M
from marquee.operators import clustering as K
import pytest

from marquee.operators.stats import exact_quantiles, medians


def test_g1_confusion_and_report(spark):
    pairs = [(0, 0)] * 24 + [(0, 1)] * 2 + [(1, 0)] * 7 + [(1, 1)] * 26
    pred = spark.createDataFrame(pairs, "y_real int, y_pred int")
    acc = M.accuracy(pred).collect()[0]
    assert acc.n == 59 and math.isclose(acc.accuracy, 50 / 59)
    conf = {(r.y_real, r.y_pred): r.n for r in M.confusion(pred).collect()}
    assert conf == {(0, 0): 24, (0, 1): 2, (1, 0): 7, (1, 1): 26}
    rep = {r.clase: r for r in M.classification_report(pred).collect()}
    assert math.isclose(rep["1"].precision, 26 / 28) and math.isclose(rep["1"].recall, 26 / 33)
    assert math.isclose(rep["0"].precision, 24 / 31) and math.isclose(rep["0"].recall, 24 / 26)
    assert rep["0"].support == 26 and rep["weighted avg"].support == 59
    p1, r1 = 26 / 28, 26 / 33
    assert math.isclose(rep["1"].f1, 2 * p1 * r1 / (p1 + r1))


def test_g2_best_k(spark):
    metrics = spark.createDataFrame(
        [(2, 0.2280069381240792, 878.64), (3, 0.26510115003906287, 675.20),
         (4, 0.2755327543102876, 516.15), (5, 0.2168853377476345, 463.28),
         (6, 0.20974077625761123, 417.64)], "k int, silhouette_score double, inercia double")
    assert K.best_k(metrics).collect()[0].mejor_k == 4


def test_g3_segment_names(spark):
    summary = spark.createDataFrame(
        [(0, 166, 7841.0859375, 41.70894096385542, 7.217475903614457),
         (1, 10, 7352.111111111111, 383.4905, 6.7052),
         (2, 94, 3029.436170212766, 43.01693191489361, 7.00236170212766),
         (3, 22, 5314.375, 43.181095454545456, 1.6109090909090908)],
        "cluster int, peliculas bigint, promedio_reproducciones double, "
        "promedio_popularidad double, promedio_votos double")
    got = {r.cluster: r.segmento_cluster for r in K.segment_names(summary).collect()}
    assert got == {0: C.SEGMENT_LOCAL_CONSOLIDATED, 1: C.SEGMENT_GLOBAL_POPULAR,
                   2: C.SEGMENT_MODERATE, 3: C.SEGMENT_LOW_RATING}


def test_exact_median_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = [float(v) for v in rng.integers(0, 50, 30001)] + [float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    clean = [v for v in vals if v is not None and not math.isnan(v)]
    assert medians(df, ["x"])["x"] == float(np.median(clean))
    even = spark.createDataFrame([(float(v),) for v in rng.normal(size=40000)], "x double")
    ref = np.array([r.x for r in even.collect()])
    for q in (0.5, 0.9):
        assert math.isclose(exact_quantiles(even, ["x"], q)["x"], float(np.quantile(ref, q)), abs_tol=1e-12)


@pytest.mark.parametrize("limit", [20000, 2])
def test_exact_quantiles_with_infinities_and_huge_ranges(spark, limit):
    inf = float("inf")
    cols = {"a": [inf] * 3 + [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], "b": [-inf] * 5 + [1.0, 2.0, 3.0, inf],
            "c": [-1.7e308, 1.7e308, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 1e300], "d": [inf] * 9, "e": [1.0, -inf] + [None] * 7}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    for q in (0.0, 0.25, 0.5, 0.75, 1.0):
        got = exact_quantiles(df, list(cols), q, buckets=8, final_limit=limit)
        for c, vals in cols.items():
            v = sorted(x for x in vals if x is not None)
            pos = q * (len(v) - 1)
            lo, hi = v[math.floor(pos)], v[math.ceil(pos)]
            share = pos - math.floor(pos)
            want = lo if lo == hi or share == 0 else lo * (1 - share) + hi * share
            assert got[c] == pytest.approx(want), (c, q)


def test_exact_quantiles_refuses_to_loop(spark):
    tiny = 5e-324
    df = spark.createDataFrame([(0.0,)] * 5 + [(tiny,)] * 5, "x double")
    with pytest.raises(ArithmeticError):
        exact_quantiles(df, ["x"], 0.5, buckets=8, final_limit=2)


def test_exact_quantiles_several_columns(spark):
    rng = np.random.default_rng(7)
    n = 5001
    a = rng.normal(size=n)
    b = np.where(np.arange(n) % 2 == 0, 0.0, 1.0)             # two values, split between buckets
    c = np.concatenate([rng.integers(0, 5, n - 1), [1e12]])    # ties and one far outlier
    rows = [(float(x), float(y), float(z), None) for x, y, z in zip(a, b, c)]
    rows += [(float("nan"), None, float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    even = spark.createDataFrame(rows[1:n], df.schema)                # an even count
    for frame, ref in ((df, {"a": a, "b": b, "c": c}),
                       (even, {"a": a[1:n], "b": b[1:n], "c": c[1:n]})):
        for limit in (20000, 100, 1):
            for q in (0.5, 0.25, 0.9):
                got = exact_quantiles(frame, ["a", "b", "c", "d"], q, buckets=16, final_limit=limit)
                assert got["d"] is None
                for k in ("a", "b", "c"):
                    assert math.isclose(got[k], float(np.quantile(ref[k], q)), rel_tol=0, abs_tol=1e-9), (k, q, limit)


def test_stratified_split_loses_no_row(spark):
    """Null keys and null labels, repeated keys, tiny classes."""
    rows = ([(k, k % 2) for k in range(40)] + [(None, 1)] * 3 + [(None, None)] * 4 + [(k, None) for k in range(100, 110)]
            + [(7, 1)] * 5 + [(500, 2)])
    df = spark.createDataFrame(rows, "id_pelicula long, objetivo int")
    for bits in (4, 16):
        out = M.stratified_split(df, bucket_bits=bits).collect()
        assert sorted(((r.id_pelicula, r.objetivo) for r in out), key=str) == sorted(rows, key=str)
        for label in (0, 1, 2, None):
            own = [r for r in out if r.objetivo == label]
            assert sum(r.es_test for r in own) == math.ceil(0.2 * len(own))
            if any(not r.es_test and r.id_pelicula is not None for r in own):
                assert not any(r.es_test and r.id_pelicula is None for r in own)  # null keys come last
    lone = spark.createDataFrame([(None, 1), (1, 1), (2, None), (3, 0), (4, 0), (5, 0)], df.schema)
    assert M.stratified_split(lone).count() == 6
    assert M.stratified_split(df.limit(0)).count() == 0


def test_forest_knows_classes_seen_only_in_test_rows(spark):
    rows = [(k, k % 2, float(k % 2) * 10 + k % 3, 1.0, 2.0, "A" if k % 3 else "B") for k in range(60)]
    frame = spark.createDataFrame(rows, "id_pelicula long, objetivo int, popularidad_api double, votos_promedio_api double, "
                                        "reproducciones_mensuales double, clasificacion_edad_local string")
    test_ids = [r.id_pelicula for r in M.stratified_split(frame).where("es_test").collect()]
    rare = frame.withColumn("clasificacion_edad_local", F.when(F.col("id_pelicula").isin(test_ids[:3]), "only in test")
                            .otherwise(F.col("clasificacion_edad_local")))
    _, pred = M.train_and_predict(rare, num_trees=5, max_depth=4)
    assert sorted(r.id_pelicula for r in pred.collect()) == sorted(test_ids)


def test_stratified_split_exact_counts(spark):
    df = spark.range(0, 5003).select(F.col("id").alias("id_pelicula"),
                                     (F.col("id") % 3 == 0).cast("int").alias("objetivo"))
    split = M.stratified_split(df, bucket_bits=4)
    got = {(r.objetivo): r.n for r in split.where("es_test").groupBy("objetivo").count()
           .withColumnRenamed("count", "n").collect()}
    n1 = 5003 // 3 + 1
    assert got == {1: math.ceil(0.2 * n1), 0: math.ceil(0.2 * (5003 - n1))}
    assert split.count() == 5003
    # deterministic: the same rows every time
    again = M.stratified_split(df, bucket_bits=4).where("es_test").select("id_pelicula")
    assert sorted(again.collect()) == sorted(split.where("es_test").select("id_pelicula").collect())


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, "objetivo int")
    w = {r.objetivo: r.peso for r in M.class_weights(df).collect()}
    assert math.isclose(w[0], 40 / (2 * 30)) and math.isclose(w[1], 40 / (2 * 10))


def _blobs(spark):
    rng = np.random.default_rng(0)
    pts = []
    for c, center in enumerate([(0, 0), (5, 5), (0, 6)]):
        for p in rng.normal(size=(60, 2)) * 0.8 + center:
            pts.append((len(pts), c, float(p[0]), float(p[1])))
    return spark.createDataFrame(pts, "id_pelicula long, cluster int, a double, b double")


def test_silhouette_matches_spark_evaluator(spark):
    df = _blobs(spark)
    ours = K.silhouette_sq(df, ["a", "b"]).collect()[0][0]
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    ref = ClusteringEvaluator(predictionCol="cluster", distanceMeasure="squaredEuclidean").evaluate(vec)
    assert math.isclose(ours, ref, rel_tol=1e-9)


def test_inertia_matches_bruteforce(spark):
    df = _blobs(spark)
    rows = df.collect()
    brute = 0.0
    for c in {r.cluster for r in rows}:
        pts = np.array([(r.a, r.b) for r in rows if r.cluster == c])
        brute += float(((pts - pts.mean(axis=0)) ** 2).sum())
    assert math.isclose(K.inertia(df, ["a", "b"]).collect()[0][0], brute, rel_tol=1e-9)


def test_cluster_pipeline_roundtrip(spark, tmp_dir):
    import datetime as dt
    rows = [(i, 1000 + (i * 37) % 9000 if i % 7 else None, float((i * 13) % 200),
             float(i % 10), ["TE", "14", "18", None][i % 4], "x", dt.datetime(2026, 1, 1))
            for i in range(200)]
    df = spark.createDataFrame(rows, "id_pelicula int, reproducciones_mensuales int, "
                               "popularidad_api float, votos_promedio_api float, "
                               "clasificacion_edad_local string, alerta_accion string, "
                               "fecha_actualizacion timestamp")
    prep = K.fit_preprocessing(df)
    assert prep.mode in ("14", "18", "TE") and prep.levels == ("14", "18", "TE")
    model = K.fit_final(df, prep, 3, restarts=2)
    path = os.path.join(tmp_dir, "kmeans_model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = sorted((r.id_pelicula, r.cluster) for r in model.transform(df).select("id_pelicula", "cluster").collect())
    b = sorted((r.id_pelicula, r.cluster) for r in loaded.transform(df).select("id_pelicula", "cluster").collect())
    assert a == b
    # z-scores: population standard deviation, mean zero
    z = K.feature_columns(df, prep).agg(F.avg("z_popularidad_api"), F.stddev_pop("z_popularidad_api")).collect()[0]
    assert abs(z[0]) < 1e-9 and math.isclose(z[1], 1.0, rel_tol=1e-9)


def test_forest_is_fitted_on_few_partitions(spark, monkeypatch):
    """Nearly empty partitions, such as the split's, do not reach the forest; all rows do, in a stated order."""
    rows = [(k, k % 2, float(k % 2) * 10 + k % 3, 1.0, 2.0, "A" if k % 3 else "B") for k in range(90)] + [(None, 1, None, None, None, None)]
    frame = spark.createDataFrame(rows, "id_pelicula long, objetivo int, popularidad_api double, votos_promedio_api double, "
                                        "reproducciones_mensuales double, clasificacion_edad_local string")
    cores = spark.sparkContext.defaultParallelism
    many = frame.unionByName(frame.limit(3)).repartition(cores * 5, "id_pelicula")
    dealt = M.for_levels(many)
    assert dealt.rdd.getNumPartitions() == cores
    assert sorted(dealt.collect(), key=str) == sorted(many.collect(), key=str)
    assert dealt.collect() == M.for_levels(many).collect()
    few = frame.coalesce(2)
    assert M.for_levels(few) is few                       # nothing to deal
    assert M.for_levels(many, rows_per_partition=1) is many  # rows enough for each partition

    seen, fit = [], M.Pipeline.fit

    def watched(self, df, *more):
        seen.append((df.rdd.getNumPartitions(), df.count(), self.getStages()[-1].getCacheNodeIds()))
        return fit(self, df, *more)

    monkeypatch.setattr(M.Pipeline, "fit", watched)
    whole = frame.where("id_pelicula is not null").repartition(cores * 5, "id_pelicula")
    _, pred = M.train_and_predict(whole, num_trees=3, max_depth=3)
    assert seen == [(cores, 72, True)] and pred.count() == 18
