"""Batched KMeans and the sampled Euclidean silhouette against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import clustering as K
from marquee.operators import kmeans, silhouette
from tests.conftest import SF001


def blobs(spark, sizes=(60, 45, 30, 200), seed=4):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(c, 0.35, (n, 3)) for n, c in zip(sizes, ([0, 0, 0], [6, 0, 0], [0, 6, 0], [0, 0, 6]))])
    truth = np.repeat(np.arange(len(sizes)), sizes)
    rows = [(i, *map(float, r), int(t), "far" if t == 3 else "near") for i, (r, t) in enumerate(zip(x, truth))]
    return x, truth, spark.createDataFrame(rows, "id_pelicula long, a double, b double, c double, four int, two string").repartition(4)


def exact(x, labels):
    """(mean silhouette) from all pairs."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    kinds, size = np.unique(labels, return_counts=True)
    out = []
    for i in range(len(x)):
        mean = {k: d[i][labels == k].sum() / (n - (k == labels[i])) if n - (k == labels[i]) else 0.0 for k, n in zip(kinds, size)}
        a, b = mean[labels[i]], min(v for k, v in mean.items() if k != labels[i])
        alone = size[kinds == labels[i]][0] == 1
        out.append(0.0 if alone or max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(out))


# --- KMeans -----------------------------------------------------------------

def test_models_of_all_k_advance_together_and_find_the_groups(spark):
    x, truth, frame = blobs(spark)
    metrics, models = K.kmeans_search(frame, ["a", "b", "c"], ks=(2, 3, 4, 5), restarts=4)
    rows = {r.k: r for r in metrics.collect()}
    assert K.best_k(metrics).first().mejor_k == 4
    got = {r.id_pelicula: r.l for r in frame.select("id_pelicula", models[4].label().alias("l")).collect()}
    found = {tuple(sorted(i for i in got if got[i] == g)) for g in set(got.values())}
    assert found == {tuple(np.nonzero(truth == t)[0].tolist()) for t in range(4)}
    means = np.array([x[truth == t].mean(axis=0) for t in range(4)])
    assert abs(rows[4].inercia - ((x - means[truth]) ** 2).sum()) < 1e-6
    assert rows[2].inercia > rows[3].inercia > rows[4].inercia > rows[5].inercia
    for k, m in models.items():
        labels = np.array([r.l for r in frame.select("id_pelicula", m.label().alias("l")).orderBy("id_pelicula").collect()])
        assert abs(rows[k].silhouette_score - exact(x, labels)) < 1e-9 and rows[k].silhouette_error == 0
        cost = frame.agg(F.sum(m.distance())).first()[0]
        assert abs(cost - rows[k].inercia) < 1e-6 * cost


def test_one_lloyd_pass_is_that_of_numpy(spark):
    x, _, frame = blobs(spark)
    rows = frame.select("a", "b", "c")
    models = [x[:3].copy(), x[100:107].copy()]
    for model, (n, sums, cost) in zip(models, kmeans.centre_sums(rows, models)):
        d = ((x[:, None] - model[None]) ** 2).sum(axis=2)
        near = d.argmin(axis=1)
        assert (n == np.bincount(near, minlength=len(model))).all()
        assert np.allclose(sums, [x[near == k].sum(axis=0) for k in range(len(model))]) and np.isclose(cost, d.min(axis=1).sum())


def test_a_fit_is_the_same_again_and_no_step_makes_it_worse(spark):
    _, _, frame = blobs(spark)
    rows = frame.select("a", "b", "c").persist()
    short, full, again = (kmeans.fit_all(rows, [3, 3, 5], 7, n) for n in (1, 100, 100))
    assert all((a.values == b.values).all() and a.cost == b.cost for a, b in zip(full, again))
    assert all(f.cost <= s.cost + 1e-9 for f, s in zip(full, short))
    rows.unpersist()


def test_seeds_are_few_rows_and_fewer_rows_than_centres_do_not_fail(spark):
    _, _, frame = blobs(spark)
    rows = frame.select("a", "b", "c")
    assert [len(m) for m in kmeans.seed_models(rows, [2, 6], 1)] == [2, 6]
    same = spark.createDataFrame([(1.0, 2.0)] * 30 + [(3.0, 4.0)], "a double, b double")
    fitted = kmeans.fit_all(same, [4], 1, 10)[0]
    assert fitted.values.shape == (4, 2) and fitted.cost == 0
    with pytest.raises(ValueError):
        kmeans.fit_all(same.limit(0), [2], 1, 10)


# --- silhouette -------------------------------------------------------------

def test_whole_clusters_give_the_exact_value(spark):
    x, truth, frame = blobs(spark, sizes=(20, 1, 30, 40))
    found = silhouette.silhouettes(frame, ["a", "b", "c"], ["four", "two"], "id_pelicula")
    assert abs(found["four"][0] - exact(x, truth)) < 1e-9 and found["four"][1] == 0
    assert abs(found["two"][0] - exact(x, (truth == 3).astype(int))) < 1e-9


@pytest.mark.parametrize("t", [15, 60, 150])
def test_sampled_clusters_stay_within_the_stated_bound(spark, t):
    """One heavy cluster, far rows in it: the estimate is within the bound, and the bound shrinks with the sample."""
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(0, 1, (1500, 2)), rng.normal(4, 1, (500, 2)), [[60, 60], [-70, 5]]])
    labels = np.r_[np.zeros(1500), np.ones(500), np.zeros(2)].astype(int)
    frame = spark.createDataFrame([(i, float(a), float(b), int(k)) for i, ((a, b), k) in enumerate(zip(x, labels))],
                                  "id_pelicula long, a double, b double, k int")
    score, error = silhouette.silhouettes(frame, ["a", "b"], ["k"], "id_pelicula", t)["k"]
    assert 0 < abs(score - exact(x, labels)) <= error < 3 / np.sqrt(t)
    samples = silhouette.cluster_samples(frame, ["a", "b"], ["k"], "id_pelicula", t)["k"]
    assert all(len(s) <= 3 * t for _, s, _ in samples.values())
    assert {n for n, _, _ in samples.values()} == {1502, 500}
    far = samples["0"][1]
    assert t < 60 or (far == [60, 60]).all(axis=1).any()  # drawn for certain, as it weighs most


def large(spark, n=5000):
    """Clusters of thousands of rows, rows that come often, a far row, a cluster of one row; keys null or repeated."""
    rng = np.random.default_rng(17)
    x = np.vstack([rng.normal(0, 1, (n // 2, 2)), rng.normal(3, 2, (n // 2 - 300, 2)), np.tile([[0.5, -0.25]], (300, 1)), [[80, -90]]])
    labels = {"two": (x[:, 0] > 1).astype(int), "five": np.r_[rng.integers(0, 4, n), 4]}
    rows = [(None if i % 3 else 7, float(a), float(b), int(p), f"c{q}") for i, ((a, b), p, q) in enumerate(zip(x, *labels.values()))]
    return x, labels, spark.createDataFrame(rows, "id_pelicula long, a double, b double, two int, five string").repartition(5)


@pytest.mark.parametrize("least", [100, 700, 10_000])
def test_large_clusters_are_taken_whole(spark, monkeypatch, least):
    x, labels, frame = large(spark)
    monkeypatch.setattr(silhouette, "LEAST_ROWS", least)
    monkeypatch.setattr(silhouette, "BLOCK_ROWS", 1500)
    found = silhouette.silhouettes(frame, ["a", "b"], list(labels), "id_pelicula")
    for by, label in labels.items():
        assert found[by][1] == 0 and abs(found[by][0] - exact(x, label)) < 1e-12


def test_the_search_reports_the_exact_silhouette_of_large_clusters(spark):
    x, _, frame = large(spark)
    metrics, models = K.kmeans_search(frame, ["a", "b"], ks=(2, 3), restarts=2)
    for r in metrics.collect():
        labels = ((x[:, None] - models[r.k].values[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert np.bincount(labels).max() > 2048
        assert r.silhouette_error == 0 and abs(r.silhouette_score - exact(x, labels)) < 1e-12


def test_silhouette_query_matches_all_pairs_of_large_clusters(spark, tmp_path):
    import datetime as dt

    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from marquee.plans.registry import oracle_queries, spark_queries
    from tests.oracle_check import compare
    films = 4600
    tables = {
        "orders": {"o_orderkey": list(range(1, films * 2)), "o_custkey": [k * 37 % films for k in range(1, films * 2)],
                   "o_orderdate": [dt.datetime(2001, 1, 1) + dt.timedelta(days=k % 999) for k in range(1, films * 2)]},
        "part": {"p_partkey": list(range(films)), "p_name": [f"blue film {k}" for k in range(films)]},
        "customer": {"c_custkey": list(range(films)), "c_nationkey": [k * 7 % 25 for k in range(films)]},
    }
    con = duckdb.connect()
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet')")
    res = compare(spark_queries()["silhouette_euclidean"](spark, str(tmp_path)), oracle_queries()["silhouette_euclidean"], con)
    assert res["match"], res


def test_blocks_meet_whole_whatever_their_runs():
    """Near, equal and far rows, runs shorter than a tile and longer, rows that count several times."""
    rng = np.random.default_rng(3)
    for n, m, width, kinds, scale in ((700, 900, 3, 7, 1.0), (300, 300, 2, 40, 1.0), (700, 900, 3, 7, 1e-5), (10, 3, 1, 2, 1.0)):
        x, y = (rng.normal(5, scale, (k, width)) for k in (n, m))
        y[:m // 3], y[0] = x[0], 1000.0
        p, q = (np.sort(rng.integers(0, kinds, k)) for k in (n, m))
        p, q = (np.column_stack([g, kinds + g % 3]) for g in (p, q))
        times, other = rng.integers(1, 4, n).astype(float), rng.integers(1, 4, m).astype(float)
        d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
        of_x, of_y = silhouette.block_sums(x, times, p, y, other, q, kinds + 3, True)
        for c in range(kinds + 3):
            assert np.allclose(of_x[c], d @ (other * (q == c).any(axis=1)), rtol=1e-12, atol=1e-12 * d.sum())
            assert np.allclose(of_y[c], (times * (p == c).any(axis=1)) @ d, rtol=1e-12, atol=1e-12 * d.sum())


def test_equal_rows_and_one_cluster(spark):
    same = spark.createDataFrame([(i, 1.0, i % 2) for i in range(20)], "id_pelicula long, a double, k int")
    assert silhouette.silhouettes(same, ["a"], ["k"], "id_pelicula")["k"] == (0.0, 0.0)
    with pytest.raises(ValueError):
        silhouette.silhouettes(same.withColumn("k", F.lit(1)), ["a"], ["k"], "id_pelicula")


def test_the_film_search_reports_both_silhouettes(spark):
    from marquee.plans.registry import spark_queries
    rows = spark_queries()["k_metrics_both"](spark, SF001).collect()
    assert [r.k for r in rows] == list(range(2, 7)) and all(r.silhouette_error == 0 for r in rows)
    assert all(-1 <= r.silhouette_score <= r.silhouette_cuadrada <= 1 for r in rows)
