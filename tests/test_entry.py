"""Driver contract: entry(), queries()/oracle_sql() and the DuckDB comparison."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from marquee.plans.registry import spark_queries
from tests.conftest import SF001
from tests.oracle_check import compare, duck

# Raw model outputs: their values depend on seeds; rf_checks, kmeans_checks, model_outputs
# and the eval_*_rule queries hold what must be true of them against SQL.
MODEL_FITS = {"rf_predictions", "eval_accuracy", "eval_confusion", "eval_report", "k_metrics",
              "k_metrics_both", "kmeans_clusters"}
CORE = spark_queries()


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["alerta_accion", "peliculas"]
    assert len(rows) == 7 and sum(r.peliculas for r in rows) == 150


def test_every_oracle_has_a_query():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert set(CORE) - set(o) == MODEL_FITS


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(CORE)))
def test_query_matches_oracle(spark, con, name):
    res = compare(queries()[name](spark, SF001), oracle_sql()[name], con)
    assert res["match"], res


@pytest.mark.parametrize("name,columns", [
    ("rf_predictions", {"id_pelicula", "y_real", "y_pred"}), ("eval_accuracy", {"n", "accuracy"}),
    ("eval_confusion", {"y_real", "y_pred", "n"}), ("k_metrics", {"k", "silhouette_score", "inercia"}),
    ("eval_report", {"clase", "precision", "recall", "f1", "support"})])
def test_model_outputs_have_rows(spark, name, columns):
    df = queries()[name](spark, SF001)
    assert set(df.columns) == columns and df.count() > 0


def test_every_film_is_clustered(spark):
    df = queries()["kmeans_clusters"](spark, SF001)
    assert df.count() == df.select("id_pelicula").distinct().count() == queries()["final_dw"](spark, SF001).count()
    assert df.where("cluster is null or segmento_cluster is null").count() == 0


def test_json_timestamps_have_no_fraction(spark):
    assert queries()["dw_json"](spark, SF001).where("json not like '%\"fecha_actualizacion\":\"2026-01-01T00:00:00\"}'").count() == 0
