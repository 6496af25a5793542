"""Films without a title in any source: served and modelled as SQL states them, refused by a strict load."""

import datetime as dt
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from marquee.plans.context import QueryContext
from marquee.plans.registry import oracle_queries, spark_queries
from marquee.sinks.curated import LoadValidationError, load_curated
from tests.oracle_check import compare

# No API record, a record without a title, and an earlier 404; all their staging titles are blank.
UNTITLED = (24, 26, 75)
FILMS = 160
QUERIES = ("best_k", "class_options", "class_weights", "cluster_distribution", "cluster_features", "cluster_summary",
           "dashboard_base", "dw_by_class", "dw_by_id", "dw_json", "dw_list", "dw_list_total", "dw_model_columns", "dw_page",
           "dw_scan", "eval_accuracy_rule", "eval_confusion_rule", "eval_report_rule", "model_outputs", "rf_checks")
ROWS = {"rf_predictions": None, "eval_accuracy": 1, "eval_confusion": None, "k_metrics": 5}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("untitled")
    blank = [19 * k for k in range(2000, 2000 + 2 * len(UNTITLED)) if k % 97]  # order keys whose title is blank
    orders = [(k, UNTITLED[i % len(UNTITLED)]) for i, k in enumerate(blank)]
    orders += [(f * 8 + n, f) for f in range(1, FILMS + 1) if f not in UNTITLED for n in range(6)]
    day = dt.datetime(2001, 1, 1)
    tables = {
        "orders": {"o_orderkey": [k for k, _ in orders], "o_custkey": [f for _, f in orders],
                   "o_orderdate": [day + dt.timedelta(days=k % 999) for k, _ in orders]},
        "part": {"p_partkey": list(range(200)), "p_name": [f"blue film {k}" for k in range(200)]},
        "customer": {"c_custkey": list(range(FILMS)), "c_nationkey": [k * 7 % 25 for k in range(FILMS)]},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{at}/{name}.parquet")
    return str(at)


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for t in ("orders", "part", "customer"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_keeps_untitled_films(spark, folder, con, name):
    res = compare(spark_queries()[name](spark, folder), oracle_queries()[name], con)
    assert res["match"], res


def test_untitled_films_are_served(spark, folder):
    rows = spark_queries()["dw_list"](spark, folder).collect()
    assert len(rows) == FILMS and tuple(r.id_pelicula for r in rows if r.titulo is None) == UNTITLED


@pytest.mark.parametrize("name", ROWS)
def test_models_are_fitted(spark, folder, name):
    n = spark_queries()[name](spark, folder).count()
    assert n == ROWS[name] if ROWS[name] else n > 0


def test_a_strict_load_refuses_them(spark, folder, tmp_dir):
    etl = QueryContext(spark, folder).etl
    with pytest.raises(LoadValidationError):
        load_curated(etl.ruled, os.path.join(tmp_dir, "dw"), etl.run_ts)


def test_load_roundtrip_loads_untitled_films(spark, folder, con):
    res = compare(spark_queries()["load_roundtrip"](spark, folder), oracle_queries()["load_roundtrip"], con)
    assert res["match"], res


@pytest.mark.parametrize("bad", [(5, None, 2 ** 40), (2 ** 40, None, 1), (1, None, 1)])
def test_other_violations_are_not_tolerated(spark, tmp_dir, bad):
    from tests.test_sources_sinks import _ruled
    with pytest.raises(LoadValidationError):
        load_curated(_ruled(spark, [(1, "A", 1), bad]), os.path.join(tmp_dir, "dw"), tolerate=("titulo_nulo",))
