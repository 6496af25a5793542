"""Source readers (CSV, landed API JSON, pages) and the curated sink."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from marquee.operators.clean import clean_restrictions
from marquee.sinks.curated import LoadValidationError, load_curated, read_current, validate_before_load, write_curated
from marquee.sinks.versions import current_version
from marquee.sinks.files import write_csv
from marquee.sources.api import (api_id_candidates, flatten_pages, parse_detail,
                                 read_api_responses, valid_ids_numeric)
from marquee.sources.restrictions import read_restrictions_csv


def test_restrictions_csv_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "restr.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("id_pelicula,clasificacion_chile,advertencia_contenido,bloqueo_horario_infantil\n")
        f.write("11,TE,Ninguna,NO\n")
        f.write("12,14,Violencia explícita,SI\n")
        f.write("13,NA,,null\n")
    rows = read_restrictions_csv(spark, path).collect()
    assert [r.id_pelicula for r in rows] == ["11", "12", "13"]
    assert rows[1].advertencia_contenido == "Violencia explícita"
    assert rows[2].clasificacion_chile is None and rows[2].bloqueo_horario_infantil is None
    assert dict(read_restrictions_csv(spark, path).dtypes)["clasificacion_chile"] == "string"


HEADER = "id_pelicula,clasificacion_chile,advertencia_contenido,bloqueo_horario_infantil\n"


def test_plain_restrictions_keep_file_order_and_quotes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "plain")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w", encoding="utf-8") as f:
        f.write(HEADER + '5,TE+7,first,NO\n6,18,"dice ""x"", y",SI\n5,14,second,SI\n')
        f.write("".join(f"{k},14,filler {k},NO\n" for k in range(1000, 9000)))
        f.write("6,14,late,NO\n")
    with open(os.path.join(path, "b.csv"), "w", encoding="utf-8") as f:
        f.write(HEADER + "5,18,other file,SI\n7,TE,only here,NO\n")
    for size in ("128m", "20k"):  # one split a file, and many
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = {r.id_pelicula: r for r in clean_restrictions(read_restrictions_csv(spark, path)).where("id_pelicula < 10").collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert (rows[5].clasificacion_chile, rows[5].bloqueo_horario_infantil) == ("TE+7", "NO")
        assert (rows[6].advertencia_contenido, rows[6].bloqueo_horario_infantil) == ('dice "x", y', "SI")
        assert rows[7].advertencia_contenido == "only here"


def test_csv_multi_line_cells_and_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("1", "TE", 'a "quoted", cell', "NO"), ("2", "14", "two\nlines", "SI")],
                               "id_pelicula string, clasificacion_chile string, advertencia_contenido string, bloqueo_horario_infantil string")
    path = write_csv(df, os.path.join(tmp_dir, "ml"))
    rows = {r.id_pelicula: r.advertencia_contenido for r in read_restrictions_csv(spark, path).collect()}
    assert rows == {"1": 'a "quoted", cell', "2": "two\nlines"}


def test_jdbc_hash_predicates_are_exhaustive():
    from marquee.sources.staging import hash_predicates

    assert len(set(hash_predicates(8))) == 8 and all(p.endswith(f"= {i}") for i, p in enumerate(hash_predicates(8)))


def test_restrictions_csv_missing_path(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        read_restrictions_csv(spark, os.path.join(tmp_dir, "nope.csv")).collect()


def test_csv_sink_keeps_blanks(spark, tmp_dir):
    df = spark.createDataFrame([(1, " te+7 ")], "ord bigint, clasificacion_chile string")
    path = write_csv(df, os.path.join(tmp_dir, "out_csv"))
    back = spark.read.option("header", True).csv(path).collect()
    assert back[0].clasificacion_chile == " te+7 "


def test_parse_detail_statuses(spark, tmp_dir):
    lines = [
        '{"id": "1", "status": 200, "body": "{\\"title\\": \\"A\\", \\"popularity\\": 81.5, \\"vote_average\\": 7.1}"}',
        '{"id": "2", "status": 404, "body": "{\\"status_code\\": 34}"}',
        '{"id": "3", "error": "timeout"}',
        '{"id": "4", "status": 200, "body": "<html>oops"}',
        '{"id": "5", "status": 200, "body": "{\\"title\\": \\"E\\", \\"popularity\\": \\"NaN\\"}"}',
    ]
    path = os.path.join(tmp_dir, "landing.jsonl")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    got = {r.id_pelicula_api: r for r in parse_detail(read_api_responses(spark, path)).collect()}
    assert set(got) == {1, 2, 5}  # transport failure and undecodable body give no row
    assert (got[1].titulo_api, got[1].popularidad_api, got[1].votos_promedio_api) == ("A", 81.5, 7.1)
    assert got[2].titulo_api is None and got[2].popularidad_api is None
    assert got[5].titulo_api == "E" and got[5].popularidad_api is None


def test_flatten_pages(spark):
    pages = spark.createDataFrame(
        [('{"page": 1, "results": [{"id": 10, "title": "A"}, {"id": 11, "title": "B"}]}',),
         ('{"page": 2, "results": []}',)], "value string")
    got = sorted((r.page, r.id, r.titulo) for r in flatten_pages(pages).collect())
    assert got == [(1, 10, "A"), (1, 11, "B")]


def test_id_candidates(spark):
    stg = spark.createDataFrame([(" 10 ",), ("9",), ("10",), ("ID-ERR",), ("",), (None,), ("100",)],
                                "id_pelicula string")
    assert [r.id for r in api_id_candidates(stg).collect()] == ["10", "100", "9"]  # text order
    landed = spark.createDataFrame([("9",)], "id string")
    assert [r.id for r in api_id_candidates(stg, landed).collect()] == ["10", "100"]
    assert [r.id_pelicula for r in valid_ids_numeric(stg).collect()] == [9, 10, 100]


def _curated(spark, ids):
    import datetime as dt
    return spark.createDataFrame(
        [(i, f"T{i}", 1, dt.date(2024, 1, 1), 1.0, 1.0, "TE", "Monitorear sin acción inmediata",
          dt.datetime(2026, 1, 1)) for i in ids],
        "id_pelicula int, titulo string, reproducciones_mensuales int, fecha_estreno date, "
        "popularidad_api float, votos_promedio_api float, clasificacion_edad_local string, "
        "alerta_accion string, fecha_actualizacion timestamp_ntz")


def test_versioned_load_and_switch(spark, tmp_dir):
    base = os.path.join(tmp_dir, "dw")
    v1 = write_curated(_curated(spark, [1, 2, 3]), base, expected_rows=3)
    assert current_version(spark, base) == v1
    v2 = write_curated(_curated(spark, [1, 2]), base)
    assert v2 != v1 and read_current(spark, base).count() == 2
    assert spark.read.parquet(v1).count() == 3  # previous version stays readable
    for n in range(3):
        write_curated(_curated(spark, [n]), base)
    assert not os.path.exists(v1) and read_current(spark, base).first().id_pelicula == 2  # old ones are pruned


def _ruled(spark, rows):
    import datetime as dt
    return spark.createDataFrame(
        [(i, t, p, dt.date(2024, 1, 1), 1.0, 1.0, "TE", "Monitorear sin acción inmediata") for i, t, p in rows],
        "id_pelicula bigint, titulo string, reproducciones_mensuales bigint, fecha_estreno date, "
        "popularidad_api double, votos_promedio_api double, clasificacion_edad_local string, alerta_accion string")


@pytest.mark.parametrize("bad", [(5, None, 1), (5, "T", 2 ** 40), (2 ** 40, "T", 1), (1, "again", 1), (5, "x" * 300, 1)])
def test_violating_load_leaves_the_current_version(spark, tmp_dir, bad):
    base = os.path.join(tmp_dir, "dw_validated")
    good = load_curated(_ruled(spark, [(1, "A", 1), (2, "B", None)]), base)
    with pytest.raises(LoadValidationError):
        load_curated(_ruled(spark, [(1, "A", 1), bad]), base)
    assert current_version(spark, base) == good and read_current(spark, base).count() == 2
    assert not [n for n in os.listdir(base) if n.startswith("_candidate")]


def test_staging_replace(spark, tmp_dir):
    from marquee.sinks.staging import replace_staging
    from marquee.sources.staging import read_staging

    cols = "ord long, id_pelicula string, titulo_original string, reproducciones_mensuales string, " \
           "fecha_estreno_plataforma string, servidor_origen string, extra int"
    base = os.path.join(tmp_dir, "stg")
    for n in (3, 5):
        replace_staging(spark.createDataFrame([(k, str(k), None, "1", "", "x", 0) for k in range(n)], cols), base)
        assert read_staging(spark, current_version(spark, base)).count() == n


def test_serving_sees_rewritten_inputs(spark, tmp_dir):
    import shutil

    from marquee.plans.registry import spark_queries
    from tests.conftest import SF001

    folder = os.path.join(tmp_dir, "data")
    shutil.copytree(SF001, folder)
    q = spark_queries()
    before = q["dw_list"](spark, folder).count()
    import pyarrow.parquet as pq
    cut = pq.read_table(f"{SF001}/orders.parquet", filters=[("o_custkey", "<=", 50)])
    os.chmod(folder, 0o755)  # the given tables are read-only, and copies keep that
    os.replace(shutil.copy(f"{SF001}/orders.parquet", f"{tmp_dir}/old"), f"{folder}/orders.parquet")
    os.chmod(f"{folder}/orders.parquet", 0o644)
    pq.write_table(cut, f"{folder}/orders.parquet")
    after = q["dw_list"](spark, folder).count()
    assert after < before and after == q["final_dw"](spark, folder).count()


def test_landing_runs_do_not_disturb_each_other(spark):
    from marquee.plans.registry import spark_queries
    from tests.conftest import SF001

    q = spark_queries()
    for name in ("restr_extract", "restr_extract_plain", "api_extract", "api_flatten_pages", "staging_replace"):
        first, second = q[name](spark, SF001), q[name](spark, SF001)
        assert first.count() == second.count() > 0


def test_load_rejects_repeated_ids(spark, tmp_dir):
    base = os.path.join(tmp_dir, "dw_bad")
    with pytest.raises(LoadValidationError):
        write_curated(_curated(spark, [1, 1]), base)


def test_constraint_validation(spark):
    good = _curated(spark, [1, 2])
    assert sum(validate_before_load(good).values()) == 0
    bad = good.withColumn("titulo", F.lit(None).cast("string"))
    with pytest.raises(LoadValidationError):
        validate_before_load(bad)


def test_run_etl_dry_run_and_load(spark, tmp_dir):
    from marquee.functions.guards import shape
    from marquee.plans.etl import StageCounter, run_etl
    from marquee.sources import Fixtures, Tables
    from tests.conftest import SF001

    fx = Fixtures(Tables(spark, SF001))
    final = run_etl(fx.staging, fx.restrictions, fx.api, load=False)
    assert shape(final) == (150, 9)
    counter = StageCounter()
    version = run_etl(fx.staging, fx.restrictions, fx.api, target=os.path.join(tmp_dir, "dw"),
                      counter=counter)
    assert spark.read.parquet(version).count() == 150
    counts = dict(counter.counts())
    # Observed during the run; equal to counting each stage where no task runs twice.
    assert counts["staging"] == counts["staging_limpio"] == fx.staging.count()
    assert counts["restricciones"] == fx.restrictions.count()
    assert counts["consolidado"] == counts["integrado"] == counts["final"] == 150
