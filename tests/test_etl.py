"""Consolidation, de-duplication, integration and the alert rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee import config as C
from marquee.functions.guards import MissingColumnsError, require_columns
from marquee.operators.clean import clean_api, clean_restrictions, clean_staging
from marquee.operators.consolidate import consolidate
from marquee.operators.dedup import duplicated_rows, first_per_key
from marquee.operators.integrate import assert_one_to_one, integrate, unmatched_counts
from marquee.operators.rules import alert_counts, apply_rules
from marquee.plans.etl import build_etl

STG = "ord bigint, id_pelicula string, titulo_original string, reproducciones_mensuales string, " \
      "fecha_estreno_plataforma string, servidor_origen string"

STAGING_ROWS = [
    (1, "11", None, "5000 views", "2025-05-12", "Nodo_Andes_Uno"),
    (2, "  11  ", "THE MATRIX", "N/A", "01/01/2024", "Null_Server"),
    (3, "11", "the matrix", "7000", "SIN FECHA", " Nodo_Valle_Tres "),
    (4, "ID-ERR", "Lost", "10", "2020-01-01", "Nodo_Costa_Dos"),
    (5, "12", "  ", None, "00/00/0000", "Null_Server"),
    (6, "13", "Only One", "2500", "3/2/2023", "Nodo_Andes_Uno"),
]


@pytest.fixture()
def staging(spark):
    return spark.createDataFrame(STAGING_ROWS, STG)


def test_consolidate(spark, staging):
    rows = {r["id_pelicula"]: r for r in consolidate(clean_staging(staging)).collect()}
    assert set(rows) == {11, 12, 13}  # the invalid id forms no group
    r = rows[11]
    assert r["titulo_interno"] == "The Matrix"  # first non-null title by arrival order
    assert r["reproducciones_mensuales"] == 7000
    assert r["fecha_estreno"] == dt.date(2024, 1, 1)
    assert r["cantidad_registros_origen"] == 3
    assert r["servidores_origen"] == "Nodo_Andes_Uno, Nodo_Valle_Tres"
    assert rows[12]["titulo_interno"] is None and rows[12]["servidores_origen"] is None
    assert rows[12]["cantidad_registros_origen"] == 1


def test_consolidate_is_order_independent(spark, staging):
    """Shuffling the input rows must not change any 'first' choice."""
    base = sorted(consolidate(clean_staging(staging)).collect())
    shuffled = staging.orderBy(F.rand(7)).repartition(3)
    assert sorted(consolidate(clean_staging(shuffled)).collect()) == base


def test_first_per_key_follows_the_order_not_the_values(spark):
    df = spark.createDataFrame([(2, 1, "a"), (1, 1, "b"), (5, 2, None), (6, 2, "c"), (1, None, "z")],
                               "ord bigint, k bigint, v string")
    got = sorted((r.k, r.v) for r in first_per_key(df, "k").collect())
    assert got == [(1, "b"), (2, None)]


def test_duplicated_rows_include_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, None), (4, None), (5, 2)], "ord int, k int")
    assert sorted(r.ord for r in duplicated_rows(df, "k").collect()) == [1, 2, 3, 4]


def test_restrictions_clean(spark):
    df = spark.createDataFrame([
        (1, "10", " te+7 ", " Ninguna ", "no"),
        (2, " 10", "18", "dup", "SI"),
        (3, "11", "X", "Terror", "?"),
        (4, "abc", "14", "x", "SI"),
    ], "ord bigint, id_pelicula string, clasificacion_chile string, advertencia_contenido string, "
       "bloqueo_horario_infantil string")
    rows = {r.id_pelicula: r for r in clean_restrictions(df).collect()}
    assert set(rows) == {10, 11}
    assert (rows[10].clasificacion_chile, rows[10].bloqueo_horario_infantil) == ("TE+7", "NO")
    assert rows[10].advertencia_contenido == "Ninguna"
    assert rows[11].clasificacion_chile is None and rows[11].bloqueo_horario_infantil is None


def test_api_clean(spark):
    df = spark.createDataFrame([(5, "  A   B ", float("nan"), 4.0), (None, "x", 1.0, 1.0)],
                               "id_pelicula_api bigint, titulo_api string, popularidad_api double, "
                               "votos_promedio_api double")
    rows = clean_api(df).collect()
    assert len(rows) == 1 and rows[0].titulo_api == "A B" and rows[0].popularidad_api is None


def test_api_clean_keeps_the_response_landed_first(spark):
    df = spark.createDataFrame([(2, 9, None, None, None), (1, 9, "first", 5.0, 6.0), (3, 9, "third", 1.0, 1.0),
                                (7, 8, "late", 1.0, 1.0), (4, 8, None, None, None)],
                               "ord bigint, id_pelicula_api bigint, titulo_api string, popularidad_api double, votos_promedio_api double")
    got = {r.id_pelicula: r.titulo_api for r in clean_api(df).collect()}
    assert got == {9: "first", 8: None}


def _rule_frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, reproducciones_mensuales bigint, "
                                       "popularidad_api double, votos_promedio_api double, "
                                       "bloqueo_horario_infantil string")


def test_alert_rule_branches(spark):
    rows = [
        (1, None, 90.0, 9.0, "SI"),
        (2, 1000, 90.0, 9.0, "SI"),
        (3, 9000, 10.0, 9.0, "SI"),
        (4, 1000, 90.0, 9.0, "NO"),
        (5, 8000, 90.0, 9.0, None),
        (6, 5000, 10.0, 4.9, "NO"),
        (7, 5000, 10.0, 5.0, "NO"),
        (8, 1000, None, None, None),   # no API data, no restrictions row
        (9, 7000, 80.0, None, None),   # thresholds are inclusive
    ]
    got = {r.id: r.alerta_accion for r in apply_rules(_rule_frame(spark, rows)).collect()}
    assert got == {1: C.ALERT_CHECK_PLAYS, 2: C.ALERT_NIGHT_BANNER_AND_BLOCK, 3: C.ALERT_BLOCK_KIDS,
                   4: C.ALERT_BOOST, 5: C.ALERT_KEEP_FEATURED, 6: C.ALERT_CHECK_QUALITY,
                   7: C.ALERT_MONITOR, 8: C.ALERT_MONITOR, 9: C.ALERT_KEEP_FEATURED}


def test_alert_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "alerta_accion string")
    assert [tuple(r) for r in alert_counts(df).collect()] == [("b", 2), (None, 1), ("a", 1)]


def test_integrate_and_unmatched(spark, staging):
    api = clean_api(spark.createDataFrame([(11, "Api Title", 90.0, 8.0), (12, "Api 12", 1.0, 1.0)],
                                          "id_pelicula_api bigint, titulo_api string, "
                                          "popularidad_api double, votos_promedio_api double"))
    restr = clean_restrictions(spark.createDataFrame(
        [(1, "11", "18", "x", "SI")], "ord bigint, id_pelicula string, clasificacion_chile string, "
                                      "advertencia_contenido string, bloqueo_horario_infantil string"))
    cons = consolidate(clean_staging(staging))
    assert_one_to_one(cons, api)
    out = {r.id_pelicula: r for r in integrate(cons, api, restr).collect()}
    assert out[11].titulo == "The Matrix" and out[11].clasificacion_edad_local == "18"
    assert out[12].titulo == "Api 12"  # falls back to the API title
    u = unmatched_counts(integrate(cons, api, restr, with_markers=True)).collect()[0]
    assert (u.peliculas, u.peliculas_sin_api, u.peliculas_sin_csv) == (3, 1, 2)


def test_require_columns(spark, staging):
    require_columns(staging, ["id_pelicula"])
    with pytest.raises(MissingColumnsError):
        require_columns(staging, ["nope"])


def test_build_etl_final_schema(spark, staging):
    api = spark.createDataFrame([(11, "A", 90.0, 8.0)], "id_pelicula_api bigint, titulo_api string, "
                                "popularidad_api double, votos_promedio_api double")
    restr = spark.createDataFrame([(1, "11", "18", "x", "SI")],
                                  "ord bigint, id_pelicula string, clasificacion_chile string, "
                                  "advertencia_contenido string, bloqueo_horario_infantil string")
    e = build_etl(staging, restr, api, run_ts=dt.datetime(2026, 1, 1, 12, 0, 0, 987000))
    assert dict(e.final.dtypes) == {
        "id_pelicula": "int", "titulo": "string", "reproducciones_mensuales": "int",
        "fecha_estreno": "date", "popularidad_api": "float", "votos_promedio_api": "float",
        "clasificacion_edad_local": "string", "alerta_accion": "string",
        "fecha_actualizacion": "timestamp_ntz"}
    ts = {r.fecha_actualizacion for r in e.final.collect()}
    assert ts == {dt.datetime(2026, 1, 1, 12, 0, 0)}  # floored to the second
