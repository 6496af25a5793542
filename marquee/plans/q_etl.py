"""Registered queries: cleaning, consolidation, integration, rule, curated projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators.consolidate import duplicate_resolution
from marquee.operators.dedup import first_per_key
from marquee.operators.final import constraint_violations
from marquee.operators.integrate import integrate, key_repeats, unmatched_counts
from marquee.operators.rules import alert_counts
from marquee.config import ALERTS
from marquee.operators.clean import clean_server, normalise_restrictions
from marquee.plans.oracle import _q, with_ctes
from marquee.plans.registry import query


@query("clean_ids", "P1", with_ctes(
    "select ord, id_pelicula_original, id_pelicula from stg_clean", "stg_clean"))
def clean_ids(ctx):
    return ctx.etl.staging_clean.select("ord", "id_pelicula_original", "id_pelicula")


@query("clean_plays", "P2", with_ctes(
    "select ord, reproducciones_original, reproducciones_mensuales from stg_clean", "stg_clean"))
def clean_plays(ctx):
    return ctx.etl.staging_clean.select("ord", "reproducciones_original", "reproducciones_mensuales")


@query("clean_dates", "P3", with_ctes(
    "select ord, fecha_estreno_original, fecha_estreno_plataforma from stg_clean", "stg_clean"))
def clean_dates(ctx):
    return ctx.etl.staging_clean.select("ord", "fecha_estreno_original", "fecha_estreno_plataforma")


@query("clean_titles", "P4", with_ctes(
    "select ord, titulo_original, titulo_limpio from stg_clean", "stg_clean"))
def clean_titles(ctx):
    return ctx.etl.staging_clean.select("ord", "titulo_original", "titulo_limpio")


@query("clean_servers", "P5", with_ctes(
    "select s.ord, r.servidor_origen as servidor_original, s.servidor_origen "
    "from stg_clean s join stg_raw r on r.ord = s.ord", "stg_clean"))
def clean_servers(ctx):
    # The cleaner replaces the column in place; both sides come from the same
    # projection, so no join is needed on the Spark side.
    raw = ctx.etl.staging_raw
    return raw.select("ord", F.col("servidor_origen").alias("servidor_original"),
                      clean_server().alias("servidor_origen"))


@query("clean_restrictions", "P6", with_ctes("select * from restr_clean", "restr_clean"))
def clean_restrictions(ctx):
    return ctx.etl.restrictions


@query("clean_api", "P7", with_ctes("select * from api_clean", "api_clean"))
def clean_api(ctx):
    return ctx.etl.api


@query("dedup_first", "D1", with_ctes("""
select id_pelicula, ord, clasificacion_raw, advertencia_contenido, bloqueo_raw
from (select *, row_number() over (partition by id_pelicula order by ord) as rn
      from restr_norm where id_pelicula is not null) where rn = 1""", "restr_norm"))
def dedup_first(ctx):
    return first_per_key(normalise_restrictions(ctx.etl.restrictions_raw), "id_pelicula")


@query("consolidate", "A1", with_ctes("select * from consolidated", "consolidated"))
def consolidate_q(ctx):
    return ctx.etl.consolidated


@query("dup_resolution", "A2", with_ctes("""
select count_if(cantidad_registros_origen > 1) as duplicados_resueltos,
       count(*) - count(distinct id_pelicula) as duplicados_restantes
from consolidated""", "consolidated"))
def dup_resolution(ctx):
    return duplicate_resolution(ctx.etl.consolidated)


@query("integrate", "J1 J2 P8 P9", with_ctes(
    "select * exclude (con_api, con_csv) from integrated", "integrated"))
def integrate_q(ctx):
    return ctx.etl.integrated


@query("one_to_one_violations", "J3", with_ctes("""
select 'izquierda' as lado, count_if(n > 1) as claves_repetidas
from (select id_pelicula, count(*) as n from consolidated group by id_pelicula)
union all
select 'api', count_if(n > 1) from (select id_pelicula, count(*) as n from api_clean group by id_pelicula)
union all
select 'csv', count_if(n > 1) from (select id_pelicula, count(*) as n from restr_clean group by id_pelicula)
""", "consolidated", "api_clean", "restr_clean"))
def one_to_one(ctx):
    e = ctx.etl
    return (key_repeats(e.consolidated, "izquierda")
            .unionByName(key_repeats(e.api, "api"))
            .unionByName(key_repeats(e.restrictions, "csv")))


@query("unmatched_counts", "J4", with_ctes("""
select count(*) as peliculas, count_if(not con_api) as peliculas_sin_api,
       count_if(not con_csv) as peliculas_sin_csv
from integrated""", "integrated"))
def unmatched(ctx):
    e = ctx.etl
    return unmatched_counts(integrate(e.consolidated, e.api, e.restrictions, with_markers=True))


@query("alert_rules", "P10", with_ctes("""
select id_pelicula, reproducciones_mensuales, popularidad_api, votos_promedio_api,
       bloqueo_horario_infantil, alerta_accion from ruled""", "ruled"))
def alert_rules(ctx):
    return ctx.etl.ruled.select("id_pelicula", "reproducciones_mensuales", "popularidad_api",
                                "votos_promedio_api", "bloqueo_horario_infantil", "alerta_accion")


@query("alert_counts", "A4", with_ctes("""
select alerta_accion, count(*) as peliculas from ruled group by alerta_accion
order by peliculas desc, alerta_accion nulls first""", "ruled"))
def alert_counts_q(ctx):
    return alert_counts(ctx.etl.ruled)


@query("final_dw", "P11 P12", with_ctes("select * from curated", "curated"))
def final_dw(ctx):
    return ctx.etl.final


@query("constraint_violations", "W2", with_ctes("""
select count_if(id_pelicula is null or id_pelicula < -2147483648 or id_pelicula > 2147483647) as id_invalido,
  count(id_pelicula) - count(distinct id_pelicula) as id_duplicado,
  count_if(titulo is null) as titulo_nulo,
  count_if(length(titulo) > 255) as titulo_largo,
  count_if(length(clasificacion_edad_local) > 20) as clasificacion_larga,
  count_if(alerta_accion is null or alerta_accion not in (""" + _q(ALERTS) + """)) as alerta_invalida,
  count_if(length(alerta_accion) > 255) as alerta_larga,
  count_if(reproducciones_mensuales < -2147483648 or reproducciones_mensuales > 2147483647)
    as reproducciones_fuera_de_rango
from ruled""", "ruled"))
def constraints(ctx):
    return constraint_violations(ctx.etl.ruled)
