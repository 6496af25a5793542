"""Registered queries: source scans, landed API responses, id candidates, curated scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.plans.oracle import _strip, cte, with_ctes
from marquee.plans.registry import query
from marquee.operators.clean import clean_restrictions
from marquee.sinks.versions import current_version
from marquee.sinks.staging import replace_staging
from marquee.sinks.files import write_csv, write_jsonl, write_text
from marquee.sources.api import (api_id_candidates, parse_detail, read_api_pages,
                                 read_api_responses, valid_ids_numeric)
from marquee.sources.curated import model_columns
from marquee.sources.restrictions import read_restrictions_csv
from marquee.sources.staging import read_staging, select_staging, staging_count

cte("stg_ids", f"select {_strip('id_pelicula')} as id from stg_raw", "stg_raw")


@query("stg_extract", "S1", with_ctes("select * from stg_raw", "stg_raw"))
def stg_extract(ctx):
    return select_staging(ctx.fixtures.staging)


@query("stg_count", "S2", with_ctes("select count(*) as total_registros from stg_raw", "stg_raw"))
def stg_count(ctx):
    return staging_count(select_staging(ctx.fixtures.staging))


@query("restr_extract", "S3 W5", with_ctes("select * from restr_raw", "restr_raw"))
def restr_extract(ctx):
    # Land the restrictions as a headed CSV, then scan it back with the reader.
    path = write_csv(ctx.fixtures.restrictions, ctx.landing("landing", "restricciones_csv"))
    return read_restrictions_csv(ctx.spark, path, with_ord=True)


@query("restr_extract_plain", "S3 W5", with_ctes(
    "select id_pelicula, clasificacion_chile, advertencia_contenido, bloqueo_horario_infantil from restr_plain",
    "restr_plain"))
def restr_extract_plain(ctx):
    # The file as it really is: four columns, quotes and commas in cells, order by place in the file.
    return _plain_restrictions(ctx).drop("ord")


def _plain_restrictions(ctx):
    rows = ctx.fixtures.plain_restrictions.orderBy("ord").drop("ord")
    return read_restrictions_csv(ctx.spark, write_csv(rows, ctx.landing("landing", "restricciones_simple")))


@query("restr_extract_breaks", "S3 W5", with_ctes("""
select id_pelicula, clasificacion_chile, advertencia_contenido, bloqueo_horario_infantil from restr_broken""",
    "restr_broken"))
def restr_extract_breaks(ctx):
    # Line breaks, quotes and commas inside quoted cells.
    rows = ctx.fixtures.broken_restrictions.orderBy("ord").drop("ord")
    return read_restrictions_csv(ctx.spark, write_csv(rows, ctx.landing("landing", "restricciones_saltos"))).drop("ord")


@query("clean_restrictions_plain", "S3 P6 D1", with_ctes(f"""
select id_pelicula, clasificacion_chile, advertencia_contenido, bloqueo_horario_infantil
from (select c.id_pelicula, c.clasificacion_chile, nullif({_strip('p.advertencia_contenido')}, '') as advertencia_contenido,
             c.bloqueo_horario_infantil, row_number() over (partition by c.id_pelicula order by c.ord) as rn
      from restr_valid c join restr_plain p on p.ord = c.ord)
where rn = 1""", "restr_valid", "restr_plain"))
def clean_restrictions_plain(ctx):
    return clean_restrictions(_plain_restrictions(ctx))


@query("staging_replace", "W4", with_ctes("select * from stg_raw", "stg_raw"))
def staging_replace(ctx):
    base = ctx.landing("landing", "stg_catalogo_interno")
    replace_staging(ctx.fixtures.staging, base)
    return read_staging(ctx.spark, current_version(ctx.spark, base))


@query("api_extract", "S4", with_ctes("select * from api_raw", "api_raw"))
def api_extract(ctx):
    # Land one JSON line per API response, then scan and parse the landing zone.
    path = write_jsonl(ctx.fixtures.api_responses, ctx.landing("landing", "api_detalle"))
    return parse_detail(read_api_responses(ctx.spark, path))


@query("api_parse_detail", "S5", with_ctes("select * from api_raw", "api_raw"))
def api_parse(ctx):
    return parse_detail(ctx.fixtures.api_responses)


@query("api_flatten_pages", "S6", with_ctes(
    "select cast(floor(p_partkey / 20) + 1 as integer) as page, p_partkey as id, p_name as titulo "
    "from part"))
def api_flatten_pages(ctx):
    path = write_text(ctx.fixtures.api_pages, ctx.landing("landing", "api_paginas"))
    return read_api_pages(ctx.spark, path)


@query("api_id_candidates", "S7", with_ctes(
    "select distinct id from stg_ids where regexp_matches(id, '^[0-9]+$') order by id", "stg_ids"))
def api_candidates(ctx):
    return api_id_candidates(ctx.fixtures.staging)


@query("valid_ids_numeric", "S8", with_ctes(
    "select distinct cast(id as bigint) as id_pelicula from stg_ids "
    "where regexp_matches(id, '^[0-9]+$') order by id_pelicula", "stg_ids"))
def valid_ids(ctx):
    return valid_ids_numeric(ctx.fixtures.staging)


@query("dw_scan", "S9", with_ctes("select * from curated", "curated"))
def dw_scan(ctx):
    return ctx.stored_curated


@query("dw_model_columns", "S10", with_ctes(
    "select id_pelicula, titulo, reproducciones_mensuales, popularidad_api, votos_promedio_api, "
    "clasificacion_edad_local, alerta_accion, fecha_actualizacion from curated", "curated"))
def dw_model_columns(ctx):
    return model_columns(ctx.stored_curated)


@query("api_stream_ingest", "S4 S5 (streaming)", with_ctes("""
select * exclude (rn) from (select *, row_number() over (partition by id_pelicula_api order by ord) as rn from api_raw)
where rn = 1""", "api_raw"))
def api_stream_ingest(ctx):
    # Land the responses, ingest them incrementally (available-now trigger), read the table.
    from marquee.streaming import current_api_records, ingest_api_responses
    run = ctx.landing("streams", "api_ingest_run")
    landing = write_jsonl(ctx.fixtures.api_responses, f"{run}/landing")
    ingest_api_responses(ctx.spark, landing, f"{run}/table", f"{run}/checkpoint").awaitTermination()
    return current_api_records(ctx.spark, f"{run}/table")


def _landed_stream(ctx):
    """Current records of the landed responses, in two batches: later sequences land first, earlier ones late, after a restart."""
    from marquee.streaming import keep_current
    run = ctx.landing("streams", "api_current")
    responses = ctx.fixtures.api_responses
    late = F.col("seq") < 0
    for n, part in enumerate((responses.where(~late), responses.where(late))):
        write_jsonl(part, f"{run}/landing", mode="append" if n else "overwrite")
        keep_current(ctx.spark, f"{run}/landing", f"{run}/current", f"{run}/checkpoint", compact_every=2).awaitTermination()
    return f"{run}/current"


@query("api_stream_current", "S4 S5 (streaming)", with_ctes("""
select * exclude (rn) from (select *, row_number() over (partition by id_pelicula_api order by ord) as rn from api_raw)
where rn = 1""", "api_raw"))
def api_stream_current(ctx):
    from marquee.streaming import read_current_records
    return read_current_records(ctx.spark, _landed_stream(ctx))


@query("api_id_candidates_landed", "S7", with_ctes(
    "select distinct id from stg_ids where regexp_matches(id, '^[0-9]+$') "
    "and id not in (select cast(id_pelicula_api as varchar) from api_raw) order by id", "stg_ids", "api_raw"))
def api_candidates_landed(ctx):
    # Ids of the staging rows that have no record yet, by the id column of the current table.
    from marquee.streaming import fetched_ids
    return api_id_candidates(ctx.fixtures.staging, fetched_ids(ctx.spark, _landed_stream(ctx)))
