"""Registered queries: data-quality profiles and duplicate listings."""

from __future__ import annotations

from marquee.config import VALID_BLOCK_FLAGS, VALID_CLASSES
from marquee.operators.clean import normalise_restrictions
from marquee.operators.dedup import duplicated_rows, first_per_key
from marquee.operators.profile import (after_clean_nulls, date_rows, dirty_plays, domain_profile,
                                       duplicate_row_count, id_profile, null_counts,
                                       row_and_key_counts, value_profile)
from marquee.operators.clean import clean_ids
from marquee.operators.classifier import model_frame
from marquee.functions.numeric import to_int_id
from marquee.sources.curated import CURATED_COLUMNS, model_columns
from marquee.plans.oracle import _q, _strip, with_ctes
from marquee.plans.registry import query
from marquee.sources.fixtures import API_COLUMNS, RESTRICTION_COLUMNS, STAGING_COLUMNS

_STG_ALL = ("ord",) + STAGING_COLUMNS


@query("profile_nulls", "A8", with_ctes(" union all ".join(
    f"select '{c}' as columna, count_if({c} is null) as nulos from stg_raw" for c in _STG_ALL),
    "stg_raw"))
def profile_nulls(ctx):
    return null_counts(ctx.etl.staging_raw, _STG_ALL)


@query("profile_dup_rows", "A9", with_ctes(f"""
select 'staging' as fuente, coalesce(sum(n - 1), 0) as filas_duplicadas
from (select count(*) as n from stg_raw group by {", ".join(STAGING_COLUMNS)})
union all
select 'restricciones', coalesce(sum(n - 1), 0)
from (select count(*) as n from restr_raw group by {", ".join(RESTRICTION_COLUMNS)})
union all
select 'api', coalesce(sum(n - 1), 0)
from (select count(*) as n from api_raw group by {", ".join(API_COLUMNS)})""",
    "stg_raw", "restr_raw", "api_raw"))
def profile_dup_rows(ctx):
    from pyspark.sql import functions as F
    e = ctx.etl
    parts = [("staging", e.staging_raw, STAGING_COLUMNS),
             ("restricciones", e.restrictions_raw, RESTRICTION_COLUMNS),
             ("api", e.api_raw, API_COLUMNS)]
    out = None
    for name, df, cols in parts:
        r = duplicate_row_count(df, cols).select(F.lit(name).alias("fuente"), "filas_duplicadas")
        out = r if out is None else out.unionByName(r)
    return out


@query("profile_ids", "A10", with_ctes("""
select coalesce(sum(case when id_pelicula is null then n end), 0) as ids_invalidos,
  count(id_pelicula) as ids_unicos,
  coalesce(sum(n - 1), 0) as duplicados_adicionales,
  coalesce(sum(case when n > 1 then n end), 0) as filas_duplicadas
from (select id_pelicula, count(*) as n from stg_clean group by id_pelicula)""", "stg_clean"))
def profile_ids(ctx):
    return id_profile(ctx.etl.staging_clean)


_ID_PROFILE = """select '{0}' as fuente, coalesce(sum(case when id is null then n end), 0) as ids_invalidos,
  count(id) as ids_unicos, coalesce(sum(n - 1), 0) as duplicados_adicionales,
  coalesce(sum(case when n > 1 then n end), 0) as filas_duplicadas
from (select {1} as id, count(*) as n from {2} group by 1)"""


@query("profile_ids_sources", "A10", with_ctes(" union all ".join(
    _ID_PROFILE.format(*x) for x in (("staging", "id_pelicula", "stg_clean"), ("restricciones", "id_pelicula", "restr_norm"),
                                     ("api", "id_pelicula", "api_typed"))), "stg_clean", "restr_norm", "api_typed"))
def profile_ids_sources(ctx):
    from pyspark.sql import functions as F
    e, out = ctx.etl, None
    frames = (("staging", clean_ids(e.staging_raw)), ("restricciones", normalise_restrictions(e.restrictions_raw)),
              ("api", e.api_raw.select(to_int_id(F.col("id_pelicula_api").cast("string")).alias("id_pelicula"))))
    for name, df in frames:
        row = id_profile(df).select(F.lit(name).alias("fuente"), "*")
        out = row if out is None else out.unionByName(row)
    return out


_MODEL_COLUMNS = ("id_pelicula", "titulo", "reproducciones_mensuales", "popularidad_api", "votos_promedio_api",
                  "clasificacion_edad_local", "alerta_accion", "fecha_actualizacion")
_INTEGRATED = ("id_pelicula", "titulo", "reproducciones_mensuales", "fecha_estreno", "popularidad_api",
               "votos_promedio_api", "clasificacion_edad_local", "advertencia_contenido", "bloqueo_horario_infantil",
               "cantidad_registros_origen", "servidores_origen")
_FRAMES = (("restricciones", "restr_raw", RESTRICTION_COLUMNS), ("api", "api_raw", API_COLUMNS),
           ("integrado", "integrated", _INTEGRATED), ("final", "curated", CURATED_COLUMNS),
           ("modelo", "curated", _MODEL_COLUMNS),
           ("caracteristicas", "ml_base", ("id_pelicula", "objetivo", "popularidad_api", "votos_promedio_api",
                                           "reproducciones_mensuales", "clasificacion_edad_local")))


@query("profile_nulls_frames", "A8", with_ctes(" union all ".join(
    f"select '{name}' as marco, '{c}' as columna, count_if({c} is null) as nulos from {table}"
    for name, table, cols in _FRAMES for c in cols), *dict.fromkeys(t for _, t, _ in _FRAMES)))
def profile_nulls_frames(ctx):
    from pyspark.sql import functions as F
    e, out = ctx.etl, None
    stored = ctx.stored_curated
    frames = (e.restrictions_raw, e.api_raw, e.integrated, stored, model_columns(stored), model_frame(stored))
    for (name, _, cols), df in zip(_FRAMES, frames):
        rows = null_counts(df, cols).select(F.lit(name).alias("marco"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


def _value_sql(col: str) -> str:
    return (f"select count(*) as total_filas, count({col}) as validos, "
            f"count_if({col} is null) as invalidos, min({col}) as minimo, max({col}) as maximo "
            f"from stg_clean")


@query("profile_plays", "A11", with_ctes(_value_sql("reproducciones_mensuales"), "stg_clean"))
def profile_plays(ctx):
    return value_profile(ctx.etl.staging_clean, "reproducciones_mensuales")


@query("profile_dates", "A11", with_ctes(_value_sql("fecha_estreno_plataforma"), "stg_clean"))
def profile_dates(ctx):
    return value_profile(ctx.etl.staging_clean, "fecha_estreno_plataforma")


@query("profile_domains", "A12", with_ctes(f"""
select count_if(clasificacion_raw is not null and clasificacion_raw not in ({_q(VALID_CLASSES)}))
         as clasificaciones_invalidas,
       count_if(bloqueo_raw is not null and bloqueo_raw not in ({_q(VALID_BLOCK_FLAGS)}))
         as bloqueos_invalidos,
       count_if(id_pelicula is null) as ids_invalidos
from restr_norm""", "restr_norm"))
def profile_domains(ctx):
    return domain_profile(normalise_restrictions(ctx.etl.restrictions_raw))


@query("profile_after_clean", "A13", with_ctes("""
select 'titulos_nulos' as metrica, count_if(titulo_limpio is null) as valor from stg_clean
union all select 'servidores_nulos', count_if(servidor_origen is null) from stg_clean
union all select 'popularidad_nula', count_if(popularidad_api is null) from api_clean
union all select 'votos_nulos', count_if(votos_promedio_api is null) from api_clean""",
    "stg_clean", "api_clean"))
def profile_after_clean(ctx):
    return after_clean_nulls(ctx.etl.staging_clean, ctx.etl.api)


_STAGES = (("staging", "stg_raw"), ("restricciones", "restr_raw"), ("api", "api_raw"),
           ("staging_limpio", "stg_clean"), ("consolidado", "consolidated"),
           ("restricciones_limpio", "restr_clean"), ("api_limpio", "api_clean"),
           ("integrado", "integrated"), ("final", "curated"))


@query("source_counts", "A14", with_ctes(" union all ".join(
    f"select '{n}' as etapa, count(*) as filas from {t}" for n, t in _STAGES),
    *[t for _, t in _STAGES]))
def source_counts(ctx):
    """One aggregate per source gives the rows of every stage.

    Cleaning staging rows keeps them all; consolidating and de-duplicating leave
    one row per valid id; the joins add one row at most to each film
    (``one_to_one_violations`` counts exceptions) and the projection none.
    """
    from pyspark.sql import functions as F
    e, out = ctx.etl, None
    keys = ((clean_ids(e.staging_raw), ("staging", "staging_limpio"), ("consolidado", "integrado", "final")),
            (normalise_restrictions(e.restrictions_raw), ("restricciones",), ("restricciones_limpio",)),
            (e.api_raw.select(to_int_id(F.col("id_pelicula_api").cast("string")).alias("id_pelicula")), ("api",), ("api_limpio",)))
    for df, rows, films in keys:
        stages = [F.struct(F.lit(n).alias("etapa"), F.col(c).alias("filas")) for c, names in (("filas", rows), ("claves", films)) for n in names]
        counts = row_and_key_counts(df.select("id_pelicula"), "id_pelicula").select(F.inline(F.array(*stages)))
        out = counts if out is None else out.unionByName(counts)
    return out


@query("dirty_plays", "P13", with_ctes(f"""
select ord, id_pelicula, reproducciones_original, reproducciones_mensuales from stg_clean
where coalesce(contains(lower({_strip('reproducciones_original')}), 'views'), false)
   or {_strip('reproducciones_original')} = 'N/A' or reproducciones_original is null""", "stg_clean"))
def dirty_plays_q(ctx):
    return dirty_plays(ctx.etl.staging_clean)


@query("invalid_dates", "P14", with_ctes(
    "select ord, id_pelicula, fecha_estreno_original, fecha_estreno_plataforma from stg_clean "
    "where fecha_estreno_plataforma is null", "stg_clean"))
def invalid_dates(ctx):
    return date_rows(ctx.etl.staging_clean, valid=False)


@query("converted_dates", "P14", with_ctes(
    "select ord, id_pelicula, fecha_estreno_original, fecha_estreno_plataforma from stg_clean "
    "where fecha_estreno_plataforma is not null", "stg_clean"))
def converted_dates(ctx):
    return date_rows(ctx.etl.staging_clean, valid=True)


@query("dedup_raw_key", "D2", with_ctes("""
select * exclude (rn) from (
  select *, row_number() over (partition by id_pelicula order by ord) as rn from stg_raw)
where rn = 1""", "stg_raw"))
def dedup_raw_key(ctx):
    return first_per_key(ctx.etl.staging_raw, "id_pelicula", drop_null_keys=False)


@query("duplicate_rows", "D3", with_ctes("""
select ord, id_pelicula_original, id_pelicula, titulo_original, reproducciones_mensuales,
       servidor_origen
from (select *, count(*) over (partition by id_pelicula) as n from stg_clean)
where n > 1 order by id_pelicula nulls last, ord""", "stg_clean"))
def duplicate_rows(ctx):
    from pyspark.sql import functions as F
    cols = ("ord", "id_pelicula_original", "id_pelicula", "titulo_original",
            "reproducciones_mensuales", "servidor_origen")
    # counts on the bare id, before titles and dates are cleaned
    return (duplicated_rows(ctx.etl.staging_clean.select(*cols), "id_pelicula", clean_ids(ctx.etl.staging_raw))
            .orderBy(F.asc_nulls_last("id_pelicula"), "ord"))
