"""DuckDB SQL for the correctness oracle.

Each query's oracle is ``WITH <needed CTEs> <body>``, where the CTEs restate
the domain views and the ETL steps in DuckDB's dialect. They are written from
the documented semantics, independently of the Spark code path.
"""

from __future__ import annotations

from marquee import config as C
from marquee.functions.text import BLANK_CHARS

_BLANK_LIT = "'" + BLANK_CHARS + "'"
_BLANK_RUN = "[" + "".join(f"\\x{{{ord(ch):04x}}}" for ch in BLANK_CHARS) + "]+"


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _strip(x: str) -> str:
    return f"trim({x}, {_BLANK_LIT})"


def _id(x: str) -> str:
    s = _strip(x)
    return (f"(case when regexp_matches({s}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
            f"then coalesce(try_cast({s} as bigint), try_cast(trunc(try_cast({s} as double)) as bigint)) end)")


def _title(x: str) -> str:
    t = f"nullif(regexp_replace({_strip(x)}, '{_BLANK_RUN}', ' ', 'g'), '')"
    runs = f"regexp_extract_all({t}, '([\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)')"
    tc = f"list_aggregate(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), 'string_agg', '')"
    return f"(case when upper({t}) = {t} and lower({t}) <> {t} then {tc} else {t} end)"


def _date(x: str) -> str:
    s = _strip(x)
    return (f"coalesce(cast(try_strptime({s}, '%Y-%m-%d') as date), "
            f"cast(try_strptime({s}, '%d/%m/%Y') as date))")


ALERT_CASE = f"""case
  when reproducciones_mensuales is null then '{C.ALERT_CHECK_PLAYS}'
  when popularidad_api >= {C.POPULARITY_HIGH} and reproducciones_mensuales < {C.PLAYS_LOW}
       and bloqueo_horario_infantil = '{C.BLOCKED}' then '{C.ALERT_NIGHT_BANNER_AND_BLOCK}'
  when bloqueo_horario_infantil = '{C.BLOCKED}' then '{C.ALERT_BLOCK_KIDS}'
  when popularidad_api >= {C.POPULARITY_HIGH} and reproducciones_mensuales < {C.PLAYS_LOW}
       then '{C.ALERT_BOOST}'
  when popularidad_api >= {C.POPULARITY_HIGH} and reproducciones_mensuales >= {C.PLAYS_HIGH}
       then '{C.ALERT_KEEP_FEATURED}'
  when votos_promedio_api < {C.VOTES_LOW} then '{C.ALERT_CHECK_QUALITY}'
  else '{C.ALERT_MONITOR}' end"""

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("stg_raw", """
select o_orderkey as ord,
  case when o_orderkey % 97 = 0 then 'ID-ERR'
       when o_orderkey % 7 = 0 then concat('  ', cast(o_custkey as varchar(20)), '  ')
       else cast(o_custkey as varchar(20)) end as id_pelicula,
  case when o_custkey % 30 = 3 or o_orderkey % 19 = 0 then '  '
       when o_orderkey % 10 < 3 then upper(p_name)
       when o_orderkey % 10 = 3 then concat(' ', replace(p_name, ' ', '   '), ' ')
       else p_name end as titulo_original,
  case when o_custkey % 50 = 7 or o_orderkey % 10 = 0 then 'N/A'
       when o_orderkey % 10 = 1 then null
       when o_orderkey % 10 in (2, 3, 4)
         then concat(cast(o_orderkey * 31 % (1000 + o_custkey % 10 * 1000) as varchar(20)), ' views')
       else cast(o_orderkey * 31 % (1000 + o_custkey % 10 * 1000) as varchar(20)) end as reproducciones_mensuales,
  case o_orderkey % 3 when 0 then strftime(o_orderdate,'%Y-%m-%d') when 1 then strftime(o_orderdate,'%d/%m/%Y')
       else case o_orderkey % 4 when 0 then 'Por confirmar' when 1 then 'SIN FECHA'
                                when 2 then '' else '00/00/0000' end end as fecha_estreno_plataforma,
  case o_orderkey % 4 when 0 then 'Nodo_Andes_Uno' when 1 then 'Nodo_Costa_Dos'
                      when 2 then ' Nodo_Valle_Tres ' else 'Null_Server' end as servidor_origen
from orders left join part on p_partkey = o_custkey""")

cte("restr_raw", """
select c_custkey as ord, cast(c_custkey as varchar(20)) as id_pelicula,
  case c_nationkey % 5 when 0 then 'TE' when 1 then ' te+7 ' when 2 then '14'
                       when 3 then '18' else 'X' end as clasificacion_chile,
  case when c_nationkey % 5 < 2 then 'Ninguna' else ' Terror ' end as advertencia_contenido,
  case when c_nationkey % 5 = 3 then 'si'
       when c_nationkey % 5 = 2 and c_custkey % 2 = 0 then 'SI'
       when c_nationkey % 5 = 4 then '?' else 'NO' end as bloqueo_horario_infantil
from customer where c_custkey % 20 <> 0
union all
select 10000000 + c_custkey, concat(' ', cast(c_custkey as varchar(20))), '18', 'dup', 'SI'
from customer where c_custkey % 10 = 1""")

cte("api_raw", """
select p_partkey as ord, p_partkey as id_pelicula_api,
  case when p_partkey % 25 = 1 then null else concat(' ', p_name, '  (api) ') end as titulo_api,
  cast(case when p_partkey % 25 = 1 then null else (p_partkey * 137 % 20000) / 100.0 end as double) as popularidad_api,
  cast(case when p_partkey % 25 = 1 then null else (p_partkey % 101) / 10.0 end as double) as votos_promedio_api
from part where p_partkey % 25 <> 0
union all
select case when p_partkey % 10 = 3 then 10000000 + p_partkey else -p_partkey end, p_partkey, null, null, null
from part where p_partkey % 10 in (3, 4)""")

cte("stg_clean", f"""
select ord,
  id_pelicula as id_pelicula_original,
  {_id('id_pelicula')} as id_pelicula,
  reproducciones_mensuales as reproducciones_original,
  try_cast(nullif(regexp_extract(reproducciones_mensuales, '[0-9]+', 0), '') as bigint) as reproducciones_mensuales,
  fecha_estreno_plataforma as fecha_estreno_original,
  {_date('fecha_estreno_plataforma')} as fecha_estreno_plataforma,
  titulo_original,
  {_title('titulo_original')} as titulo_limpio,
  case when lower(nullif({_strip('servidor_origen')}, '')) <> '{C.NULL_SERVER}'
       then nullif({_strip('servidor_origen')}, '') end as servidor_origen
from stg_raw""", "stg_raw")

cte("consolidated", """
select id_pelicula,
  arg_min(titulo_limpio, ord) filter (where titulo_limpio is not null) as titulo_interno,
  max(reproducciones_mensuales) as reproducciones_mensuales,
  min(fecha_estreno_plataforma) as fecha_estreno,
  count(*) as cantidad_registros_origen,
  string_agg(distinct servidor_origen, ', ' order by servidor_origen) as servidores_origen
from stg_clean where id_pelicula is not null group by id_pelicula""", "stg_clean")

cte("restr_plain", """
select ord, id_pelicula, clasificacion_chile,
  case when ord % 6 = 0 then concat('dice "', advertencia_contenido, '", y mas') else advertencia_contenido end
    as advertencia_contenido, bloqueo_horario_infantil
from restr_raw""", "restr_raw")

cte("restr_broken", """
select ord, id_pelicula, clasificacion_chile,
  case ord % 5 when 0 then 'uno' || chr(10) || advertencia_contenido || chr(10) || '"tres", y' || chr(10) || chr(10) || 'cinco'
    when 1 then '"' || chr(10) || ',' || advertencia_contenido || '",' || chr(10)
    else advertencia_contenido end as advertencia_contenido, bloqueo_horario_infantil
from restr_raw""", "restr_raw")

cte("restr_norm", f"""
select ord, {_id('id_pelicula')} as id_pelicula,
  nullif(upper({_strip('clasificacion_chile')}), '') as clasificacion_raw,
  nullif({_strip('advertencia_contenido')}, '') as advertencia_contenido,
  nullif(upper({_strip('bloqueo_horario_infantil')}), '') as bloqueo_raw
from restr_raw""", "restr_raw")

cte("restr_valid", f"""
select ord, id_pelicula,
  case when clasificacion_raw in ({_q(C.VALID_CLASSES)}) then clasificacion_raw end as clasificacion_chile,
  advertencia_contenido,
  case when bloqueo_raw in ({_q(C.VALID_BLOCK_FLAGS)}) then bloqueo_raw end as bloqueo_horario_infantil
from restr_norm where id_pelicula is not null""", "restr_norm")

cte("restr_clean", """
select id_pelicula, clasificacion_chile, advertencia_contenido, bloqueo_horario_infantil
from (select *, row_number() over (partition by id_pelicula order by ord) as rn from restr_valid)
where rn = 1""", "restr_valid")

cte("api_typed", f"""
select ord, {_id('cast(id_pelicula_api as varchar)')} as id_pelicula,
  nullif(regexp_replace({_strip('titulo_api')}, '{_BLANK_RUN}', ' ', 'g'), '') as titulo_api,
  case when isnan(popularidad_api) then null else popularidad_api end as popularidad_api,
  case when isnan(votos_promedio_api) then null else votos_promedio_api end as votos_promedio_api
from api_raw""", "api_raw")

cte("api_clean", """
select id_pelicula, titulo_api, popularidad_api, votos_promedio_api
from (select *, row_number() over (partition by id_pelicula order by ord) as rn
      from api_typed where id_pelicula is not null)
where rn = 1""", "api_typed")

cte("integrated", """
select s.id_pelicula,
  coalesce(s.titulo_interno, a.titulo_api) as titulo,
  s.reproducciones_mensuales, s.fecha_estreno,
  a.popularidad_api, a.votos_promedio_api,
  r.clasificacion_chile as clasificacion_edad_local,
  r.advertencia_contenido, r.bloqueo_horario_infantil,
  s.cantidad_registros_origen, s.servidores_origen,
  a.id_pelicula is not null as con_api,
  r.id_pelicula is not null as con_csv
from consolidated s
left join api_clean a on a.id_pelicula = s.id_pelicula
left join restr_clean r on r.id_pelicula = s.id_pelicula""", "consolidated", "api_clean", "restr_clean")

cte("ruled", f"select *, {ALERT_CASE} as alerta_accion from integrated", "integrated")

cte("curated", """
select cast(id_pelicula as integer) as id_pelicula, titulo,
  cast(reproducciones_mensuales as integer) as reproducciones_mensuales, fecha_estreno,
  cast(popularidad_api as float) as popularidad_api,
  cast(votos_promedio_api as float) as votos_promedio_api,
  clasificacion_edad_local, alerta_accion,
  timestamp '2026-01-01 00:00:00' as fecha_actualizacion
from ruled""", "ruled")


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` every CTE ``names`` needs (dependencies first), then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} as ({CTES[n][0].strip()})" for n in order)
    return f"with {parts}\n{body.strip()}"
