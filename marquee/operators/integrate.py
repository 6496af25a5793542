"""Left-join the three sources on the film id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INTEGRATED_COLUMNS = ("id_pelicula", "titulo", "reproducciones_mensuales", "fecha_estreno",
                      "popularidad_api", "votos_promedio_api", "clasificacion_edad_local",
                      "advertencia_contenido", "bloqueo_horario_infantil",
                      "cantidad_registros_origen", "servidores_origen")


def integrate(consolidated: DataFrame, api: DataFrame, restrictions: DataFrame,
              with_markers: bool = False) -> DataFrame:
    """staging ⟕ API ⟕ restrictions on ``id_pelicula``.

    All three inputs leave their de-duplication hash-partitioned by
    ``id_pelicula``, so the sort-merge joins add no exchange; AQE turns a
    join into a broadcast at run time only when the measured right side is
    under its threshold. ``with_markers`` keeps two flags telling whether the
    API / restrictions row matched (for the unmatched counts).
    """
    api = api.select("id_pelicula", "titulo_api", "popularidad_api", "votos_promedio_api",
                     F.lit(True).alias("_api_match"))
    restrictions = restrictions.select("id_pelicula", "clasificacion_chile",
                                       "advertencia_contenido", "bloqueo_horario_infantil",
                                       F.lit(True).alias("_csv_match"))
    joined = (consolidated.join(api, "id_pelicula", "left")
              .join(restrictions, "id_pelicula", "left"))
    cols = [
        F.col("id_pelicula"),
        F.coalesce("titulo_interno", "titulo_api").alias("titulo"),
        F.col("reproducciones_mensuales"),
        F.col("fecha_estreno"),
        F.col("popularidad_api"),
        F.col("votos_promedio_api"),
        F.col("clasificacion_chile").alias("clasificacion_edad_local"),
        F.col("advertencia_contenido"),
        F.col("bloqueo_horario_infantil"),
        F.col("cantidad_registros_origen"),
        F.col("servidores_origen"),
    ]
    if with_markers:
        cols += [F.col("_api_match").isNotNull().alias("con_api"),
                 F.col("_csv_match").isNotNull().alias("con_csv")]
    return joined.select(*cols)


def unmatched_counts(integrated_with_markers: DataFrame) -> DataFrame:
    """Films without an API row / without a restrictions row (one pass)."""
    return integrated_with_markers.agg(
        F.count(F.lit(1)).alias("peliculas"),
        F.count_if(~F.col("con_api")).alias("peliculas_sin_api"),
        F.count_if(~F.col("con_csv")).alias("peliculas_sin_csv"),
    )


def key_repeats(df: DataFrame, side: str, key: str = "id_pelicula") -> DataFrame:
    """One row: how many keys appear more than once on one side of a join.

    Per-key counts combine on the map side; the result is a single row.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.lit(side).alias("lado"),
                       F.count_if(F.col("_n") > 1).alias("claves_repetidas"))


def one_to_one_violations(left: DataFrame, right: DataFrame, key: str = "id_pelicula") -> DataFrame:
    """Keys repeated on either side of a one-to-one join (0 and 0 when valid).

    The two one-row results are stacked with a union, not joined.
    """
    return key_repeats(left, "izquierda", key).unionByName(key_repeats(right, "derecha", key))


def assert_one_to_one(left: DataFrame, right: DataFrame, key: str = "id_pelicula") -> None:
    """Opt-in validation before a join: raise when either side repeats a key."""
    bad = {r["lado"]: r["claves_repetidas"] for r in one_to_one_violations(left, right, key).collect()}
    if any(bad.values()):
        raise ValueError(f"join on {key} is not one-to-one: {bad}")
