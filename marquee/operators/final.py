"""Curated-table projection, constraint checks and post-load checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import ALERTS, MAX_ALERT_LEN, MAX_CLASS_LEN, MAX_TITLE_LEN
from marquee.operators.distinct import INT_MAX, INT_MIN, distinct_ids
from marquee.sources.curated import CURATED_COLUMNS


def final_projection(df: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """The nine curated columns with the curated types and one load timestamp.

    ``run_ts`` pins the timestamp (tests, re-runs); by default it is the query
    start time floored to the second. Popularity and votes are stored as
    32-bit floats, as the target column type does.
    """
    # The target column is a zone-less DATETIME: a wall-clock timestamp_ntz
    # (session-local "now", or the pinned time given as text), so no process
    # or session time zone can shift it.
    ts = (F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz") if run_ts is not None
          else F.localtimestamp())
    return df.select(
        F.col("id_pelicula").try_cast("int").alias("id_pelicula"),
        F.col("titulo"),
        F.col("reproducciones_mensuales").try_cast("int").alias("reproducciones_mensuales"),
        F.col("fecha_estreno"),
        F.col("popularidad_api").cast("float").alias("popularidad_api"),
        F.col("votos_promedio_api").cast("float").alias("votos_promedio_api"),
        F.col("clasificacion_edad_local"),
        F.col("alerta_accion"),
        F.date_trunc("second", ts).cast("timestamp_ntz").alias("fecha_actualizacion"),
    )


def constraint_violations(df: DataFrame) -> DataFrame:
    """One row of violation counts for the curated table's constraints.

    Run on the rule output *before* the typed projection so that values the
    int columns cannot hold are counted instead of silently nulled.
    """
    def out_of_int(c: str):
        return F.col(c).isNotNull() & ((F.col(c) < INT_MIN) | (F.col(c) > INT_MAX))

    return df.agg(
        F.count_if(F.col("id_pelicula").isNull() | out_of_int("id_pelicula")).alias("id_invalido"),
        (F.count("id_pelicula") - F.count_distinct("id_pelicula")).alias("id_duplicado"),
        F.count_if(F.col("titulo").isNull()).alias("titulo_nulo"),
        F.count_if(F.length("titulo") > MAX_TITLE_LEN).alias("titulo_largo"),
        F.count_if(F.length("clasificacion_edad_local") > MAX_CLASS_LEN).alias("clasificacion_larga"),
        F.count_if(F.col("alerta_accion").isNull()
                   | ~F.col("alerta_accion").isin(*ALERTS)).alias("alerta_invalida"),
        F.count_if(F.length("alerta_accion") > MAX_ALERT_LEN).alias("alerta_larga"),
        F.count_if(out_of_int("reproducciones_mensuales")).alias("reproducciones_fuera_de_rango"),
    )


def total_violations(violations_row, tolerate: tuple[str, ...] = ()) -> int:
    """Sum of the counts but those named in ``tolerate``."""
    return sum(int(v or 0) for c, v in violations_row.asDict().items() if c not in tolerate)


def load_check(curated: DataFrame) -> DataFrame:
    """Post-load check: rows loaded and repeated ids, from bitmaps of the ids (few a task, as the files are sorted by them)."""
    counts = distinct_ids(curated, "id_pelicula", {"total_cargado": F.lit(1)})
    return counts.select("total_cargado", (F.col("total_cargado") - F.col("distintos")).alias("ids_duplicados"))


def load_sample(curated: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` films by id, seven columns (post-load preview)."""
    return (curated.select("id_pelicula", "titulo", "reproducciones_mensuales", "popularidad_api",
                           "clasificacion_edad_local", "alerta_accion", "fecha_actualizacion")
            .orderBy("id_pelicula").limit(n))


__all__ = ["CURATED_COLUMNS", "final_projection", "constraint_violations", "total_violations",
           "load_check", "load_sample"]
