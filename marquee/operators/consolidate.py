"""One row per film from the cleaned staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import blank_to_null


def consolidate(df: DataFrame) -> DataFrame:
    """Group the cleaned staging rows by film.

    * ``titulo_interno``: first non-null cleaned title by arrival order;
    * ``reproducciones_mensuales``: max; ``fecha_estreno``: earliest date;
    * ``cantidad_registros_origen``: rows in the group (nulls included);
    * ``servidores_origen``: distinct servers sorted and joined by ", ".

    Rows without a valid id are dropped before grouping (null keys form no
    group). All five aggregates combine partially on the map side, so a film
    holding a third of the rows still ships one row per map task. The set of
    servers is bounded by the distinct servers of one film.
    """
    # min ignores nulls: rows without a title have no candidate
    first_title = F.min(F.when(F.col("titulo_limpio").isNotNull(), F.struct("ord", "titulo_limpio")))
    return (
        df.where(F.col("id_pelicula").isNotNull())
        .groupBy("id_pelicula")
        .agg(
            first_title["titulo_limpio"].alias("titulo_interno"),
            F.max("reproducciones_mensuales").alias("reproducciones_mensuales"),
            F.min("fecha_estreno_plataforma").alias("fecha_estreno"),
            F.count(F.lit(1)).alias("cantidad_registros_origen"),
            blank_to_null(F.array_join(F.array_sort(F.collect_set("servidor_origen")), ", "))
            .alias("servidores_origen"),
        )
    )


def duplicate_resolution(consolidated: DataFrame) -> DataFrame:
    """Films that had several staging rows, and ids still repeated afterwards."""
    return consolidated.agg(
        F.count_if(F.col("cantidad_registros_origen") > 1).alias("duplicados_resueltos"),
        (F.count(F.lit(1)) - F.count_distinct("id_pelicula")).alias("duplicados_restantes"),
    )
