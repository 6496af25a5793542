"""Curated-table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CURATED_COLUMNS = ("id_pelicula", "titulo", "reproducciones_mensuales", "fecha_estreno",
                   "popularidad_api", "votos_promedio_api", "clasificacion_edad_local",
                   "alerta_accion", "fecha_actualizacion")

# Columns both models read (everything but the release date).
MODEL_COLUMNS = ("id_pelicula", "titulo", "reproducciones_mensuales", "popularidad_api",
                 "votos_promedio_api", "clasificacion_edad_local", "alerta_accion",
                 "fecha_actualizacion")


def read_curated(spark: SparkSession, path_or_table: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "table":
        return spark.table(path_or_table)
    return spark.read.format(fmt).load(path_or_table)


# The file index inside a stored version: one row per file.
INDEX = "_index"


def file_index(spark: SparkSession, version: str) -> DataFrame:
    """archivo, filas, distintos, desde, hasta (ids), clases, antes (rows in the files before), total (rows of all) of a stored version."""
    return spark.read.parquet(f"{version}/{INDEX}")


def model_columns(curated: DataFrame) -> DataFrame:
    """8-column projection the models use; pruned at the parquet scan."""
    return curated.select(*MODEL_COLUMNS)
