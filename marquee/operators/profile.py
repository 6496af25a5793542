"""Data-quality profiles. Each is one aggregation pass returning a small frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import DEFAULT_CONFIG, CatalogConfig
from marquee.functions.text import strip_blanks


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(columna, nulos) for every column: one aggregate row, then unpivoted."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "columna", "nulos")


def duplicate_row_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row over ``columns`` (nulls compare equal).

    Grouping on the whole row combines map-side, so a row repeated a billion
    times is counted without moving its copies.
    """
    cols = list(columns or df.columns)
    per_row = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("filas_duplicadas"))


def id_profile(df: DataFrame, key: str = "id_pelicula") -> DataFrame:
    """Invalid (null) ids, distinct valid ids, extra copies and rows involved in repeats.

    Null ids count as repeats of one another, as a keep-first duplicate test does.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), n)), F.lit(0)).alias("ids_invalidos"),
        F.count(key).alias("ids_unicos"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicados_adicionales"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("filas_duplicadas"),
    )


def row_and_key_counts(df: DataFrame, key: str) -> DataFrame:
    """(filas, claves): all rows and different non-null keys, from one aggregate that combines map-side."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("filas"), F.count(key).alias("claves"))


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Total rows, valid / invalid (null) values, minimum and maximum."""
    c = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("total_filas"),
        F.count(c).alias("validos"),
        F.count_if(c.isNull()).alias("invalidos"),
        F.min(c).alias("minimo"),
        F.max(c).alias("maximo"),
    )


def domain_profile(normalised_restrictions: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """Out-of-domain class / block codes and invalid ids in the restrictions file."""
    cls, blk = F.col("clasificacion_raw"), F.col("bloqueo_raw")
    return normalised_restrictions.agg(
        F.count_if(cls.isNotNull() & ~cls.isin(*cfg.valid_classes)).alias("clasificaciones_invalidas"),
        F.count_if(blk.isNotNull() & ~blk.isin(*cfg.valid_block_flags)).alias("bloqueos_invalidos"),
        F.count_if(F.col("id_pelicula").isNull()).alias("ids_invalidos"),
    )


def metric_rows(wide: DataFrame) -> DataFrame:
    """One-row frame of counts -> (metrica, valor) rows."""
    return wide.unpivot([], wide.columns, "metrica", "valor")


def after_clean_nulls(staging_clean: DataFrame, api_clean: DataFrame) -> DataFrame:
    """Nulls left after cleaning: titles and servers (staging), popularity and votes (API)."""
    stg = staging_clean.agg(F.count_if(F.col("titulo_limpio").isNull()).alias("titulos_nulos"),
                            F.count_if(F.col("servidor_origen").isNull()).alias("servidores_nulos"))
    api = api_clean.agg(F.count_if(F.col("popularidad_api").isNull()).alias("popularidad_nula"),
                        F.count_if(F.col("votos_promedio_api").isNull()).alias("votos_nulos"))
    return metric_rows(stg).unionByName(metric_rows(api))


def dirty_plays(staging_clean: DataFrame) -> DataFrame:
    """Rows whose raw plays text was dirty: mentions 'views' (any case), is 'N/A' or missing."""
    t = strip_blanks("reproducciones_original")
    dirty = F.coalesce(F.lower(t).contains("views"), F.lit(False)) | (t == "N/A") | t.isNull()
    return staging_clean.where(F.coalesce(dirty, F.lit(False))).select(
        "ord", "id_pelicula", "reproducciones_original", "reproducciones_mensuales")


def date_rows(staging_clean: DataFrame, valid: bool) -> DataFrame:
    """Rows whose date parsed (``valid``) or did not, with the raw text."""
    d = F.col("fecha_estreno_plataforma")
    return staging_clean.where(d.isNotNull() if valid else d.isNull()).select(
        "ord", "id_pelicula", "fecha_estreno_original", "fecha_estreno_plataforma")
