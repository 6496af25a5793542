"""Per-source cleaning: staging columns, restrictions file, API records.

Every step is a projection of native expressions, so a chain of them compiles
into one whole-stage-codegen span with the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import DEFAULT_CONFIG, NULL_SERVER, CatalogConfig
from marquee.functions.dates import parse_date
from marquee.functions.guards import require_columns
from marquee.functions.numeric import first_digit_run, to_double, to_int_id
from marquee.functions.text import (blank_to_null, clean_token, collapse_blanks, normalise_title,
                                    strip_blanks, title_if_upper)
from marquee.operators.dedup import first_per_key
from marquee.sources.fixtures import API_COLUMNS, RESTRICTION_COLUMNS, STAGING_COLUMNS


# -- staging ------------------------------------------------------------------

def clean_ids(df: DataFrame) -> DataFrame:
    """Keep the raw id as ``id_pelicula_original``; ``id_pelicula`` -> bigint or null."""
    return (df.withColumn("id_pelicula_original", F.col("id_pelicula"))
              .withColumn("id_pelicula", to_int_id("id_pelicula")))


def clean_plays(df: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """``"8578 views"`` -> 8578, ``"N/A"``/null -> null (first digit run)."""
    return (df.withColumn("reproducciones_original", F.col("reproducciones_mensuales"))
              .withColumn("reproducciones_mensuales",
                          first_digit_run(strip_blanks("reproducciones_mensuales"),
                                          cfg.thousands_sep)))


def clean_dates(df: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """ISO or day/month/year text -> date; anything else -> null."""
    return (df.withColumn("fecha_estreno_original", F.col("fecha_estreno_plataforma"))
              .withColumn("fecha_estreno_plataforma",
                          parse_date("fecha_estreno_plataforma", cfg.date_formats)))


def clean_server(c: str = "servidor_origen"):
    s = clean_token(c)
    return F.when(F.lower(s) != NULL_SERVER, s)


def clean_texts(df: DataFrame) -> DataFrame:
    """Title -> ``titulo_limpio``; server: blank or the null-server token -> null."""
    # Two projections: the normalised title is computed once, then reused.
    return (df.withColumn("titulo_limpio", normalise_title("titulo_original"))
              .withColumn("titulo_limpio", title_if_upper("titulo_limpio"))
              .withColumn("servidor_origen", clean_server()))


def clean_staging(df: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """All staging column cleaners in their fixed order (one projection)."""
    require_columns(df, STAGING_COLUMNS, "staging")
    return (df.transform(clean_ids)
              .transform(clean_plays, cfg)
              .transform(clean_dates, cfg)
              .transform(clean_texts))


# -- restrictions --------------------------------------------------------------

def normalise_restrictions(df: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """Typed, trimmed, upper-cased restriction rows; out-of-domain codes kept
    in ``*_raw`` columns for the domain profile."""
    require_columns(df, RESTRICTION_COLUMNS, "restrictions file")
    ord_col = F.col("ord") if "ord" in df.columns else F.lit(None).cast("bigint")
    return df.select(
        ord_col.alias("ord"),
        to_int_id("id_pelicula").alias("id_pelicula"),
        clean_token("clasificacion_chile", upper=True).alias("clasificacion_raw"),
        clean_token("advertencia_contenido").alias("advertencia_contenido"),
        clean_token("bloqueo_horario_infantil", upper=True).alias("bloqueo_raw"),
    )


def clean_restrictions(df: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG,
                       dedup: bool = True) -> DataFrame:
    """Validated restrictions, one row per film (first by file order)."""
    n = normalise_restrictions(df, cfg)
    out = n.select(
        "ord", "id_pelicula",
        F.when(F.col("clasificacion_raw").isin(*cfg.valid_classes), F.col("clasificacion_raw"))
         .alias("clasificacion_chile"),
        "advertencia_contenido",
        F.when(F.col("bloqueo_raw").isin(*cfg.valid_block_flags), F.col("bloqueo_raw"))
         .alias("bloqueo_horario_infantil"),
    ).where(F.col("id_pelicula").isNotNull())
    return first_per_key(out, "id_pelicula").drop("ord") if dedup else out


# -- API -----------------------------------------------------------------------

def clean_api(df: DataFrame, dedup: bool = True) -> DataFrame:
    """Renamed, typed API records; NaN -> null; one row per film."""
    require_columns(df, API_COLUMNS, "API records")
    ord_col = F.col("ord") if "ord" in df.columns else F.lit(None).cast("bigint")
    out = df.select(
        ord_col.alias("ord"),
        to_int_id(F.col("id_pelicula_api").cast("string")).alias("id_pelicula"),
        blank_to_null(collapse_blanks(strip_blanks("titulo_api"))).alias("titulo_api"),
        to_double("popularidad_api").alias("popularidad_api"),
        to_double("votos_promedio_api").alias("votos_promedio_api"),
    ).where(F.col("id_pelicula").isNotNull())
    return first_per_key(out, "id_pelicula").drop("ord") if dedup else out
