"""Serving queries over the curated table: lookups, listings, dashboard data.

Filters are plain predicates on the curated columns, so they reach the
parquet scan as pushed filters. On a stored version the file index narrows the
scan first: a lookup opens the one file whose id range holds the id, a page of
the listing the files that hold its places, a class the files that have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.config import (CRITICAL_ALERT_PATTERN, DEFAULT_CONFIG, HIGHLIGHT_CRITICAL,
                            HIGHLIGHT_OPPORTUNITY, CatalogConfig)
from marquee.sources.curated import CURATED_COLUMNS, file_index

OPERATIONAL_COLUMNS = ("id_pelicula", "titulo", "clasificacion_edad_local",
                       "reproducciones_mensuales", "popularidad_api", "alerta_accion")


def list_films(curated: DataFrame) -> DataFrame:
    """All films ordered by id (range-partitioned sort, no single-task sort)."""
    return curated.select(*CURATED_COLUMNS).orderBy("id_pelicula")


def film_by_id(curated: DataFrame, film_id: int) -> DataFrame:
    """Zero or one row; an empty frame means "not found"."""
    return curated.select(*CURATED_COLUMNS).where(F.col("id_pelicula") == F.lit(film_id))


# Files named one by one in a scan; a selection of more reads the whole version with the filter pushed down.
MAX_FILES = 2000


def indexed_scan(spark: SparkSession, version: str, wanted: Column) -> DataFrame:
    """The rows of those of a version's files whose index row fits ``wanted``."""
    whole = spark.read.parquet(version)
    files = [r["archivo"] for r in file_index(spark, version).filter(wanted).select("archivo").limit(MAX_FILES + 1).collect()]
    if len(files) > MAX_FILES:
        return whole
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).parquet(*files)


def lookup_film(spark: SparkSession, version: str, film_id: int) -> DataFrame:
    """``film_by_id`` on a stored version: only the file that can hold the id is opened."""
    return film_by_id(indexed_scan(spark, version, F.lit(film_id).between(F.col("desde"), F.col("hasta"))), film_id)


def films_of_class(spark: SparkSession, version: str, age_class: str | None) -> DataFrame:
    """``by_class`` on a stored version: files without the class are not opened."""
    if not age_class:
        return spark.read.parquet(version)
    return by_class(indexed_scan(spark, version, F.array_contains("clases", age_class)), age_class)


def numbered_films(spark: SparkSession, version: str) -> DataFrame:
    """The listing with its total: every film with ``posicion`` (its place by id, from 1) and ``total_registros``.

    The place is the file's rows before it plus the row's own place in the file,
    so nothing is sorted or shuffled; the index has one row per file.
    """
    return _numbered(file_index(spark, version), spark.read.parquet(version))


def film_page(spark: SparkSession, version: str, first: int, rows: int) -> DataFrame:
    """The listing's rows at places ``first`` to ``first + rows - 1``, in order; only the files that hold them are opened."""
    last = first + rows - 1
    holds = (F.col("antes") < last) & (F.col("antes") + F.col("filas") >= first)
    return (_numbered(file_index(spark, version), indexed_scan(spark, version, holds))
            .filter(F.col("posicion").between(first, last)).orderBy("posicion"))


def _numbered(index: DataFrame, rows: DataFrame) -> DataFrame:
    places = index.select("archivo", "antes", F.col("total").cast("bigint").alias("total_registros"))
    own = rows.select(*CURATED_COLUMNS, F.col("_metadata.file_path").alias("archivo"), F.col("_metadata.row_index").alias("fila"))
    return own.join(places, "archivo").select(
        *CURATED_COLUMNS, (F.col("antes") + F.col("fila") + 1).cast("bigint").alias("posicion"), "total_registros")


def films_json(curated: DataFrame) -> DataFrame:
    """One JSON object per film: nulls kept as null, dates ISO, numbers native."""
    return curated.select(
        "id_pelicula",
        F.to_json(F.struct(*CURATED_COLUMNS),
                  {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss",
                   "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias("json"))


def by_class(curated: DataFrame, age_class: str | None) -> DataFrame:
    """Dashboard filter: one class, or every film when no class is chosen."""
    return curated if not age_class else curated.where(F.col("clasificacion_edad_local") == age_class)


def dashboard_base(curated: DataFrame) -> DataFrame:
    """Curated rows with missing plays / popularity / votes shown as 0."""
    return curated.fillna({"reproducciones_mensuales": 0}).fillna(
        {"popularidad_api": 0.0, "votos_promedio_api": 0.0})


def thousands_dot(c: Column) -> Column:
    """1234567 -> '1.234.567'."""
    return F.replace(F.format_number(c, 0), F.lit(","), F.lit("."))


def _kpis(cfg: CatalogConfig, pattern: str) -> list[Column]:
    total = F.coalesce(F.sum("reproducciones_mensuales"), F.lit(0)).cast("bigint")
    alert = F.col("alerta_accion")
    return [
        F.count(F.lit(1)).alias("total_peliculas"),
        total.alias("total_reproducciones"),
        thousands_dot(total).alias("total_reproducciones_txt"),
        F.count_if(F.coalesce(alert.rlike(pattern), F.lit(False))).alias("alertas_criticas"),
        F.count_if(F.coalesce(alert.isin(*cfg.priority_actions), F.lit(False)))
        .alias("acciones_prioritarias"),
    ]


def kpi_summary(base: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG,
                pattern: str = CRITICAL_ALERT_PATTERN) -> DataFrame:
    """Film count, total plays (also dot-formatted), critical alerts, priority actions."""
    return base.agg(*_kpis(cfg, pattern))


def kpi_by_class(base: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG,
                 pattern: str = CRITICAL_ALERT_PATTERN) -> DataFrame:
    """The KPIs for every selectable class at once (one grouped pass)."""
    return (base.where(F.col("clasificacion_edad_local").isNotNull())
            .groupBy("clasificacion_edad_local").agg(*_kpis(cfg, pattern)))


def top_by_votes(base: DataFrame, n: int = 10) -> DataFrame:
    """Best-rated ``n`` films; ties go to the lower id. Per-partition top-n, then merge."""
    return (base.select("id_pelicula", "titulo", "votos_promedio_api")
            .orderBy(F.desc("votos_promedio_api"), F.asc("id_pelicula")).limit(n))


def class_options(curated: DataFrame) -> DataFrame:
    """Distinct non-null classes, sorted (filter dropdown)."""
    return (curated.select("clasificacion_edad_local")
            .where(F.col("clasificacion_edad_local").isNotNull())
            .distinct().orderBy("clasificacion_edad_local"))


def highlight(alert: Column) -> Column:
    return (F.when(alert.contains(HIGHLIGHT_CRITICAL), F.lit("critica"))
            .when(alert.contains(HIGHLIGHT_OPPORTUNITY), F.lit("oportunidad")))


def operational_table(base: DataFrame) -> DataFrame:
    """Six operational columns plus the row-highlight class."""
    return base.select(*OPERATIONAL_COLUMNS, highlight(F.col("alerta_accion")).alias("resaltado"))


def scatter_points(base: DataFrame) -> DataFrame:
    """Popularity (x) vs plays (y), coloured by class, titled for hover."""
    return base.select("id_pelicula", F.col("popularidad_api").alias("x"),
                       F.col("reproducciones_mensuales").alias("y"),
                       F.col("clasificacion_edad_local").alias("color"),
                       F.col("titulo").alias("hover"))
