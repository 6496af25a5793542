"""Curated-table load: write a candidate, validate it, write a version, verify, commit.

The ETL runs once per load: its output is written as a candidate with the wide
types it was computed in, the constraints are checked on those files, and the
typed version is written from them. ``versions`` commits it: a reader sees
either the old or the new version, a crash leaves the old one, and of two loads
at the same time the one that commits later is current and neither is lost.

A version's files are ranges of ``id_pelicula``, sorted by it, so a film lies in
one file. A file index (``_index`` inside the version) has each file's rows, id
range and age classes, and the rows before it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.config import JDBC_BATCH_SIZE
from marquee.operators.final import constraint_violations, final_projection, total_violations
from marquee.sources.curated import INDEX, file_index
from marquee.sinks.versions import commit, current_version, new_version
from marquee.storage import remove, unique_name

class LoadValidationError(RuntimeError):
    pass


def validate_before_load(ruled: DataFrame, tolerate: tuple[str, ...] = ()) -> dict:
    """Constraint violations of the rule output; raise when any is non-zero, but those named in ``tolerate``."""
    row = constraint_violations(ruled).collect()[0]
    if total_violations(row, tolerate):
        raise LoadValidationError(f"curated constraints violated: {row.asDict()}")
    return row.asDict()


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Write and return the version's file index: archivo, filas, distintos, desde, hasta, clases, antes, total.

    A range partition never splits an id, so ids distinct in each file are distinct in all.
    """
    per_file = (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("archivo"))
                .agg(F.count(F.lit(1)).alias("filas"), F.count_distinct("id_pelicula").alias("distintos"),
                     F.min("id_pelicula").alias("desde"), F.max("id_pelicula").alias("hasta"),
                     F.collect_set("clasificacion_edad_local").alias("clases")))
    # one row per file: small beside the table
    before = Window.orderBy("desde").rowsBetween(Window.unboundedPreceding, -1)
    index = (per_file.withColumn("antes", F.coalesce(F.sum("filas").over(before), F.lit(0)))
             .withColumn("total", F.sum("filas").over(Window.partitionBy())))
    index.write.parquet(f"{path}/{INDEX}")
    return file_index(spark, path)


def write_curated(final: DataFrame, base_path: str, expected_rows: int | None = None, keep: int = 3,
                  expect: int | None = None) -> str:
    """Write a typed frame as a new version, read it back for its checks, commit it; returns its path.

    Repeated ids, or a row count other than ``expected_rows``, fail the load:
    the files go and the current version stays. ``expect``: see ``commit``.
    """
    spark = final.sparkSession
    with new_version(spark, base_path) as path:
        (final.repartitionByRange("id_pelicula").sortWithinPartitions("id_pelicula")
         .write.mode("errorifexists").parquet(path))
        check = write_index(spark, path).agg(
            F.coalesce(F.sum("filas"), F.lit(0)).alias("total_cargado"),
            F.coalesce(F.sum(F.col("filas") - F.col("distintos")), F.lit(0)).alias("ids_duplicados")).first()
        if check["ids_duplicados"] or (expected_rows is not None and check["total_cargado"] != expected_rows):
            raise LoadValidationError(f"post-load check failed: {check.asDict()}")
        commit(spark, path, keep, expect)
    return path


def load_curated(ruled: DataFrame, base_path: str, run_ts: dt.datetime | None = None, keep: int = 3,
                 expect: int | None = None, tolerate: tuple[str, ...] = ()) -> str:
    """The validated load of the rule output: one run of the ETL, whatever is checked; returns the version's path.

    Rows with a violation named in ``tolerate`` (none by default) are loaded as they are.
    """
    spark = ruled.sparkSession
    candidate = f"{base_path.rstrip('/')}/_candidate={unique_name()}"
    ruled.write.parquet(candidate)
    try:
        stored = spark.read.schema(ruled.schema).parquet(candidate)
        validate_before_load(stored, tolerate)
        return write_curated(final_projection(stored, run_ts), base_path, stored.count(), keep, expect)
    finally:
        remove(spark, candidate)


def read_current(spark: SparkSession, base_path: str) -> DataFrame:
    return spark.read.parquet(current_version(spark, base_path))


def write_curated_jdbc(ruled: DataFrame, url: str, table: str = "dw_peliculas_analitica",
                       properties: dict | None = None, batch_size: int = JDBC_BATCH_SIZE,
                       run_ts: dt.datetime | None = None) -> None:
    """Database variant: validate, then truncate + insert in batches (keeps the table's DDL).

    The insert is not one transaction across tasks: load a staging table and
    rename it there where readers must not see a half-filled one.
    """
    validate_before_load(ruled)
    (final_projection(ruled, run_ts).write.mode("overwrite")
     .option("truncate", True).option("batchsize", batch_size)
     .jdbc(url, table, properties=dict(properties or {})))
