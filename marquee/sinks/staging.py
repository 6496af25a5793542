"""Staging replace: the dirty rows as a new version of the staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.sinks.curated import LoadValidationError
from marquee.sinks.versions import commit, new_version
from marquee.sources.staging import select_staging


def replace_staging(rows: DataFrame, base_path: str, keep: int = 3) -> str:
    """Write the rows (order and five text columns) as a new version and make it current; returns its path.

    The written rows are counted against the source; on a difference the version
    goes and the current one stays. Readers never see a half-written table.
    """
    spark = rows.sparkSession
    staged = select_staging(rows)
    with new_version(spark, base_path) as path:
        staged.write.mode("errorifexists").parquet(path)
        wrote, have = spark.read.parquet(path).count(), staged.count()
        if wrote != have:
            raise LoadValidationError(f"{wrote} staging rows written of {have}")
        commit(spark, path, keep)
    return path
