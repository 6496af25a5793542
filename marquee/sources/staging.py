"""Staging-table scan (dirty text rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.fixtures import STAGING_COLUMNS

STAGING_SCHEMA = T.StructType(
    [T.StructField("ord", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in STAGING_COLUMNS]
)


def select_staging(df: DataFrame) -> DataFrame:
    """Project the arrival order and the five named staging columns as text.

    Without an ``ord`` column the row order is undefined; we then order by the
    whole row (``ord`` = null and every "first" falls back to the text values).
    """
    ord_col = F.col("ord").cast("bigint") if "ord" in df.columns else F.lit(None).cast("bigint")
    return df.select(ord_col.alias("ord"), *[F.col(c).cast("string").alias(c) for c in STAGING_COLUMNS])


def read_staging_jdbc(spark: SparkSession, url: str, table: str = "stg_catalogo_interno",
                      properties: dict | None = None, partition_column: str | None = None,
                      lower_bound: int | None = None, upper_bound: int | None = None,
                      num_partitions: int | None = None,
                      hash_partitions: int = 16) -> DataFrame:
    """Parallel JDBC scan of the staging table.

    One range per partition of a numeric ``partition_column``; without one (the
    staging table has text columns only) one hash class of the film id per
    partition, in the database's CRC32. Arrival order needs an ``ord`` column in
    the table: a database returns rows in no order.
    """
    props = dict(properties or {})
    if partition_column:
        df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                             upperBound=upper_bound, numPartitions=num_partitions,
                             properties=props)
    else:
        df = spark.read.jdbc(url, table, predicates=hash_predicates(hash_partitions), properties=props)
    return select_staging(df)


def hash_predicates(n: int, column: str = "id_pelicula") -> list[str]:
    """``n`` conditions that each row meets exactly one of (null ids count as empty text)."""
    return [f"MOD(CRC32(COALESCE({column}, '')), {n}) = {i}" for i in range(n)]


def read_staging(spark: SparkSession, path_or_table: str, fmt: str = "parquet") -> DataFrame:
    """Staging rows from a table name or a file path (parquet by default)."""
    if fmt == "table":
        return select_staging(spark.table(path_or_table))
    return select_staging(spark.read.format(fmt).load(path_or_table))


def staging_count(df: DataFrame) -> DataFrame:
    """Row count of the staging table as a one-row frame (connection probe)."""
    return df.agg(F.count(F.lit(1)).alias("total_registros"))
