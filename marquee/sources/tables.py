"""Lazy access to the parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marquee.storage import fingerprint

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


# Schema of each table as its files are now, read from a footer once per
# process (about 0.15 s on the driver per read). Rewritten files have another
# fingerprint, so a new column is seen.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


class Tables:
    """``Tables(spark, dir).orders`` -> ``spark.read.parquet(dir/orders.parquet)``."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        path = f"{self.data_dir}/{name}.parquet"
        key = path, fingerprint(self.spark, path)
        schema = _SCHEMAS.get(key)
        if schema is None:
            df = self.spark.read.parquet(path)
            _SCHEMAS[key] = df.schema
            return df
        return self.spark.read.schema(schema).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
