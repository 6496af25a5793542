"""marquee: film-catalogue analytics on Spark.

Readers for the dirty staging table, the restrictions CSV and landed
metadata-API responses; DataFrame -> DataFrame cleaning, consolidation,
integration and alert-rule operators; a validated curated-table writer;
serving queries, data-quality profiles and two Spark ML pipelines.
"""

from marquee.config import CatalogConfig, DEFAULT_CONFIG

__all__ = ["CatalogConfig", "DEFAULT_CONFIG"]
