"""Restrictions CSV scan: comma-separated, UTF-8, header row, all text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.fixtures import RESTRICTION_COLUMNS
from marquee.sources.quoted_csv import read_rows

# Cell texts read as missing (the usual CSV null markers).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
               "nan", "null")

CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RESTRICTION_COLUMNS])
CSV_SCHEMA_WITH_ORD = T.StructType([T.StructField("ord", T.StringType())] + list(CSV_SCHEMA))


def read_restrictions_csv(spark: SparkSession, path: str, with_ord: bool = False,
                          sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Read the restrictions file with an explicit all-text schema.

    An explicit schema keeps class codes such as ``14`` text (inference would
    make them numbers). Quotes inside quoted cells are doubled, and quoted cells
    may hold line breaks: ``quoted_csv`` finds the rows in parallel splits. The
    header must name the columns. Missing paths raise Spark's PATH_NOT_FOUND.
    Encodings other than UTF-8 go through Spark's reader, one task a file.

    ``ord`` is the file's own ``ord`` column (``with_ord``) or else the place of
    the row: its file's path, then the split's first byte, then the row's turn
    in the split. Of several files the first by path comes first.
    """
    schema = CSV_SCHEMA_WITH_ORD if with_ord else CSV_SCHEMA
    if encoding.upper().replace("-", "") == "UTF8":
        raw = _split_rows(spark, path, schema, sep)
    else:
        raw = (spark.read.schema(schema)
               .option("header", True).option("sep", sep).option("encoding", encoding)
               .option("quote", '"').option("escape", '"').option("multiLine", True)
               .option("mode", "PERMISSIVE").option("enforceSchema", False).csv(path)
               .withColumn("_place", F.struct(F.col("_metadata.file_path").alias("archivo"),
                                              F.col("_metadata.file_block_start").alias("inicio"),
                                              F.monotonically_increasing_id().alias("fila"))))
    cols = [F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)).alias(c) for c in RESTRICTION_COLUMNS]
    return raw.select((F.col("ord").try_cast("bigint") if with_ord else F.col("_place")).alias("ord"), *cols)


def _split_rows(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    text = F.regexp_replace("row", "^\ufeff", "")
    cells = F.from_csv(text, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                       {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    rows = read_rows(spark, path, sep).withColumn("cells", cells)
    named = F.lit(True)
    for field in schema:
        named = named & F.coalesce(F.lower(F.trim(F.col(f"cells.{field.name}"))) == field.name, F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("the header does not name the expected columns: "), F.col("row"))).cast("boolean")
    data = F.when(~F.col("first"), True).when(named, False).otherwise(wrong)
    place = F.struct("archivo", "inicio", F.col("n").alias("fila"))
    return rows.filter(data).select(place.alias("_place"), "cells.*")
