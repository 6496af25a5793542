"""Metadata-API responses landed as JSON lines, and id candidates for fetching.

The HTTP client itself is out of scope: a fetcher lands one JSON line per
request (``seq``, ``id``, ``status``, ``body``, ``error``) and list pages as JSON
documents; everything after landing is a Spark scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.numeric import is_digits, to_double
from marquee.functions.text import strip_blanks

RESPONSE_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),  # landing sequence: which response came first
    T.StructField("id", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("error", T.StringType()),
])

DETAIL_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("vote_average", T.DoubleType()),
])

PAGE_SCHEMA = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
    ]))),
])


def read_api_responses(spark: SparkSession, path: str) -> DataFrame:
    """Scan landed detail responses (JSON lines) with a fixed schema."""
    return spark.read.schema(RESPONSE_SCHEMA).json(path)


def parse_detail(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed responses -> (ord, id_pelicula_api, titulo_api, popularidad_api, votos_promedio_api).

    * transport failure (no status) -> no row;
    * status other than 200 -> the id with three nulls;
    * status 200 with a body that is not a JSON object -> no row (the fetch
      raised while decoding).

    ``ord`` is the landing sequence ``seq`` (null where the responses have none).
    """
    seq = F.col("seq").cast("bigint") if "seq" in responses.columns else F.lit(None).cast("bigint")
    ok = F.col("status") == 200
    valid_json = F.json_object_keys("body").isNotNull()
    detail = F.from_json("body", DETAIL_SCHEMA)
    return (
        responses
        .where(F.col("status").isNotNull() & (~ok | valid_json))
        .select(
            seq.alias("ord"),
            F.col("id").try_cast("bigint").alias("id_pelicula_api"),
            F.when(ok, detail["title"]).alias("titulo_api"),
            F.when(ok, to_double(detail["popularity"])).alias("popularidad_api"),
            F.when(ok, to_double(detail["vote_average"])).alias("votos_promedio_api"),
            *keep,
        )
    )


def flatten_pages(pages: DataFrame, column: str = "value") -> DataFrame:
    """Page documents ``{"results": [{id, title}, ...]}`` -> one row per movie."""
    return (
        pages.select(F.from_json(column, PAGE_SCHEMA).alias("p"))
        .select(F.col("p.page").alias("page"), F.explode("p.results").alias("m"))
        .select("page", F.col("m.id").alias("id"), F.col("m.title").alias("titulo"))
    )


def read_api_pages(spark: SparkSession, path: str) -> DataFrame:
    return flatten_pages(spark.read.text(path))


def api_id_candidates(staging: DataFrame, already_landed: DataFrame | None = None) -> DataFrame:
    """Staging ids to request: stripped, digits only, distinct, text order.

    ``already_landed`` (a frame with an ``id`` text column) removes ids whose
    response is already in the landing zone (anti join, no re-fetch).
    """
    ids = (staging.select(strip_blanks("id_pelicula").alias("id"))
           .where(is_digits("id"))
           .distinct())
    if already_landed is not None:
        ids = ids.join(already_landed.select(strip_blanks("id").alias("id")), "id", "left_anti")
    return ids.orderBy("id")


def valid_ids_numeric(staging: DataFrame) -> DataFrame:
    """Distinct valid staging ids as integers, numeric order."""
    return (staging.select(strip_blanks("id_pelicula").alias("t"))
            .where(is_digits("t"))
            .select(F.col("t").try_cast("bigint").alias("id_pelicula"))
            .where(F.col("id_pelicula").isNotNull())
            .distinct()
            .orderBy("id_pelicula"))
