"""Domain inputs derived from the driver tables.

The three sources the catalogue ETL reads (dirty staging rows, the
restrictions file, metadata-API records) are not among the given tables, so
they are derived deterministically from ``orders`` (one staging row per order,
``o_orderkey`` = arrival order, ``o_custkey`` = film id), ``part`` (film title,
API record) and ``customer`` (restriction row). The work therefore grows with
the given tables. The same derivation exists as DuckDB SQL in
``marquee.plans.oracle`` for the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.sources.tables import Tables

STAGING_COLUMNS = ("id_pelicula", "titulo_original", "reproducciones_mensuales",
                   "fecha_estreno_plataforma", "servidor_origen")
RESTRICTION_COLUMNS = ("id_pelicula", "clasificacion_chile", "advertencia_contenido",
                       "bloqueo_horario_infantil")
API_COLUMNS = ("id_pelicula_api", "titulo_api", "popularidad_api", "votos_promedio_api")


def _in(c: Column, *values) -> Column:
    return c.isin(*values)


def staging_rows(orders: DataFrame, part: DataFrame) -> DataFrame:
    """Dirty staging rows: ord + the five text columns of the staging table."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = part.select("p_partkey", "p_name")
    ok, ck, name = F.col("o_orderkey"), F.col("o_custkey"), F.col("p_name")
    ck_txt = ck.cast("string")
    plays_n = (ok * 31 % (F.lit(1000) + ck % 10 * 1000)).cast("string")
    # At scale ``part`` is far too large to broadcast, so the derivation is a
    # shuffle join on the film id; stating it keeps small runs on the same plan
    # (and spreads the per-row cleaning over the shuffle partitions).
    return (
        o.join(p.hint("merge"), o.o_custkey == p.p_partkey, "left")
        .select(
            ok.alias("ord"),
            F.when(ok % 97 == 0, F.lit("ID-ERR"))
             .when(ok % 7 == 0, F.concat(F.lit("  "), ck_txt, F.lit("  ")))
             .otherwise(ck_txt).alias("id_pelicula"),
            F.when((ck % 30 == 3) | (ok % 19 == 0), F.lit("  "))
             .when(ok % 10 < 3, F.upper(name))
             .when(ok % 10 == 3, F.concat(F.lit(" "), F.replace(name, F.lit(" "), F.lit("   ")), F.lit(" ")))
             .otherwise(name).alias("titulo_original"),
            F.when((ck % 50 == 7) | (ok % 10 == 0), F.lit("N/A"))
             .when(ok % 10 == 1, F.lit(None).cast("string"))
             .when(_in(ok % 10, 2, 3, 4), F.concat(plays_n, F.lit(" views")))
             .otherwise(plays_n).alias("reproducciones_mensuales"),
            F.when(ok % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
             .when(ok % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
             .when(ok % 4 == 0, F.lit("Por confirmar"))
             .when(ok % 4 == 1, F.lit("SIN FECHA"))
             .when(ok % 4 == 2, F.lit(""))
             .otherwise(F.lit("00/00/0000")).alias("fecha_estreno_plataforma"),
            F.when(ok % 4 == 0, F.lit("Nodo_Andes_Uno"))
             .when(ok % 4 == 1, F.lit("Nodo_Costa_Dos"))
             .when(ok % 4 == 2, F.lit(" Nodo_Valle_Tres "))
             .otherwise(F.lit("Null_Server")).alias("servidor_origen"),
        )
    )


def restriction_rows(customer: DataFrame) -> DataFrame:
    """Restrictions file rows (ord + four text columns), with repeated ids."""
    ck, nk = F.col("c_custkey"), F.col("c_nationkey") % 5
    main = customer.where(ck % 20 != 0).select(
        ck.alias("ord"),
        ck.cast("string").alias("id_pelicula"),
        F.when(nk == 0, "TE").when(nk == 1, " te+7 ").when(nk == 2, "14")
         .when(nk == 3, "18").otherwise("X").alias("clasificacion_chile"),
        F.when(nk < 2, "Ninguna").otherwise(" Terror ").alias("advertencia_contenido"),
        F.when(nk == 3, "si").when((nk == 2) & (ck % 2 == 0), "SI")
         .when(nk == 4, "?").otherwise("NO").alias("bloqueo_horario_infantil"),
    )
    repeats = customer.where(ck % 10 == 1).select(
        (F.lit(10000000) + ck).alias("ord"),
        F.concat(F.lit(" "), ck.cast("string")).alias("id_pelicula"),
        F.lit("18").alias("clasificacion_chile"),
        F.lit("dup").alias("advertencia_contenido"),
        F.lit("SI").alias("bloqueo_horario_infantil"),
    )
    return main.unionByName(repeats)


def _api_fields(part: DataFrame) -> DataFrame:
    """One response per part, and second ones: ids ending in 3 get a later 404, ids ending in 4 an earlier one."""
    pk = F.col("p_partkey")
    missing = pk % 25 == 1
    first = part.select(
        pk.alias("seq"), pk,
        F.when(~missing, F.concat(F.lit(" "), F.col("p_name"), F.lit("  (api) "))).alias("title"),
        F.when(~missing, (pk * 137 % 20000) / F.lit(100.0)).alias("popularity"),
        F.when(~missing, (pk % 101) / F.lit(10.0)).alias("vote_average"),
        F.when(pk % 25 == 0, F.lit(None).cast("int"))
         .when(missing, F.lit(404)).otherwise(F.lit(200)).alias("status"),
    )
    again = part.where((pk % 10).isin(3, 4)).select(
        F.when(pk % 10 == 3, F.lit(10000000) + pk).otherwise(-pk).alias("seq"), pk,
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("double").alias("popularity"),
        F.lit(None).cast("double").alias("vote_average"), F.lit(404).alias("status"))
    return first.unionByName(again)


def api_rows(part: DataFrame) -> DataFrame:
    """Flattened API detail records (what the extractor hands to the ETL)."""
    f = _api_fields(part).where(F.col("status").isNotNull())
    return f.select(
        F.col("seq").alias("ord"),
        F.col("p_partkey").alias("id_pelicula_api"),
        F.col("title").alias("titulo_api"),
        F.col("popularity").cast("double").alias("popularidad_api"),
        F.col("vote_average").cast("double").alias("votos_promedio_api"),
    )


def api_responses(part: DataFrame) -> DataFrame:
    """Landed detail responses: (seq, id, status, body, error), some ids with two.

    Ids with ``p_partkey % 25 == 0`` failed in transport (no status, an error
    text); ``% 25 == 1`` answered 404; the rest answered 200 with a JSON body.
    """
    f = _api_fields(part)
    ok_body = F.to_json(F.struct("title", "popularity", "vote_average"))
    not_found = F.lit('{"success":false,"status_code":34,'
                      '"status_message":"The resource you requested could not be found."}')
    return f.select(
        "seq",
        F.col("p_partkey").cast("string").alias("id"),
        F.col("status"),
        F.when(F.col("status") == 200, ok_body).when(F.col("status").isNotNull(), not_found)
         .alias("body"),
        F.when(F.col("status").isNull(), F.lit("connection reset")).alias("error"),
    )


def api_pages(part: DataFrame, page_size: int = 20) -> DataFrame:
    """Landed list pages: one JSON document ``{"page": n, "results": [{id, title}]}``.

    Each page groups ``page_size`` consecutive part keys, so every group is
    bounded by the page size.
    """
    pk = F.col("p_partkey")
    return (
        part.select((F.floor(pk / page_size) + 1).cast("int").alias("page"),
                    F.struct(pk.alias("id"), F.col("p_name").alias("title")).alias("m"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list("m")).alias("results"))
        .select(F.to_json(F.struct("page", "results")).alias("value"))
    )


def plain_restriction_rows(customer: DataFrame) -> DataFrame:
    """The same rows with quotes and commas in some warnings, to be written without their order column."""
    text = F.col("advertencia_contenido")
    return restriction_rows(customer).withColumn("advertencia_contenido", F.when(
        F.col("ord") % 6 == 0, F.concat(F.lit('dice "'), text, F.lit('", y mas'))).otherwise(text))


def broken_restriction_rows(customer: DataFrame) -> DataFrame:
    """The same rows with line breaks in some warnings: alone, beside quotes, next to a comma, at the cell's end."""
    text, k = F.col("advertencia_contenido"), F.col("ord") % 5
    return restriction_rows(customer).withColumn("advertencia_contenido", F.when(
        k == 0, F.concat(F.lit("uno\n"), text, F.lit('\n"tres", y\n\ncinco'))).when(
        k == 1, F.concat(F.lit('"\n,'), text, F.lit('",\n'))).otherwise(text))


class Fixtures:
    """The three domain inputs for one data directory."""

    def __init__(self, tables: Tables):
        self.tables = tables

    @property
    def staging(self) -> DataFrame:
        return staging_rows(self.tables.orders, self.tables.part)

    @property
    def restrictions(self) -> DataFrame:
        return restriction_rows(self.tables.customer)

    @property
    def plain_restrictions(self) -> DataFrame:
        return plain_restriction_rows(self.tables.customer)

    @property
    def broken_restrictions(self) -> DataFrame:
        return broken_restriction_rows(self.tables.customer)

    @property
    def api(self) -> DataFrame:
        return api_rows(self.tables.part)

    @property
    def api_responses(self) -> DataFrame:
        return api_responses(self.tables.part)

    @property
    def api_pages(self) -> DataFrame:
        return api_pages(self.tables.part)
