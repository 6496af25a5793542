"""Prioritised alert rule: seven branches, first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.config import (ALERT_BLOCK_KIDS, ALERT_BOOST, ALERT_CHECK_PLAYS,
                            ALERT_CHECK_QUALITY, ALERT_KEEP_FEATURED, ALERT_MONITOR,
                            ALERT_NIGHT_BANNER_AND_BLOCK, BLOCKED, DEFAULT_CONFIG,
                            CatalogConfig)


def alert_expr(cfg: CatalogConfig = DEFAULT_CONFIG, plays: str = "reproducciones_mensuales",
               popularity: str = "popularidad_api", votes: str = "votos_promedio_api",
               block: str = "bloqueo_horario_infantil") -> Column:
    """CASE expression of the rule.

    A missing popularity / vote / block flag makes its comparison null, which
    counts as "not met" and falls through to the next branch (so a film with
    no restrictions row is treated as not blocked). NaN never reaches here:
    the API cleaner turns it into null (Spark orders NaN above every number).
    """
    p, pop, v, b = F.col(plays), F.col(popularity), F.col(votes), F.col(block)
    popular = pop >= cfg.popularity_high
    low_plays = p < cfg.plays_low
    blocked = b == BLOCKED
    return (F.when(p.isNull(), F.lit(ALERT_CHECK_PLAYS))
            .when(popular & low_plays & blocked, F.lit(ALERT_NIGHT_BANNER_AND_BLOCK))
            .when(blocked, F.lit(ALERT_BLOCK_KIDS))
            .when(popular & low_plays, F.lit(ALERT_BOOST))
            .when(popular & (p >= cfg.plays_high), F.lit(ALERT_KEEP_FEATURED))
            .when(v < cfg.votes_low, F.lit(ALERT_CHECK_QUALITY))
            .otherwise(F.lit(ALERT_MONITOR)))


def apply_rules(df: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    return df.withColumn("alerta_accion", alert_expr(cfg))


def alert_counts(df: DataFrame) -> DataFrame:
    """Films per alert, most frequent first (null alert kept as its own group)."""
    return (df.groupBy("alerta_accion").agg(F.count(F.lit(1)).alias("peliculas"))
            .orderBy(F.desc("peliculas"), F.asc_nulls_first("alerta_accion")))
