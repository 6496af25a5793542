"""A hot key: one film holds a third of all staging rows.

Results must equal a brute-force computation, and the per-film steps must
aggregate on the map side (one partial row per map task for the hot film)
instead of sending the film's rows to one task.
"""

import math

from pyspark.sql import functions as F

from marquee.operators.clean import clean_staging
from marquee.operators.consolidate import consolidate
from marquee.operators.dedup import duplicated_rows, first_per_key
from marquee.sources import Fixtures, Tables
from tests.conftest import SF001

HOT = "7"


def _hot_staging(spark):
    raw = Fixtures(Tables(spark, SF001)).staging
    return (raw.withColumn("id_pelicula",
                           F.when(F.col("ord") % 3 == 0, F.lit(HOT)).otherwise(F.col("id_pelicula")))
            .repartition(12))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _none(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


def test_hot_film_consolidation_matches_brute_force(spark):
    clean = clean_staging(_hot_staging(spark))
    got = consolidate(clean)
    plan = _plan(got)
    assert "partial_max" in plan and "partial_count" in plan  # map-side combine
    rows = {r["id_pelicula"]: r for r in got.collect()}

    pdf = clean.toPandas()
    pdf = pdf[pdf["id_pelicula"].notna()]
    hot_rows = (pdf["id_pelicula"] == int(HOT)).sum()
    assert hot_rows * 3 >= len(pdf) - 3  # the hot film really holds about a third
    assert set(rows) == set(int(k) for k in pdf["id_pelicula"].unique())
    for k, g in pdf.groupby("id_pelicula"):
        g = g.sort_values("ord")
        titles = g["titulo_limpio"].dropna()
        plays = [_none(v) for v in g["reproducciones_mensuales"]]
        plays = [int(v) for v in plays if v is not None]
        dates = [d for d in g["fecha_estreno_plataforma"] if _none(d) is not None]
        servers = sorted(set(g["servidor_origen"].dropna()))
        r = rows[int(k)]
        assert r["titulo_interno"] == (titles.iloc[0] if len(titles) else None)
        assert r["reproducciones_mensuales"] == (max(plays) if plays else None)
        assert r["fecha_estreno"] == (min(dates) if dates else None)
        assert r["cantidad_registros_origen"] == len(g)
        assert r["servidores_origen"] == (", ".join(servers) or None)


def test_hot_film_keep_first_and_duplicates(spark):
    raw = _hot_staging(spark)
    first = first_per_key(raw, "id_pelicula")
    assert "partial_min(" in _plan(first) and "min_by" not in _plan(first)
    pdf = raw.toPandas()
    expected = pdf[pdf["id_pelicula"].notna()].sort_values("ord").groupby("id_pelicula").head(1)
    got = {r["id_pelicula"]: r["ord"] for r in first.select("id_pelicula", "ord").collect()}
    assert got == dict(zip(expected["id_pelicula"], expected["ord"]))

    dups = duplicated_rows(raw, "id_pelicula")
    counts = pdf.groupby("id_pelicula", dropna=False).size()
    expected_n = int(counts[counts > 1].sum())
    assert dups.count() == expected_n
    assert dups.where(F.col("id_pelicula") == HOT).count() == int(counts[HOT])
