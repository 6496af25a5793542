"""Registered queries: classifier inputs/split/evaluation and clustering features/metrics.

Model fits (random forest, KMeans restarts) are iterative and seeded
differently from any SQL engine, so their outputs are registered without an
oracle. Everything around them — target, features, split, weights, feature
preprocessing, metrics and summaries for a fixed labelling — has one.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from marquee import config as C
from marquee.operators import classifier as M
from marquee.operators import clustering as K
from marquee.plans.oracle import _q, cte, with_ctes
from marquee.plans.registry import query
from marquee.sinks.models import write_classifier, write_segmentation

# Fixed labelling used by the SQL-checkable cluster queries.
FIXED_K = 4
# Levels present in the test data (oracle side; the Spark side derives them).
ORACLE_ML_LEVELS = ("14", "18", "TE", "TE+7", C.UNKNOWN_CLASS)
ORACLE_CLUSTER_LEVELS = ("14", "18", "TE", "TE+7")


def _hash_sql(x: str, seed: int = C.SEED) -> str:
    m = 4294967296
    e = f"((({x} % {m}) + {m}) % {m} + {seed}) % {m}"
    for _ in range(2):
        e = f"xor({e}, ({e}) >> 16)"
        e = f"(({e}) * 73244475) % {m}"
    return f"xor({e}, ({e}) >> 16)"


cte("ml_base", f"""
select id_pelicula,
  cast(coalesce(alerta_accion in ({_q(C.PRIORITY_ACTIONS)}), false) as integer) as objetivo,
  coalesce(try_cast(popularidad_api as double), 0) as popularidad_api,
  coalesce(try_cast(votos_promedio_api as double), 0) as votos_promedio_api,
  coalesce(try_cast(reproducciones_mensuales as double), 0) as reproducciones_mensuales,
  coalesce(clasificacion_edad_local, '{C.UNKNOWN_CLASS}') as clasificacion_edad_local
from curated""", "curated")

cte("ml_split", f"""
select * exclude (rn, n), rn <= ceil(n * 0.2::double) as es_test
from (select *, row_number() over (partition by objetivo order by h, id_pelicula) as rn,
             count(*) over (partition by objetivo) as n
      from (select *, {_hash_sql('id_pelicula')} as h from ml_base))""", "ml_base")


@query("ml_target", "P22", with_ctes("select id_pelicula, objetivo from ml_base", "ml_base"))
def ml_target(ctx):
    return M.with_target(ctx.stored_curated).select("id_pelicula", "objetivo")


@query("ml_features", "P23 M1", with_ctes(
    "select id_pelicula, objetivo, popularidad_api, votos_promedio_api, reproducciones_mensuales, "
    + ", ".join(f"cast(clasificacion_edad_local = '{v}' as integer) as \"clasificacion_edad_local_{v}\""
                for v in ORACLE_ML_LEVELS[1:]) + " from ml_base", "ml_base"))
def ml_features(ctx):
    frame = M.model_frame(ctx.stored_curated)
    return M.dummy_columns(frame, M.class_levels(frame))


@query("stratified_split", "M2", with_ctes(
    "select id_pelicula, objetivo, es_test from ml_split", "ml_split"))
def stratified_split(ctx):
    return M.stratified_split(M.model_frame(ctx.stored_curated)).select("id_pelicula", "objetivo", "es_test")


@query("class_weights", "M3", with_ctes("""
select objetivo, count(*) as n,
  cast(sum(count(*)) over () as double) / (count(*) over () * count(*)) as peso
from ml_split where not es_test group by objetivo""", "ml_split"))
def class_weights(ctx):
    split = M.stratified_split(M.model_frame(ctx.stored_curated))
    return M.class_weights(split.where(~F.col("es_test")))


def _predictions(ctx):
    _, pred = ctx.fitted("forest", lambda: M.train_and_predict(M.model_frame(ctx.stored_curated)))
    return pred


# Evaluation of a fixed prediction rule, which SQL can state too.
RULE_PLAYS = 4000
cte("ml_rule", f"""
select objetivo as y_real, cast(reproducciones_mensuales < {RULE_PLAYS} as integer) as y_pred
from ml_split where es_test""", "ml_split")


def _rule_predictions(ctx):
    return M.stratified_split(M.model_frame(ctx.stored_curated)).where("es_test").select(
        F.col(M.LABEL).alias("y_real"), (F.col("reproducciones_mensuales") < RULE_PLAYS).cast("int").alias("y_pred"))


@query("eval_accuracy_rule", "M5", with_ctes(
    "select count(*) as n, avg(cast(y_real = y_pred as double)) as accuracy from ml_rule", "ml_rule"))
def eval_accuracy_rule(ctx):
    return M.accuracy(_rule_predictions(ctx))


@query("eval_confusion_rule", "M6", with_ctes(
    "select y_real, y_pred, count(*) as n from ml_rule group by all", "ml_rule"))
def eval_confusion_rule(ctx):
    return M.confusion(_rule_predictions(ctx))


@query("eval_report_rule", "M7", with_ctes("""
select clase, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1, s as support from (
  select cast(c as varchar) as clase, p, r, case when p + r > 0 then 2 * p * r / (p + r) else 0 end as f, s from pr
  union all
  select 'macro avg', avg(p), avg(r), avg(case when p + r > 0 then 2 * p * r / (p + r) else 0 end), cast(sum(s) as bigint) from pr
  union all
  select 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s),
         sum(case when p + r > 0 then 2 * p * r / (p + r) else 0 end * s) / sum(s), cast(sum(s) as bigint) from pr)""".replace(
    "from pr", """from (select c, case when pp > 0 then tp * 1.0::double / pp else 0 end as p,
          case when s > 0 then tp * 1.0::double / s else 0 end as r, s from (
            select c, count_if(y_real = c and y_pred = c) as tp, count_if(y_pred = c) as pp, count_if(y_real = c) as s
            from ml_rule, (values (0), (1)) v(c) group by c))"""), "ml_rule"))
def eval_report_rule(ctx):
    return M.classification_report(_rule_predictions(ctx)).select(
        "clase", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


def _checks(spark, found: dict[str, bool]):
    return spark.createDataFrame([(k, bool(v)) for k, v in found.items()], "comprobacion string, ok boolean")


@query("rf_checks", "M4 M8", """
select * from (values ('ids_de_prueba', true), ('reales_coinciden', true), ('predicciones_binarias', true),
                      ('supera_mayoria', true)) t(comprobacion, ok)""")
def rf_checks(ctx):
    """What must hold of any fitted forest: every test row once, its real class, 0/1, better than the majority."""
    pred = _predictions(ctx).persist()
    try:
        test = M.stratified_split(M.model_frame(ctx.stored_curated)).where("es_test").select(M.KEY, M.LABEL)
        both = pred.groupBy(M.KEY).agg(F.count(F.lit(1)).alias("n"), F.min("y_real").alias("y_real")).join(test, M.KEY, "full")
        c = both.agg(F.count_if(F.col("n").isNull() | (F.col("n") != 1) | F.col(M.LABEL).isNull()).alias("ids"),
                     F.count_if(~F.col("y_real").eqNullSafe(F.col(M.LABEL))).alias("real")).first()
        p = pred.agg(F.count_if(~F.coalesce(F.col("y_pred").isin(0, 1), F.lit(False))).alias("odd"),
                     F.avg((F.col("y_real") == F.col("y_pred")).cast("double")).alias("acc"),
                     F.avg(F.col("y_real").cast("double")).alias("ones")).first()
    finally:
        pred.unpersist()
    return _checks(ctx.spark, {"ids_de_prueba": c["ids"] == 0, "reales_coinciden": c["real"] == 0,
                               "predicciones_binarias": p["odd"] == 0,
                               "supera_mayoria": p["acc"] >= max(p["ones"], 1 - p["ones"])})


@query("rf_predictions", "M4 M8")
def rf_predictions(ctx):
    return _predictions(ctx)


@query("eval_accuracy", "M5")
def eval_accuracy(ctx):
    return M.accuracy(_predictions(ctx))


@query("eval_confusion", "M6")
def eval_confusion(ctx):
    return M.confusion(_predictions(ctx))


@query("eval_report", "M7")
def eval_report(ctx):
    return M.classification_report(_predictions(ctx))


# -- clustering -----------------------------------------------------------------------------

_Z = [K.z_name(c) for c in K.NUMERIC]
_OH = [K.onehot_name(v) for v in ORACLE_CLUSTER_LEVELS]
_DIMS = _Z + _OH


def _band_sql(k: int) -> str:
    return (f"cast(least({k - 1}, greatest(0, floor(coalesce(cast(popularidad_api as double), 0)"
            f" * {k} / 200))) as integer)")


cte("cl_med", """
select median(cast(reproducciones_mensuales as double)) as med_r,
       median(cast(popularidad_api as double)) as med_p,
       median(cast(votos_promedio_api as double)) as med_v
from curated""", "curated")

cte("cl_imp", """
select c.id_pelicula, c.popularidad_api as pop_raw,
  coalesce(cast(reproducciones_mensuales as double), med_r) as r,
  coalesce(cast(popularidad_api as double), med_p) as p,
  coalesce(cast(votos_promedio_api as double), med_v) as v,
  clasificacion_edad_local
from curated c, cl_med""", "curated", "cl_med")

cte("cl_mode", """
select clasificacion_edad_local as moda from curated where clasificacion_edad_local is not null
group by 1 order by count(*) desc, 1 limit 1""", "curated")

cte("cl_feat", f"""
select id_pelicula, pop_raw as popularidad_api,
  (r - mr) / case when sr = 0 then 1 else sr end as {_Z[0]},
  (p - mp) / case when sp = 0 then 1 else sp end as {_Z[1]},
  (v - mv) / case when sv = 0 then 1 else sv end as {_Z[2]},
  {", ".join(f"cast(coalesce(clasificacion_edad_local, moda) = '{lv}' as double) as \"{n}\""
             for lv, n in zip(ORACLE_CLUSTER_LEVELS, _OH))}
from cl_imp,
  (select avg(r) as mr, stddev_pop(r) as sr, avg(p) as mp, stddev_pop(p) as sp,
          avg(v) as mv, stddev_pop(v) as sv from cl_imp) m,
  cl_mode""", "cl_imp", "cl_mode")


def _q_ident(n: str) -> str:
    return f'"{n}"'


def _metrics_sql(k: int) -> str:
    dims = [_q_ident(d) for d in _DIMS]
    sq = " + ".join(f"{d} * {d}" for d in dims)
    sums = ", ".join(f"sum({d}) as s{i}" for i, d in enumerate(dims))
    dot = " + ".join(f"p.{d} * cs.s{i}" for i, d in enumerate(dims))
    psq = " + ".join(f"p.{d} * p.{d}" for d in dims)
    cent = " + ".join(f"(p.{d} - cs.s{i} / cs.n) * (p.{d} - cs.s{i} / cs.n)" for i, d in enumerate(dims))
    return f"""(
with pts as (select *, {_band_sql(k)} as cluster from cl_feat),
cs as (select cluster as c, count(*) as n, sum({sq}) as q, {sums} from pts group by cluster),
pair as (select p.id_pelicula, p.cluster as own, cs.c, cs.n,
                {psq} + cs.q / cs.n - 2 * ({dot}) / cs.n as d
         from pts p cross join cs),
per as (select id_pelicula, max(case when c = own then n end) as n_own,
               max(case when c = own then d * n / greatest(n - 1, 1) end) as a,
               min(case when c <> own then d end) as b
        from pair group by id_pelicula),
sil as (select avg(case when n_own <= 1 then 0 when a < b then 1 - a / b
                        when a > b then b / a - 1 else 0 end) as s from per),
ine as (select sum({cent}) as i from pts p join cs on cs.c = p.cluster)
select {k} as k, round(s, 6) as silhouette_score, round(i, 6) as inercia from sil, ine)"""


def _prep(ctx):
    return ctx.fitted("cluster_prep", lambda: K.fit_preprocessing(ctx.stored_curated))


def _fixed_features(ctx, k: int):
    prep = _prep(ctx)
    cur = ctx.stored_curated.withColumn("cluster", K.popularity_bands(ctx.stored_curated, k))
    return K.feature_columns(cur, prep, keep=("cluster",)), K.feature_names(prep)


@query("cluster_features", "M9 M10 M11 M12", with_ctes(
    "select id_pelicula, " + ", ".join(f"round({z}, 9) as {z}" for z in _Z) + ", "
    + ", ".join(_q_ident(o) for o in _OH) + " from cl_feat", "cl_feat"))
def cluster_features(ctx):
    feats = K.feature_columns(ctx.stored_curated, _prep(ctx))
    return feats.select("id_pelicula", *[F.round(z, 9).alias(z) for z in _Z],
                        *[c for c in feats.columns if c.startswith(K.CLASS_COL)])


def _metrics_frame(ctx, ks):
    prep, cur = _prep(ctx), ctx.stored_curated
    labels = {k: f"cluster_{k}" for k in ks}
    cur = cur.withColumns({x: K.popularity_bands(cur, k) for k, x in labels.items()})
    feats = K.feature_columns(cur, prep, keep=tuple(labels.values())).persist()
    try:
        found = K.many_cluster_metrics(feats, K.feature_names(prep), list(labels.values()))
    finally:
        feats.unpersist()
    df = ctx.spark.createDataFrame([(k, *found[x]) for k, x in labels.items()],
                                   "k int, silhouette_score double, inercia double")
    return df.select("k", F.round("silhouette_score", 6).alias("silhouette_score"),
                     F.round("inercia", 6).alias("inercia"))


@query("inertia_fixed", "M14", with_ctes(
    f"select inercia from {_metrics_sql(FIXED_K)}", "cl_feat"))
def inertia_fixed(ctx):
    feats, names = _fixed_features(ctx, FIXED_K)
    return K.inertia(feats, names).select(F.round("inercia", 6).alias("inercia"))


@query("silhouette_fixed", "M15", with_ctes(
    f"select silhouette_score from {_metrics_sql(FIXED_K)}", "cl_feat"))
def silhouette_fixed(ctx):
    feats, names = _fixed_features(ctx, FIXED_K)
    return K.silhouette_sq(feats, names).select(F.round("silhouette_score", 6).alias("silhouette_score"))


def _euclid_sql(k: int) -> str:
    """The exact mean Euclidean silhouette of a fixed labelling, from all pairs."""
    gap = " + ".join(f"(a.{x} - b.{x}) * (a.{x} - b.{x})" for x in map(_q_ident, _DIMS))
    return f"""(
with pts as (select *, {_band_sql(k)} as cluster from cl_feat),
n as (select cluster, count(*) as n from pts group by cluster),
pair as (select a.id_pelicula, a.cluster as own, b.cluster as other, sum(sqrt({gap})) as total
         from pts a cross join pts b group by all),
m as (select id_pelicula, own, other, total / (case when own = other then greatest(n - 1, 1) else n end) as d, n
      from pair join n on n.cluster = pair.other),
ab as (select id_pelicula, max(case when own = other then d end) as a, min(case when own <> other then d end) as b,
              max(case when own = other then n end) as n from m group by id_pelicula)
select {k} as k, round(avg(case when n = 1 or greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end), 6) as silhouette_score
from ab)"""


@query("silhouette_euclidean", "M15", with_ctes(
    " union all ".join(f"select * from {_euclid_sql(k)}" for k in C.K_RANGE), "cl_feat"))
def silhouette_euclidean(ctx):
    # From all pairs of films, as in the SQL.
    from marquee.operators.silhouette import silhouettes
    feats, names = K.feature_columns(ctx.stored_curated, _prep(ctx), keep=("popularidad_api",)), K.feature_names(_prep(ctx))
    labels = {k: f"c{k}" for k in C.K_RANGE}
    banded = feats.select("id_pelicula", *names, *[K.popularity_bands(feats, k).alias(x) for k, x in labels.items()])
    found = silhouettes(banded, names, list(labels.values()), "id_pelicula")
    return ctx.spark.createDataFrame([(k, round(found[x][0], 6)) for k, x in labels.items()], "k int, silhouette_score double")


@query("k_metrics_fixed", "M13 M14 M15", with_ctes(
    " union all ".join(f"select * from {_metrics_sql(k)}" for k in C.K_RANGE), "cl_feat"))
def k_metrics_fixed(ctx):
    return _metrics_frame(ctx, C.K_RANGE)


@query("best_k", "D9", with_ctes(
    "select k as mejor_k, silhouette_score from ("
    + " union all ".join(f"select * from {_metrics_sql(k)}" for k in C.K_RANGE)
    + ") order by silhouette_score desc, k limit 1", "cl_feat"))
def best_k_q(ctx):
    return K.best_k(_metrics_frame(ctx, C.K_RANGE))


cte("cl_banded", f"select *, {_band_sql(FIXED_K)} as cluster from curated", "curated")
cte("cl_summary", """
select cluster, count(id_pelicula) as peliculas,
  avg(reproducciones_mensuales) as promedio_reproducciones,
  avg(popularidad_api) as promedio_popularidad,
  avg(votos_promedio_api) as promedio_votos
from cl_banded group by cluster""", "cl_banded")
cte("cl_segments", f"""
select cluster, case
  when promedio_votos < {C.SEGMENT_VOTES_LOW} then '{C.SEGMENT_LOW_RATING}'
  when promedio_popularidad >= {C.SEGMENT_POPULARITY_HIGH} and promedio_reproducciones >= {C.SEGMENT_PLAYS_HIGH}
    then '{C.SEGMENT_GLOBAL_POPULAR}'
  when promedio_reproducciones >= {C.SEGMENT_PLAYS_LOCAL} and promedio_votos >= {C.SEGMENT_VOTES_GOOD}
    then '{C.SEGMENT_LOCAL_CONSOLIDATED}'
  when promedio_reproducciones < {C.SEGMENT_PLAYS_HIGH} and promedio_votos >= {C.SEGMENT_VOTES_GOOD}
    then '{C.SEGMENT_MODERATE}'
  else '{C.SEGMENT_STABLE}' end as segmento_cluster
from cl_summary""", "cl_summary")


def _banded(ctx):
    return ctx.stored_curated.withColumn("cluster", K.popularity_bands(ctx.stored_curated, FIXED_K))


@query("cluster_summary", "A6", with_ctes("""
select cluster, peliculas, round(promedio_reproducciones, 6) as promedio_reproducciones,
  round(promedio_popularidad, 6) as promedio_popularidad, round(promedio_votos, 6) as promedio_votos
from cl_summary""", "cl_summary"))
def cluster_summary(ctx):
    s = K.cluster_summary(_banded(ctx))
    return s.select("cluster", "peliculas",
                    *[F.round(c, 6).alias(c) for c in ("promedio_reproducciones",
                                                       "promedio_popularidad", "promedio_votos")])


@query("segment_labels", "P24 J5", with_ctes("""
select b.id_pelicula, b.cluster, s.segmento_cluster
from cl_banded b left join cl_segments s on s.cluster = b.cluster""", "cl_banded", "cl_segments"))
def segment_labels(ctx):
    return K.with_segments(_banded(ctx)).select("id_pelicula", "cluster", "segmento_cluster")


@query("cluster_distribution", "A7", with_ctes("""
select b.cluster, s.segmento_cluster, count(*) as peliculas
from cl_banded b left join cl_segments s on s.cluster = b.cluster
group by b.cluster, s.segmento_cluster""", "cl_banded", "cl_segments"))
def cluster_distribution(ctx):
    return K.distribution(K.with_segments(_banded(ctx)))


def _model_features(ctx):
    prep = _prep(ctx)
    return K.feature_columns(ctx.stored_curated, prep), K.feature_names(prep)


def _search(ctx):
    return ctx.fitted("kmeans_search", lambda: K.kmeans_search(*_model_features(ctx)))


@query("k_metrics", "M13 M14 M15")
def k_metrics(ctx):
    metrics, _ = _search(ctx)
    return metrics.select("k", "silhouette_score", "inercia")


@query("k_metrics_both", "M15")
def k_metrics_both(ctx):
    # The Euclidean silhouette with its error bound (0: it is from all pairs), and the squared form beside it.
    metrics, _ = _search(ctx)
    return metrics


@query("kmeans_checks", "M13 M16", """
select * from (values ('centro_mas_cercano', true), ('k_grupos', true), ('inercia_recalculada', true),
                      ('mejor_k', true)) t(comprobacion, ok)""")
def kmeans_checks(ctx):
    """What must hold of any search: rows at their nearest centre, k groups, the reported cost, the best k."""
    metrics, models = _search(ctx)
    rows = {r["k"]: r for r in metrics.collect()}
    nearest = groups = cost = True
    feats, names = _model_features(ctx)
    point = F.array(*names)
    feats = feats.select(*names).persist()
    try:
        for k, model in models.items():
            dists = [F.aggregate(F.zip_with(point, F.lit([float(x) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                                 lambda a, x: a + x) for c in model.values]
            own = feats.withColumn("cluster", model.label()).withColumn("d", F.array(*dists))
            r = own.agg(F.count_if(F.get("d", F.col("cluster")) > F.array_min("d") + 1e-9).alias("far"),
                        F.count_distinct("cluster").alias("k"), F.sum(F.array_min("d")).alias("cost")).first()
            nearest &= r["far"] == 0
            groups &= r["k"] == k
            cost &= abs(r["cost"] - rows[k]["inercia"]) <= 1e-6 * max(1.0, r["cost"])
    finally:
        feats.unpersist()
    best = K.best_k(metrics).first()["mejor_k"]
    return _checks(ctx.spark, {"centro_mas_cercano": nearest, "k_grupos": groups, "inercia_recalculada": cost,
                               "mejor_k": rows[best]["silhouette_score"] == max(r["silhouette_score"] for r in rows.values())})


def _segmentation(ctx):
    metrics, models = _search(ctx)
    k = K.best_k(metrics).collect()[0]["mejor_k"]
    return metrics, K.fit_final(ctx.stored_curated, _prep(ctx), k, model=models[k])


@query("model_outputs", "W5 W6 M8", with_ctes("""
select 'predicciones' as archivo, count(*) as filas from ml_split where es_test
union all select 'metricas', 5
union all select 'resultados', count(*) from curated
union all select 'resumen_peliculas', count(*) from curated
union all select 'modelos_releidos', 2""", "ml_split", "curated"))
def model_outputs(ctx):
    # Fit, write every file, read all of it back.
    from pyspark.ml import PipelineModel
    base = ctx.landing("landing", "modelos")
    forest, pred = ctx.fitted("forest", lambda: M.train_and_predict(M.model_frame(ctx.stored_curated)))
    metrics, model = _segmentation(ctx)
    clustered = K.with_segments(model.transform(ctx.stored_curated).select(
        "id_pelicula", "titulo", "reproducciones_mensuales", "popularidad_api", "votos_promedio_api",
        "clasificacion_edad_local", "alerta_accion", "fecha_actualizacion", "cluster"))
    paths = write_classifier(forest, pred, base) | write_segmentation(
        model, metrics, clustered, K.cluster_summary(clustered), base)
    back = {n: ctx.spark.read.option("header", True).option("escape", '"').csv(paths[n])
            for n in ("predicciones", "metricas", "resultados", "resumen")}
    loaded = [PipelineModel.load(paths[n]) for n in ("modelo_clasificador", "modelo_segmentacion")]
    counts = [(n, back[n].count()) for n in ("predicciones", "metricas", "resultados")]
    counts.append(("resumen_peliculas", back["resumen"].agg(F.sum(F.col("peliculas").cast("bigint"))).first()[0]))
    counts.append(("modelos_releidos", sum(len(m.stages) > 0 for m in loaded)))
    return ctx.spark.createDataFrame(counts, "archivo string, filas bigint")


@query("kmeans_clusters", "M16 P24 J5")
def kmeans_clusters(ctx):
    _, model = _segmentation(ctx)
    clustered = model.transform(ctx.stored_curated).select(
        "id_pelicula", "titulo", "reproducciones_mensuales", "popularidad_api", "votos_promedio_api",
        "clasificacion_edad_local", "alerta_accion", "fecha_actualizacion", "cluster")
    return K.with_segments(clustered)
