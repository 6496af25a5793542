"""Unsupervised segmentation: imputed/standardised features, KMeans over k,
cluster metrics, cluster summary and named segments.

The preprocessing statistics (median, mean, population std, mode) are exact
and computed with distributed aggregations; the fitted transformation is a
``SQLTransformer`` statement, so the whole fitted pipeline persists as a
standard ``PipelineModel``. Cluster metrics use per-cluster sufficient
statistics (count, feature sums, squared-norm sums) and never pair points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import config as C
from marquee.functions.guards import require_columns
from marquee.operators.kmeans import Centres, best_per_k
from marquee.operators.silhouette import silhouettes
from marquee.operators.stats import exact_quantiles

NUMERIC = ("reproducciones_mensuales", "popularidad_api", "votos_promedio_api")
CLASS_COL = "clasificacion_edad_local"
KEY = "id_pelicula"


def z_name(c: str) -> str:
    return f"z_{c}"


def onehot_name(level: str) -> str:
    return f"{CLASS_COL}_{level}"


@dataclass(frozen=True)
class ClusterPrep:
    """Fitted preprocessing: per numeric column (median, mean, std); class mode and levels."""

    median: dict
    mean: dict
    std: dict
    mode: str | None
    levels: tuple

    def sql(self) -> str:
        """The fitted transformation as one SQL statement over ``__THIS__``."""
        def lit(v):
            return "CAST(NULL AS DOUBLE)" if v is None else repr(float(v))
        cols = []
        for c in NUMERIC:
            std = self.std[c] if self.std[c] else 1.0
            cols.append(f"(coalesce(CAST({c} AS DOUBLE), {lit(self.median[c])}) - {lit(self.mean[c])})"
                        f" / {lit(std)} AS {z_name(c)}")
        mode = "NULL" if self.mode is None else "'" + self.mode.replace("'", "''") + "'"
        cols.append(f"coalesce({CLASS_COL}, {mode}) AS clase_imputada")
        return f"SELECT *, {', '.join(cols)} FROM __THIS__"


def fit_preprocessing(df: DataFrame, cfg: C.CatalogConfig = C.DEFAULT_CONFIG) -> ClusterPrep:
    """Exact statistics for the preprocessing, from distributed aggregations.

    The four input columns are cached for the few selection passes of the
    exact medians and released afterwards.
    """
    require_columns(df, (*NUMERIC, CLASS_COL), "curated table")
    cols = df.select(*NUMERIC, CLASS_COL).persist()
    try:
        med = exact_quantiles(cols, NUMERIC, 0.5)
        imputed = {c: F.coalesce(F.col(c).cast("double"), F.lit(med[c])) for c in NUMERIC}
        aggs = []
        for c in NUMERIC:
            aggs += [F.avg(imputed[c]).alias(f"m_{c}"), F.stddev_pop(imputed[c]).alias(f"s_{c}")]
        row = cols.agg(*aggs).collect()[0]
        # One bounded pass gives the class counts: the mode (ties -> smallest
        # level) and the levels after imputing it (the non-null levels).
        counts = (cols.where(F.col(CLASS_COL).isNotNull()).groupBy(CLASS_COL)
                  .agg(F.count(F.lit(1)).alias("_n")).limit(cfg.max_class_levels + 1).collect())
    finally:
        cols.unpersist()
    if len(counts) > cfg.max_class_levels:
        raise ValueError(f"{CLASS_COL} has more than {cfg.max_class_levels} levels")
    mode = min(counts, key=lambda r: (-r["_n"], r[CLASS_COL]))[CLASS_COL] if counts else None
    levels = sorted(r[CLASS_COL] for r in counts)
    return ClusterPrep(med, {c: row[f"m_{c}"] for c in NUMERIC}, {c: row[f"s_{c}"] for c in NUMERIC},
                       mode, tuple(levels))


def preprocessing_stages(prep: ClusterPrep) -> list:
    """SQL imputation/scaling, class index (unknown kept then dropped), one-hot, assembler."""
    return [
        SQLTransformer(statement=prep.sql()),
        StringIndexer(inputCol="clase_imputada", outputCol="_clase_idx", handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=["_clase_idx"], outputCols=["_clase_vec"], dropLast=True),
        VectorAssembler(inputCols=[*[z_name(c) for c in NUMERIC], "_clase_vec"], outputCol="features"),
    ]


def feature_columns(df: DataFrame, prep: ClusterPrep, keep: tuple[str, ...] = ()) -> DataFrame:
    """Preprocessed features as plain columns: id, three z-scores, one 0/1 column per level
    (plus the ``keep`` columns of ``df``)."""
    t = SQLTransformer(statement=prep.sql()).transform(df)
    return t.select(KEY, *keep, *[F.col(z_name(c)) for c in NUMERIC],
                    *[(F.col("clase_imputada") == F.lit(v)).cast("double").alias(onehot_name(v))
                      for v in prep.levels])


def feature_names(prep: ClusterPrep) -> list[str]:
    return [*[z_name(c) for c in NUMERIC], *[onehot_name(v) for v in prep.levels]]


# -- metrics from per-cluster statistics ------------------------------------------------

def cluster_stats(features: DataFrame, names: list[str], label: str = "cluster",
                  max_clusters: int = 1000) -> list[dict]:
    """Per cluster: count, feature sums and squared-norm sum (k rows to the driver; pass a larger k if need be)."""
    sq = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))
    rows = (features.groupBy(label)
            .agg(F.count(F.lit(1)).alias("_n"), F.sum(sq).alias("_q"),
                 *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(names)])
            .limit(max_clusters + 1).collect())
    if len(rows) > max_clusters:
        raise ValueError(f"{label} has more than {max_clusters} values")
    return [{"c": r[label], "n": r["_n"], "q": r["_q"],
             "s": [r[f"_s{i}"] for i in range(len(names))]} for r in rows]


def many_cluster_stats(features: DataFrame, names: list[str], labels: list[str],
                       max_clusters: int = 1000) -> dict[str, list[dict]]:
    """``cluster_stats`` of several labellings in one aggregation (a row per labelling and cluster)."""
    sq = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))
    tall = features.select(*names, F.explode(F.array(*[
        F.struct(F.lit(x).alias("by"), F.col(x).alias("c")) for x in labels])).alias("l"))
    rows = (tall.groupBy("l.by", "l.c").agg(F.count(F.lit(1)).alias("_n"), F.sum(sq).alias("_q"),
                                            *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(names)])
            .limit(max_clusters * len(labels) + 1).collect())
    if len(rows) > max_clusters * len(labels):
        raise ValueError(f"more than {max_clusters} clusters in a labelling")
    return {x: [{"c": r["c"], "n": r["_n"], "q": r["_q"], "s": [r[f"_s{i}"] for i in range(len(names))]}
                for r in rows if r["by"] == x] for x in labels}


def many_cluster_metrics(features: DataFrame, names: list[str], labels: list[str]) -> dict[str, tuple[float, float]]:
    """(silhouette, inertia) of several labellings: one statistics pass and one aggregation for all."""
    stats = many_cluster_stats(features, names, labels)
    row = features.agg(*[e for i, x in enumerate(labels) for e in (
        F.avg(_silhouette_expr(names, stats[x], x)).alias(f"s{i}"),
        F.sum(_inertia_expr(names, stats[x], x)).alias(f"i{i}"))]).collect()[0]
    return {x: (row[f"s{i}"], row[f"i{i}"]) for i, x in enumerate(labels)}


def _mean_sq_dist(names: list[str], st: dict) -> Column:
    """Mean squared distance from each row to the points of one cluster."""
    n = float(st["n"])
    sq = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))
    dot = sum((F.col(c) * F.lit(s / n) for c, s in zip(names, st["s"])), F.lit(0.0))
    return sq + F.lit(st["q"] / n) - F.lit(2.0) * dot


def _silhouette_expr(names: list[str], stats: list[dict], label: str) -> Column:
    """Per-row silhouette (squared Euclidean) from the k cluster statistics."""
    if len(stats) < 2:
        raise ValueError("silhouette needs at least two clusters")
    lab = F.col(label)
    d = {st["c"]: _mean_sq_dist(names, st) for st in stats}
    own_n = F.lit(None).cast("double")
    a = F.lit(None).cast("double")
    for st in stats:
        own_n = F.when(lab == st["c"], F.lit(float(st["n"]))).otherwise(own_n)
        a = F.when(lab == st["c"], d[st["c"]] * F.lit(st["n"] / max(st["n"] - 1, 1))).otherwise(a)
    b = None
    for st in stats:
        other = F.when(lab != st["c"], d[st["c"]])
        b = other if b is None else F.least(b, other)
    return (F.when(own_n <= 1, F.lit(0.0))
             .when(a < b, F.lit(1.0) - a / b)
             .when(a > b, b / a - F.lit(1.0))
             .otherwise(F.lit(0.0)))


def _inertia_expr(names: list[str], stats: list[dict], label: str) -> Column:
    """Per-row squared distance to the row's cluster mean."""
    lab = F.col(label)
    dist = F.lit(None).cast("double")
    for st in stats:
        n = float(st["n"])
        e = sum(((F.col(c) - F.lit(s / n)) ** 2 for c, s in zip(names, st["s"])), F.lit(0.0))
        dist = F.when(lab == st["c"], e).otherwise(dist)
    return dist


def silhouette_sq(features: DataFrame, names: list[str], label: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance (Spark's definition):
    a = own-cluster mean distance excluding the point, b = nearest other
    cluster; singletons score 0. Linear in the rows: the k cluster
    statistics enter the per-row expression as literals."""
    stats = cluster_stats(features, names, label)
    return features.agg(F.avg(_silhouette_expr(names, stats, label)).alias("silhouette_score"))


def inertia(features: DataFrame, names: list[str], label: str = "cluster") -> DataFrame:
    """Sum of squared distances to the assigned cluster mean."""
    stats = cluster_stats(features, names, label)
    return features.agg(F.sum(_inertia_expr(names, stats, label)).alias("inercia"))


def cluster_metrics(features: DataFrame, names: list[str], label: str = "cluster") -> DataFrame:
    """Silhouette and inertia together: one statistics pass, one aggregation."""
    stats = cluster_stats(features, names, label)
    return features.agg(F.avg(_silhouette_expr(names, stats, label)).alias("silhouette_score"),
                        F.sum(_inertia_expr(names, stats, label)).alias("inercia"))


def popularity_bands(df: DataFrame, k: int) -> Column:
    """A fixed k-way labelling (popularity bands over [0, 200)) used to exercise
    the cluster metrics and summaries deterministically."""
    p = F.coalesce(F.col("popularidad_api").cast("double"), F.lit(0.0))
    return F.least(F.lit(k - 1), F.greatest(F.lit(0), F.floor(p * k / 200).cast("int"))).cast("int")


# -- KMeans search and final model --------------------------------------------------------

def kmeans_search(features: DataFrame, names: list[str], ks=C.K_RANGE, restarts: int = C.KMEANS_RESTARTS,
                  seed: int = C.SEED, key: str = KEY) -> tuple[DataFrame, dict[int, Centres]]:
    """For each k: the lowest-cost model over ``restarts`` seedings, its silhouettes and cost.

    Returns (metrics frame, {k: model}). ``features`` has ``key`` and the feature
    columns ``names``; it is cached for the search, whose models all advance in
    the same passes (``kmeans``). ``silhouette_score`` is Euclidean, from all pairs
    (``silhouette``), so ``silhouette_error`` is 0; ``silhouette_cuadrada`` is the squared form.
    """
    features = features.select(key, *names).persist()
    try:
        models = best_per_k(features.select(*names), ks, restarts, seed, C.DEFAULT_CONFIG.kmeans_iterations)
        labels = {k: f"c{k}" for k in models}
        labelled = features.select(key, *names, *[m.label().alias(labels[k]) for k, m in models.items()])
        euclid = silhouettes(labelled, names, list(labels.values()), key)
        square = many_cluster_metrics(labelled, names, list(labels.values()))
    finally:
        features.unpersist()
    rows = [(k, *euclid[x], square[x][0], models[k].cost) for k, x in labels.items()]
    metrics = features.sparkSession.createDataFrame(
        rows, "k int, silhouette_score double, silhouette_error double, silhouette_cuadrada double, inercia double")
    return metrics, models


def best_k(metrics: DataFrame) -> DataFrame:
    """k with the highest silhouette (ties: smaller k)."""
    return metrics.orderBy(F.desc("silhouette_score"), F.asc("k")).limit(1).select(
        F.col("k").alias("mejor_k"), "silhouette_score")


def cluster_stage(model: Centres, prep: ClusterPrep) -> SQLTransformer:
    """The nearest centre as a pipeline stage over the preprocessed columns: one SQL statement, so it persists."""
    columns = [*[z_name(c) for c in NUMERIC],
               *["(CASE WHEN clase_imputada = '" + v.replace("'", "''") + "' THEN 1D ELSE 0D END)" for v in prep.levels]]
    dist = ", ".join(" + ".join(f"power({c} - ({float(x)!r}D), 2)" for c, x in zip(columns, row)) for row in model.values)
    return SQLTransformer(statement=(
        f"SELECT * EXCEPT (_d), CAST(array_position(_d, array_min(_d)) - 1 AS INT) AS cluster FROM "
        f"(SELECT *, array({dist}) AS _d FROM __THIS__)"))


def fit_final(df: DataFrame, prep: ClusterPrep, k: int, restarts: int = C.KMEANS_RESTARTS,
              seed: int = C.SEED, model: Centres | None = None) -> PipelineModel:
    """Preprocessing and the nearest of k centres, best of ``restarts`` seedings, as one PipelineModel.

    ``model`` is the search's model for k, if there was a search: the same fits
    need not run again.
    """
    pre = Pipeline(stages=preprocessing_stages(prep)).fit(df)
    if model is None:
        names = feature_names(prep)
        rows = feature_columns(df, prep).select(*names).persist()
        try:
            model = best_per_k(rows, [k], restarts, seed, C.DEFAULT_CONFIG.kmeans_iterations)[k]
        finally:
            rows.unpersist()
    return PipelineModel(stages=[*pre.stages, cluster_stage(model, prep)])


# -- summaries and segment names --------------------------------------------------------------

def cluster_summary(clustered: DataFrame, label: str = "cluster") -> DataFrame:
    """Films and mean plays / popularity / votes per cluster (means skip nulls)."""
    return clustered.groupBy(label).agg(
        F.count(KEY).alias("peliculas"),
        F.avg("reproducciones_mensuales").alias("promedio_reproducciones"),
        F.avg("popularidad_api").alias("promedio_popularidad"),
        F.avg("votos_promedio_api").alias("promedio_votos"),
    )


def segment_expr(plays: Column, popularity: Column, votes: Column) -> Column:
    """Segment name from cluster means, first matching branch wins."""
    return (F.when(votes < C.SEGMENT_VOTES_LOW, F.lit(C.SEGMENT_LOW_RATING))
            .when((popularity >= C.SEGMENT_POPULARITY_HIGH) & (plays >= C.SEGMENT_PLAYS_HIGH),
                  F.lit(C.SEGMENT_GLOBAL_POPULAR))
            .when((plays >= C.SEGMENT_PLAYS_LOCAL) & (votes >= C.SEGMENT_VOTES_GOOD),
                  F.lit(C.SEGMENT_LOCAL_CONSOLIDATED))
            .when((plays < C.SEGMENT_PLAYS_HIGH) & (votes >= C.SEGMENT_VOTES_GOOD),
                  F.lit(C.SEGMENT_MODERATE))
            .otherwise(F.lit(C.SEGMENT_STABLE)))


def segment_names(summary: DataFrame, label: str = "cluster") -> DataFrame:
    return summary.select(label, segment_expr(F.col("promedio_reproducciones"),
                                              F.col("promedio_popularidad"),
                                              F.col("promedio_votos")).alias("segmento_cluster"))


def with_segments(clustered: DataFrame, label: str = "cluster", max_clusters: int = 1000) -> DataFrame:
    """Attach the segment name; the k names enter the expression as literals."""
    rows = segment_names(cluster_summary(clustered, label), label).limit(max_clusters + 1).collect()
    if len(rows) > max_clusters:
        raise ValueError(f"{label} has more than {max_clusters} values")
    name = F.lit(None).cast("string")
    for r in rows:
        name = F.when(F.col(label).eqNullSafe(F.lit(r[label])), F.lit(r["segmento_cluster"])).otherwise(name)
    return clustered.withColumn("segmento_cluster", name)


def distribution(segmented: DataFrame, label: str = "cluster") -> DataFrame:
    return segmented.groupBy(label, "segmento_cluster").agg(F.count(F.lit(1)).alias("peliculas"))
