"""Supervised model: which films need a priority action (weighted random forest)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.config import DEFAULT_CONFIG, RF_TREES, SEED, TEST_SHARE, UNKNOWN_CLASS, CatalogConfig
from marquee.functions.guards import require_columns

NUMERIC_FEATURES = ("popularidad_api", "votos_promedio_api", "reproducciones_mensuales")
CLASS_COL = "clasificacion_edad_local"
LABEL = "objetivo"
KEY = "id_pelicula"


def with_target(curated: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """``objetivo`` = 1 when the alert is one of the priority actions."""
    return curated.withColumn(LABEL, F.coalesce(F.col("alerta_accion").isin(*cfg.priority_actions),
                                                F.lit(False)).cast("int"))


def model_frame(curated: DataFrame, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """id, target, numeric features (invalid/missing -> 0) and the class (missing -> 'desconocido')."""
    require_columns(curated, (*NUMERIC_FEATURES, CLASS_COL, "alerta_accion"), "curated table")
    t = with_target(curated, cfg)
    return t.select(
        KEY, LABEL,
        *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in NUMERIC_FEATURES],
        F.coalesce(F.col(CLASS_COL), F.lit(UNKNOWN_CLASS)).alias(CLASS_COL),
    )


def class_levels(df: DataFrame, col: str = CLASS_COL, cfg: CatalogConfig = DEFAULT_CONFIG) -> list[str]:
    """Distinct levels, sorted; more than ``cfg.max_class_levels`` is an error, as the list is held on the driver."""
    rows = df.select(col).distinct().limit(cfg.max_class_levels + 1).collect()
    if len(rows) > cfg.max_class_levels:
        raise ValueError(f"{col} has more than {cfg.max_class_levels} levels")
    return sorted(r[0] for r in rows)


def dummy_columns(df: DataFrame, levels: list[str], col: str = CLASS_COL,
                  drop_first: bool = True) -> DataFrame:
    """One 0/1 column per level (``<col>_<level>``), optionally without the first level."""
    keep = levels[1:] if drop_first else levels
    dummies = [(F.col(col) == F.lit(v)).cast("int").alias(f"{col}_{v}") for v in keep]
    return df.select(*[c for c in df.columns if c != col], *dummies)


# -- deterministic stratified split ---------------------------------------------

def split_hash(key: Column, seed: int = SEED) -> Column:
    """32-bit integer mix of a bigint key (the same arithmetic runs in SQL)."""
    m = 4294967296
    x = F.pmod(F.pmod(key, F.lit(m)) + F.lit(seed), F.lit(m))
    for _ in range(2):
        x = x.bitwiseXOR(F.shiftright(x, 16))
        x = F.pmod(x * F.lit(73244475), F.lit(m))
    return x.bitwiseXOR(F.shiftright(x, 16))


def stratified_split(df: DataFrame, label: str = LABEL, key: str = KEY,
                     test_share: float = TEST_SHARE, seed: int = SEED,
                     bucket_bits: int = 16, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """Add ``es_test``: per class, the ``ceil(test_share * n_class)`` rows first
    by (hash(key), key) form the test set — an exact stratified split.

    Every row comes back: a null label is a class of its own, and null keys come
    last in their class. No window spans a whole class: the boundary is located
    on a per-class histogram of 2**bucket_bits hash buckets, of which one row
    per class (at most ``cfg.max_class_levels``) becomes literals; only each
    class's boundary bucket is ranked row by row.
    """
    top = 1 << 32
    h = F.coalesce(split_hash(F.col(key), seed), F.lit(top))
    d = df.withColumn("_h", h).withColumn("_b", F.shiftright(F.col("_h"), 32 - bucket_bits))
    hist = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    hist = (hist.withColumn("_cum", F.sum("_n").over(running))
                .withColumn("_q", F.ceil(F.sum("_n").over(Window.partitionBy(label)) * F.lit(test_share))))
    edges = (hist.where((F.col("_cum") - F.col("_n") < F.col("_q")) & (F.col("_cum") >= F.col("_q")))
             .select(label, "_b", (F.col("_q") - (F.col("_cum") - F.col("_n"))).alias("_r"))
             .limit(cfg.max_class_levels + 1).collect())
    if len(edges) > cfg.max_class_levels:
        raise ValueError(f"{label} has more than {cfg.max_class_levels} classes")
    bstar, quota = F.lit(-1).cast("long"), F.lit(0).cast("long")  # a class without test rows
    for e in edges:
        own = F.col(label).eqNullSafe(F.lit(e[label]))
        bstar = F.when(own, F.lit(e["_b"]).cast("long")).otherwise(bstar)
        quota = F.when(own, F.lit(e["_r"]).cast("long")).otherwise(quota)
    d = d.withColumn("_e", F.col("_b") - bstar).withColumn("_r", quota)
    rank = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    edge = d.where("_e = 0").withColumn("es_test", rank <= F.col("_r"))
    rest = d.where("_e <> 0").withColumn("es_test", F.col("_e") < 0)
    return rest.unionByName(edge).drop("_h", "_b", "_e", "_r")


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (k * n_class) over the training rows (one row per class)."""
    per_class = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # The un-keyed windows run over the per-class counts: one row per class.
    k = F.count(F.lit(1)).over(Window.partitionBy())
    total = F.sum("n").over(Window.partitionBy())
    return per_class.select(label, "n", (total.cast("double") / (k * F.col("n"))).alias("peso"))


def weighted(train: DataFrame, label: str = LABEL, cfg: CatalogConfig = DEFAULT_CONFIG) -> DataFrame:
    """Attach the class weight; the weights (one per class) enter the expression as literals."""
    rows = class_weights(train, label).limit(cfg.max_class_levels + 1).collect()
    if len(rows) > cfg.max_class_levels:
        raise ValueError(f"{label} has more than {cfg.max_class_levels} classes")
    weight = F.lit(None).cast("double")
    for r in rows:
        weight = F.when(F.col(label).eqNullSafe(F.lit(r[label])), F.lit(r["peso"])).otherwise(weight)
    return train.withColumn("peso", weight)


# -- model ------------------------------------------------------------------------

def forest_pipeline(levels: list[str], num_trees: int = RF_TREES, max_depth: int = DEFAULT_CONFIG.forest_depth,
                    seed: int = SEED) -> Pipeline:
    """Class one-hot (first level alphabetically dropped) + numeric features -> forest.

    ``levels`` are the classes of the whole frame, so a class that only the test
    rows have is known to the encoder. Each row's node ids are kept on the
    executors: without them every task of a level carries all trees so far,
    packed by the driver, which deep trees soon fill.
    """
    indexer = StringIndexerModel.from_labels(sorted(levels, reverse=True), inputCol=CLASS_COL,
                                             outputCol="_clase_idx", handleInvalid="error")
    onehot = OneHotEncoder(inputCols=["_clase_idx"], outputCols=["_clase_vec"], dropLast=True)
    assemble = VectorAssembler(inputCols=[*NUMERIC_FEATURES, "_clase_vec"], outputCol="features")
    forest = RandomForestClassifier(labelCol=LABEL, featuresCol="features", weightCol="peso",
                                    numTrees=num_trees, maxDepth=max_depth,
                                    featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True)
    return Pipeline(stages=[indexer, onehot, assemble, forest])


def without_summaries(model: PipelineModel) -> PipelineModel:
    """The fitted pipeline with each stage copied, which drops training summaries.

    A fitted model keeps its training summary (predictions frame, session);
    the summary would otherwise travel inside every task closure of
    ``transform``.
    """
    return PipelineModel(stages=[st.copy() if getattr(st, "hasSummary", False) else st
                                 for st in model.stages])


def for_levels(train: DataFrame, rows_per_partition: int = 500_000, spare: int = 4) -> DataFrame:
    """The same rows in about as many partitions as there are cores, where there are far more.

    On every level of the trees each partition, however few its rows, sends the
    statistics of all open nodes through the shuffle. The split leaves most of
    its partitions (those of the boundary buckets) nearly empty. Partitions hold
    up to ``rows_per_partition`` rows, and rows are in a stated order, as the
    bootstrap draws by position.
    """
    most = max(train.sparkSession.sparkContext.defaultParallelism, -(-train.count() // rows_per_partition))
    if train.rdd.getNumPartitions() <= spare * most:
        return train
    return train.repartition(most).sortWithinPartitions(*train.columns)


def train_and_predict(frame: DataFrame, num_trees: int = RF_TREES, max_depth: int | None = None,
                      seed: int = SEED, cfg: CatalogConfig = DEFAULT_CONFIG) -> tuple[PipelineModel, DataFrame]:
    """Split, weight, fit on train, predict test -> (model, (id, y_real, y_pred)).

    The training rows are cached while the stages are fitted, so the split runs once.
    They are dealt for the forest's passes (``for_levels``) and then cached as dealt.
    """
    split = stratified_split(frame, seed=seed, cfg=cfg)
    levels = class_levels(frame, cfg=cfg)
    train = weighted(split.where(~F.col("es_test")), cfg=cfg).persist()
    dealt = train
    try:
        dealt = for_levels(train).persist()
        model = without_summaries(forest_pipeline(levels, num_trees, max_depth or cfg.forest_depth, seed).fit(dealt))
    finally:
        dealt.unpersist()
        train.unpersist()
    pred = model.transform(split.where(F.col("es_test"))).select(
        KEY, F.col(LABEL).alias("y_real"), F.col("prediction").cast("int").alias("y_pred"))
    return model, pred


# -- evaluation ------------------------------------------------------------------------

def confusion(pred: DataFrame) -> DataFrame:
    return pred.groupBy("y_real", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def accuracy(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.avg((F.col("y_real") == F.col("y_pred")).cast("double")).alias("accuracy"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def classification_report(pred: DataFrame, labels: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and weighted means (0/0 -> 0)."""
    y, p = F.col("y_real"), F.col("y_pred")
    aggs = []
    for c in labels:
        aggs += [F.count_if((y == c) & (p == c)).alias(f"tp{c}"),
                 F.count_if(p == c).alias(f"pp{c}"),
                 F.count_if(y == c).alias(f"s{c}")]
    wide = pred.agg(*aggs)
    per_class = None
    for c in labels:
        prec = _ratio(F.col(f"tp{c}"), F.col(f"pp{c}"))
        rec = _ratio(F.col(f"tp{c}"), F.col(f"s{c}"))
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
        row = wide.select(F.lit(str(c)).alias("clase"), prec.alias("precision"), rec.alias("recall"),
                          f1.alias("f1"), F.col(f"s{c}").alias("support"))
        per_class = row if per_class is None else per_class.unionByName(row)
    means = per_class.agg(
        F.lit("macro avg").alias("clase"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted_means = per_class.agg(
        F.lit("weighted avg").alias("clase"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.sum("support").alias("support"))
    return per_class.unionByName(means).unionByName(weighted_means)
