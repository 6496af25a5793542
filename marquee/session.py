"""Session helpers: a local builder for tests/bench and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC wall-clock, ANSI casts (we always
# use try_cast / try_to_date), AQE with skew-join splitting and coalescing.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash aggregation of collected sets falls back to sorting beyond this many
    # keys a task; the default of 128 makes every per-film consolidation sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "200000",
}


# Local runs only. The test tables are a few MB, so AQE's default 1 MB floor
# coalesces a shuffle into one or two tasks, and the per-row cleaning after
# it (regexes, date parsing) then runs on one core. A 64 KB floor keeps every
# core busy. On a cluster the shuffles are large and the defaults hold.
# Python call-site capture for error messages costs four extra JVM round
# trips per DataFrame/function call while a plan is being built (about a
# third of the driver-side build time of the ETL plans); it is off here.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "marquee", extra: dict | None = None) -> SparkSession:
    """SparkSession for tests and the benchmark (UI off, no servers)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing (cluster) session."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The setting is read, not invented. Where it is unset, a folder in the
    warehouse serves, unless the session runs on several machines and the
    warehouse is a folder of one of them: then this is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        if not sc.master.startswith("local") and root.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (for landed files, table versions)."""
    pieces = [checkpoint_root(spark), "marquee", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex)
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))
