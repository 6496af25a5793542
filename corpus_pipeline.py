"""A training corpus in five stages, each one operator over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import held_out_fold, prepare
from marquee.llm.decontaminate import drop_contaminated
from marquee.llm.line_dedup import dedup_lines
from marquee.llm.mixing import mix_report
from marquee.llm.simhash import drop_near_duplicates
from marquee.llm.toxicity import drop_toxic, fit_toxicity
from marquee.session import scratch_path
from marquee.storage import hold, remove_older

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the classifier learns from the given documents and their labels."""
    prepare(spark)
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"), ~held_out_fold(F.col("doc_id"), 5, 0))
    return drop_toxic(docs, model).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; documents stay, if with less text."""
    prepare(spark)
    kept = dedup_lines(docs, min_docs=10, min_chars=1)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    prepare(spark)
    return mix_report(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]

# Learned scores, XXH64 and connected components are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written to the shared folder and read back as the next one's documents."""
    docs = _table(spark, sf_dir, "documents")
    remove_older(spark, scratch_path(spark, "pipeline"))
    folder = hold(spark, scratch_path(spark, "pipeline", unique=True))
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
