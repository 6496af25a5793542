"""The registered queries of this package: thin applications of the operators to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.chat import format_chats
from marquee.llm.common import held_out_fold, prepare
from marquee.llm.decontaminate import contamination_report
from marquee.llm.line_dedup import dedup_lines
from marquee.llm.minhash import edit_report
from marquee.llm.mixing import mix_report
from marquee.llm.oracle import ORACLES
from marquee.llm.phrases import mine_phrases
from marquee.llm.prefix_trie import prefix_trie, share_openings, turn_sequences
from marquee.llm.quality import score_quality
from marquee.llm.simhash import hex_fingerprint, near_duplicates
from marquee.llm.topk import top_k
from marquee.llm.toxicity import fit_toxicity, score_toxicity
from marquee.llm.url_filter import Rule, judge_urls
from marquee.llm.warc import archive_folder, page_of, read_warc, write_warc

RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def op1_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    held_out = held_out_fold(F.col("doc_id"), 5, 0)
    model = fit_toxicity(docs, labels, ~held_out)
    return score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix_report(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"),
        F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    folder = archive_folder(spark)
    write_warc(pages, folder)
    return read_warc(spark, folder, payloads=False).select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of(F.col("refers_to")).alias("refers_to"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page outcomes come from the labels of the same number: bad where quality is 0 or toxic is 1."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    outcomes = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").select(
        F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge_urls(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    held_out = held_out_fold(F.col("doc_id"), 4, 2)
    return score_quality(docs, labels, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark", "item_id", "text")
    return contamination_report(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs).select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents", "text", "lang"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_sequences(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    nodes = prefix_trie(share_openings(turns, every=20, spread=4))
    return nodes.withColumn("depth", F.col("depth").cast("long"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_kdtree_topk, op2_toxicity, op3_mixing, op4_line_dedup, op5_warc, op6_url_filter,
                                    op7_chat_format, op8_quality, op9_decontamination, op10_simhash, op11_phrases,
                                    op12_prefix_trie, op13_minhash)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
