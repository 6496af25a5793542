"""The pipeline against the plain versions of its stages."""

from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm.common import held_out_fold
from marquee.llm.toxicity import fit_toxicity, score_toxicity
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.cases import awkward_docs, docs_frame, empty_docs


def expected(spark, docs, labels, items):
    """(doc_id, size) left after the first four stages; the toxicity scores are the classifier's own."""
    model = fit_toxicity(docs, labels, ~held_out_fold(F.col("doc_id"), 5, 0))
    toxic = {(r.doc_id, r.text_hash) for r in score_toxicity(docs, model).filter("score >= 0.5").collect()}
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows = [(r.doc_id, r.text) for r in rows if (r.doc_id, r.h) not in toxic]
    rows = [(i, kept) for i, _, _, kept in brute.line_dedup(rows)]
    rows = [r for r, (_, c) in zip(rows, brute.simhash_components(rows)) if r[0] is None or r[0] == c]
    hit = brute.contamination(rows, items)
    return sorted((i, len(t.split())) for (i, t), h in zip(rows, hit) if not h[2])


def test_run_matches_plain_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = corpus_pipeline.run(spark, SF001)
    assert sorted((r.doc_id, r.size) for r in got.collect()) == expected(spark, docs, labels, items)
    assert got.filter("taken > 3 * size").count() == 0


def test_stages_keep_the_columns_of_documents(spark):
    for docs in (docs_frame(spark, [r for r in awkward_docs() if r[0] is not None]), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF001)
            assert out.columns == list(corpus_pipeline.COLUMNS), name
            assert out.count() <= docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
