"""Learned operators: held-out accuracy, awkward rows, missing classes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import quality, toxicity
from marquee.llm.common import held_out_fold
from marquee.llm.queries import queries
from tests.llm.cases import awkward_docs, docs_frame, empty_docs

SF01 = "/root/testdata/sf0.01"


def accuracy(spark, name, column):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", column)
    rows = queries()[name](spark, SF01).join(labels, "doc_id").filter("held_out").collect()
    return np.mean([r.predicted == r[column] for r in rows]), len(rows)


@pytest.mark.parametrize("name,column,least", [("op2_toxicity", "toxic", 0.93), ("op8_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, column, least):
    got, n = accuracy(spark, name, column)
    assert n > 50 and got >= least


def test_scores_cover_every_row(spark):
    out = queries()["op2_toxicity"](spark, SF01)
    assert out.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert out.filter("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_folds(spark):
    import zlib

    rows = spark.range(50).select("id", held_out_fold(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


LABELS = "doc_id long, quality int, toxic int, features string"


def test_toxicity_awkward_rows_and_missing_classes(spark):
    docs = docs_frame(spark)
    everyone = F.lit(True)
    for rows in ([], [(1, 1, 0, "x"), (2, 0, 0, "x")], [(1, 1, 1, "x")], [(1, None, None, "x"), (None, 1, 1, "x")]):
        model = toxicity.fit_toxicity(docs, spark.createDataFrame(rows, LABELS), everyone)
        scores = toxicity.score_toxicity(docs, model).collect()
        assert len(scores) == len(awkward_docs()) and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.score_toxicity(empty_docs(spark), model).count() == 0
    model = toxicity.fit_toxicity(empty_docs(spark), spark.createDataFrame([(1, 1, 1, ""), (2, 1, 0, "")], LABELS), everyone)
    assert toxicity.score_toxicity(empty_docs(spark), model).count() == 0


def test_toxicity_learns_planted_words_and_keeps_columns(spark):
    rows = [(k, ("fine words about gardens and rain " * 8) + ("blightword vilething " * 3 if k % 5 == 0 else ""), "a") for k in range(200)]
    labels = spark.createDataFrame([(k, 1, int(k % 5 == 0), "") for k in range(0, 200, 2)], LABELS)
    docs = docs_frame(spark, rows)
    kept = toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, labels, F.lit(True)))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(200) if k % 5]


def test_toxicity_sample_counts_documents_not_rows(spark):
    rows = [(k, f"text {k}", "a") for k in range(100)] * 2 + [(7, f"other {k}", "a") for k in range(300)]
    labels = spark.createDataFrame([(k, 1, 1, "") for k in range(0, 100, 10)], LABELS)
    p = toxicity.ToxicParams(max_positive=5, max_unlabelled=20, bags=2)
    got = toxicity.training_sample(docs_frame(spark, rows), labels, F.lit(True), p).collect()
    assert len({r.text for r in got if not r.positive}) == sum(not r.positive for r in got) == 40
    assert sorted(r.bag for r in got if r.positive) == [0] * 5 + [1] * 5
    p = toxicity.ToxicParams(max_positive=100, max_unlabelled=100, bags=2)
    got = toxicity.training_sample(docs_frame(spark, rows), labels, F.lit(True), p).collect()
    assert len(got) == 120 and len({r.text for r in got}) == 100


def test_toxicity_learns_rare_words_from_many_positives():
    """A word of 1 % of the positives, ten times rarer elsewhere, is kept; a word of everyone and a single hit are not."""
    def row(k, every, more=()):
        f = np.array(sorted({1, *((2,) if every and k % every == 0 else ()), *more}), np.int32)
        return f, np.ones(len(f), np.int64), 1.0

    pos = [row(k, 100, (9,) if k == 5 else ()) for k in range(3000)]
    unl = [row(k, 1000) for k in range(4000)]
    chosen, by_count = toxicity.chosen_features(pos, unl, 0.1, toxicity.ToxicParams())
    assert chosen.tolist() == [2] and by_count.tolist() == [True]


def test_nnpu_turns_round_on_negative_clean_risk():
    """With few unlabelled rows the plain estimate would go below zero; weights stay finite and positives on top."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 20)).astype(np.float32)
    xp, xu = np.c_[x[:20] + 1, np.ones(20, np.float32)], np.c_[x[20:], np.ones(20, np.float32)]
    w = toxicity.fit_nnpu(xp, xu, 0.3, 300, 0.1, 1e-4)
    assert np.isfinite(w).all() and (xp @ w).mean() > (xu @ w).mean()


def test_quality_awkward_rows_and_missing_classes(spark):
    docs = docs_frame(spark)
    for rows, want in (([], 0.5), ([(1, 1, 0, "x")], 1.0), ([(1, 0, 0, "x")], 0.0), ([(None, 0, 0, ""), (1, None, 0, "")], 0.5)):
        scores = quality.score_quality(docs, spark.createDataFrame(rows, LABELS), F.lit(True)).collect()
        assert len(scores) == len(awkward_docs()) and {r.score for r in scores} == {want}
    rows = [(k, int(k % 3 > 0), 0, "") for k in range(30)]
    scores = quality.score_quality(docs, spark.createDataFrame(rows, LABELS), F.lit(True)).collect()
    assert len(scores) == len(awkward_docs()) and all(0 <= r.score <= 1 for r in scores)
    assert quality.score_quality(empty_docs(spark), spark.createDataFrame(rows, LABELS), F.lit(True)).count() == 0


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(1)
    better, worse = rng.normal(1, 1, (500, 3)), rng.normal(0, 1, (500, 3))
    w = quality.fit_pairs(better, worse, 1e-3)
    assert (better @ w > worse @ w).mean() > 0.8


def plain_quantile(scores, level):
    """Rank of the level among the sorted scores, a quarter of the way between two where it falls between them."""
    s, rank = np.sort(scores), round(level * len(scores))
    return s[0] - 1 if rank == 0 else s[-1] + 1 if rank == len(s) else 0.75 * s[rank - 1] + 0.25 * s[rank]


def plain_level(scores, labelled, good):
    """Every cut tried in turn; of the unlabelled documents in the gap a quarter stay below it."""
    order = np.argsort(labelled)
    s, g = labelled[order], good[order]
    wrong = [g[:k].sum() / g.sum() + (~g[k:]).sum() / (~g).sum() for k in range(len(s) + 1)]
    k = int(np.argmin(np.round(wrong, 12)))
    low = (scores <= s[k - 1]).sum() if k else 0
    high = (scores < s[k]).sum() if k < len(s) else len(scores)
    return (0.75 * low + 0.25 * high) / len(scores)


def test_quality_cut_is_a_quantile_of_all_scores(spark):
    """Labels beyond the sample say the level; documents without a label move the cut."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (900, len(quality.FEATURES)))
    good = x[:600, 0] + rng.normal(0, 0.8, 600) > 0.5
    features = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "doc_id long, features array<double>")
    labels = spark.createDataFrame([(k, int(g), 0, "") for k, g in enumerate(good)], LABELS)
    model = quality.fit_quality(features, labels, F.lit(True), quality.QualityParams(max_labelled=30, max_pairs=500))
    s = ((x - model.mean) / model.spread) @ model.weights
    step = 2 * np.ptp(s) / 2 ** 16
    assert model.level == pytest.approx(plain_level(s, s[:600], good), abs=3 / 900)
    near = np.sort(s)[[int(model.level * 900) - 1, int(model.level * 900) + 1]]
    assert near[0] - step <= model.cut <= near[1] + step
    assert (s < model.cut).mean() == pytest.approx(model.level, abs=1.5 / 900)


def test_quantiles_of_steps():
    one = np.ones(4, int)
    s = np.array([0.1, 0.2, 0.8, 0.9])
    assert quality.quantile_level(one, np.array([0, 0, 1, 1]), np.array([1, 1, 0, 0])) == 0.5
    assert quality.step_quantile(s, s, one, 0.5) == pytest.approx(0.35) == plain_quantile(s, 0.5)
    for level in (0.0, 0.25, 0.75, 1.0):
        assert quality.step_quantile(s, s, one, level) == pytest.approx(plain_quantile(s, level))
    # a level inside a step of many rows, and unlabelled steps between bad and good
    assert quality.step_quantile(np.array([0.0, 1.0]), np.array([0.5, 2.0]), np.array([4, 4]), 0.75) == pytest.approx(1.5)
    bad, good = np.array([1, 0, 0, 0, 0, 0]), np.array([0, 0, 0, 0, 0, 1])
    assert quality.quantile_level(np.ones(6, int), good, bad) == pytest.approx((0.75 * 1 + 0.25 * 5) / 6)
    # one class beyond the other's reach: nothing below, everything below
    assert quality.quantile_level(one, np.array([1, 1, 1, 1]), np.zeros(4, int)) == 0.0
    assert quality.step_quantile(s, s, one, 1.0) == pytest.approx(1.9)


def test_all_scores_equal(spark):
    frame = spark.createDataFrame([(2.0, 1), (2.0, 0)], "s double, quality int")
    level, cut = quality.score_quantile(frame.select("s"), frame, 10)
    assert (level, cut) in ((0.0, 1.0), (1.0, 3.0))


@pytest.mark.parametrize("column,name,wrong", [("toxic", "op2_toxicity", 1), ("quality", "op8_quality", 0)])
def test_recall_and_false_alarms_held_out(spark, column, name, wrong):
    """The class to catch and the rest, apart: answering one class everywhere passes neither."""
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", column)
    rows = queries()[name](spark, SF01).join(labels, "doc_id").filter("held_out").collect()
    caught = [r.predicted == wrong for r in rows if r[column] == wrong]
    alarms = [r.predicted == wrong for r in rows if r[column] != wrong]
    assert caught and alarms
    assert np.mean(caught) >= 0.8 and np.mean(alarms) <= 0.03
