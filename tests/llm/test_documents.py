"""Operators over documents: brute force, awkward rows, empty tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import decontaminate, line_dedup, mixing, simhash
from tests.llm import brute
from tests.llm.cases import PROSE, awkward_docs, docs_frame, empty_docs


def key(x):
    return tuple((v is None, str(v)) for v in x)


# --- line dedup -------------------------------------------------------------

@pytest.mark.parametrize("heavy", [True, False])
def test_line_dedup_matches_brute_force(spark, monkeypatch, heavy):
    if not heavy:  # every run streamed after range partitioning
        monkeypatch.setattr(line_dedup, "heavy_values", lambda counts, total: counts.filter("false"))
    got = line_dedup.dedup_lines(docs_frame(spark)).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    want = brute.line_dedup([r[:2] for r in awkward_docs()])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_line_dedup_keeps_columns_and_first_occurrences(spark, monkeypatch):
    docs = docs_frame(spark, [(k, "same\nown %d\nsame" % k, "a") for k in range(5)])
    for patched in (False, True):
        if patched:
            monkeypatch.setattr(line_dedup, "heavy_values", lambda counts, total: counts.filter("false"))
        out = line_dedup.dedup_lines(docs, min_docs=2, keep_first=True)
        assert set(docs.columns) <= set(out.columns)
        kept = {r.doc_id: r.kept_text for r in out.collect()}
        assert kept == {0: "same\nown 0", **{k: f"own {k}" for k in range(1, 5)}}
    assert line_dedup.dedup_lines(empty_docs(spark)).count() == 0


def test_line_bitmaps_code_kept_lines(spark):
    docs = docs_frame(spark, [(k, "x\nsame\ny%d\nz\nsame" % k, "a") for k in range(4)] + [(9, "alone", "a")])
    maps = {r.doc_id: (r.n_lines, r.n_dropped, [tuple(x) for x in r.keep_runs]) for r in line_dedup.line_bitmaps(docs, min_docs=3).collect()}
    assert maps == {k: (5, 4, [(2, 1)]) for k in range(4)}
    maps = {r.doc_id: (r.n_dropped, [tuple(x) for x in r.keep_runs]) for r in line_dedup.line_bitmaps(docs, 3, keep_first=True).collect()}
    assert maps == {0: (1, [(0, 4)]), **{k: (4, [(2, 1)]) for k in range(1, 4)}}


# --- simhash ----------------------------------------------------------------

def test_simhash_matches_brute_force(spark):
    rows = awkward_docs()
    docs = [r[:2] for r in rows]
    got = simhash.near_duplicates(docs_frame(spark)).select(
        "doc_id", simhash.hex_fingerprint(F.col("fp")), "component_id").collect()
    want = [(i, f"{f:016x}", c) for (i, _), (f, c) in zip(docs, brute.simhash_components(docs))]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_group_links_match_brute_force(radius):
    import numpy as np

    rng = np.random.default_rng(radius)
    groups = []
    for n in (2, 63, 64, 65, 300):
        centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
        members = {int(centres[k % 6]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, radius + 3), replace=False))
                   for k in range(n)}
        groups.append(np.array(sorted(members), np.uint64))
    a, b = simhash.group_links(np.concatenate(groups), np.array([len(g) for g in groups]), radius, step=50)
    at = 0
    values = np.concatenate(groups)
    where = {}
    for g, members in enumerate(groups):
        for k, v in enumerate(members.tolist()):
            where[g, v] = at + k
        at += len(members)
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    want = []
    start = 0
    for members in groups:
        want += [start + r for r in brute.components(len(members), brute.near_links(members, radius))]
        start += len(members)
    links, g = [], 0
    for x, y in zip(a.tolist(), b.tolist()):
        g = next(k for k in range(g, len(groups)) if (k, x) in where and (k, y) in where)
        links.append((where[g, x], where[g, y]))
    assert brute.components(len(values), links) == want
    assert all(owner[x] == owner[y] for x, y in links)


def test_simhash_chunked_buckets_lose_no_link(spark):
    """Near copies in one bucket far beyond the chunk size."""
    rng = random.Random(4)
    fps = sorted({sum(1 << b for b in rng.sample(range(60), rng.randint(0, 5))) for _ in range(400)})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    p = simhash.SimHashParams(chunk=16)
    links = [(r.a, r.b) for r in simhash.near_links(frame, p).collect()]
    at = {f: k for k, f in enumerate(fps)}
    assert brute.components(len(fps), [(at[a], at[b]) for a, b in links]) == brute.components(len(fps), brute.near_links(fps, 4))


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_simhash_finds_the_same_links_with_any_number_of_blocks(spark, blocks):
    rng = random.Random(blocks)
    centres = [rng.getrandbits(64) for _ in range(20)]
    fps = sorted({(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))) for c in centres for _ in range(20)})
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for chunk in (16, 4096):
        links = simhash.near_links(frame, simhash.SimHashParams(blocks=blocks, chunk=chunk)).distinct().collect()
        at = {f: k for k, f in enumerate(fps)}
        got = brute.components(len(fps), [(at[r.a % (1 << 64)], at[r.b % (1 << 64)]) for r in links])
        assert got == brute.components(len(fps), brute.near_links(fps, 4))


def test_simhash_comparisons_stay_bounded_as_fingerprints_grow():
    p = simhash.SimHashParams()
    totals = [10 ** k for k in range(2, 13)]
    blocks = [simhash.chosen_blocks(n, p) for n in totals]
    assert blocks == sorted(blocks) and blocks[0] == 5 and blocks[-1] > 7
    assert all(simhash.expected_comparisons(m, 4, n) < 60_000 for m, n in zip(blocks, totals))
    for m in (5, 6, 7, 8):  # any four blocks hit leave a table whose bits all agree
        masks = simhash.block_masks(m, 4)
        cuts = [round(64 * k / m) for k in range(m)]
        for hit in itertools.combinations(cuts, 4):
            assert any(not mask & sum(1 << b for b in hit) for mask in masks)
    assert simhash.SimHashParams(radius=0).radius == 0 and simhash.block_masks(1, 0) == [(1 << 64) - 1]


def test_drop_near_duplicates_counts_null_and_repeated_ids(spark):
    words = [" ".join(f"w{g}x{j}" for j in range(60)) for g in range(4)]
    rows = [(None, words[0], "a")] * 3 + [(5, words[0], "a"), (4, words[0], "a"), (4, words[0], "a")]  # 4 stays, once
    rows += [(None, words[1], "a")] * 2 + [(8, words[2], "a")] * 40 + [(8, words[3], "a")] + [(None, None, "a")] * 2
    kept = simhash.drop_near_duplicates(docs_frame(spark, rows))
    assert kept.columns == docs_frame(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(4, words[0]), (None, words[1]), (8, words[2]), (8, words[3]), (None, None)], key=str)


def test_drop_near_duplicates_keeps_columns_of_any_name(spark):
    rows = [(k, f"{k // 2} " + "same words in all of these " * 5) for k in range(6)]
    names = ("gone", "k_own", "k_id", "k_hash", "r_id", "row", "root", "n")
    frame = spark.createDataFrame([(*r, *[f"{c}{r[0]}" for c in names]) for r in rows],
                                  "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert all(r[c] == f"{c}{r.doc_id}" for r in kept.collect() for c in names) and 0 < kept.count() < 6


def test_drop_near_duplicates_keeps_one_of_each_group(spark):
    rows = [r for r in awkward_docs() if r[0] is not None]
    kept = [r.doc_id for r in simhash.drop_near_duplicates(docs_frame(spark, rows)).collect()]
    want = {c for _, c in brute.simhash_components([r[:2] for r in rows])}
    assert set(kept) == want


# --- decontamination --------------------------------------------------------

ITEMS = [(1, " ".join(PROSE[:14])), (2, "a cart"), (3, "Cart"), (4, ""), (5, None), (6, "the the the the the the the the the the the the"),
         (None, "nobody counted the stones"), (2, "light, was; poor"), (7, " ".join(PROSE[5:17]).upper()), (8, "école ünïcode")]


def contamination_docs():
    rnd = random.Random(3)
    rows = [(k, " ".join(rnd.choice(PROSE) for _ in range(rnd.randint(0, 60))), "a") for k in range(60)]
    rows += [(100 + k, " ".join(rnd.choice(PROSE) for _ in range(9)) + " -- " + ", ".join(PROSE[k:k + 13]), "a") for k in range(20)]
    rows += [(200, "The " * 30, "a"), (201, "Ünïcode École école ünïcode", "a"), (202, "cart", "a"), (202, "a cart a cart", "b"),
             (203, None, "a"), (204, "", "a"), (None, "a cart", "a"), (205, "x " * 50000 + " ".join(PROSE[:14]), "a"), (202, "cart", "a")]
    return rows


def test_contamination_matches_brute_force(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("hash", F.lit(1)).withColumn("win", F.lit(2))
    rows = contamination_docs()
    got = decontaminate.contamination_report(docs_frame(spark, rows), items).select("doc_id", "n_words", "n_hit", "items").collect()
    want = brute.contamination([r[:2] for r in rows], ITEMS)
    assert sorted(((r[0], r[1], r[2], list(r[3])) for r in got), key=key) == sorted(want, key=key)
    kept = decontaminate.drop_contaminated(docs_frame(spark, rows), items)
    assert kept.count() == sum(w[2] == 0 for w in want) and kept.columns == docs_frame(spark).columns


def test_contamination_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination_report(empty_docs(spark), items).count() == 0
    out = decontaminate.contamination_report(docs_frame(spark), none)
    assert out.count() == len(awkward_docs()) and out.filter("n_hit > 0").count() == 0


# --- mixing -----------------------------------------------------------------

def test_targets_match_repeated_sharing(spark):
    rnd = random.Random(1)
    for trial in range(4):
        sizes = {s: rnd.choice([0, 1, 7, 50, 3000, 100000]) for s in ["a", "B", "é", "", None, "zz", "b"][:rnd.randint(1, 7)]}
        rows = [(k, s, n) for k, (s, n) in enumerate(sizes.items())]
        frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(frame, mixing.MixParams()).collect()}
        assert got == pytest.approx(brute.targets(sizes)), (trial, sizes)


def permuted(spark, n, epoch, rank=2):
    p, size = mixing.MixParams(), F.lit(n).cast("long")
    rounds = mixing.permutation_rounds(mixing.permutation_key(F.lit(rank), F.lit(epoch).cast("long")), size, p)
    rows = spark.range(n).select("id", mixing.permute(F.col("id"), size, rounds).alias("block")).collect()
    return [r.block for r in sorted(rows, key=lambda r: r.id)]


def test_permutation_is_a_bijection_and_shuffles(spark):
    seen = [permuted(spark, 501, epoch) for epoch in range(3)] + [permuted(spark, 501, 0, rank=3)]
    for seq in seen:
        assert sorted(seq) == list(range(501))
        assert sum(abs(a - b) < 5 for a, b in zip(seq, seq[1:])) < 40
        assert sum(k == x for k, x in enumerate(seq)) < 10
    assert len({tuple(s) for s in seen}) == 4
    for n in (1, 2, 3):
        assert sorted(permuted(spark, n, 0)) == list(range(n))


def test_mix_meets_targets_and_never_exceeds_three_passes(spark):
    rnd = random.Random(7)
    rows = [(k, " ".join(["w"] * rnd.randint(0, 400)), rnd.choice(["hot", "hot", "hot", "b", "c", None])) for k in range(600)]
    rows += [(1000, "tiny source only", "small"), (1001, None, "void"), (5, "repeated id " * 30, "b"), (None, "no id " * 40, "c")]
    docs = docs_frame(spark, rows)
    p = mixing.MixParams(shard_slots=64, bucket_rows=32)
    first = mixing.mix_report(docs, p).collect()
    assert len(first) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = brute.targets(sizes), {}
    for r in first:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 2 * p.block_words, s
    again = mixing.mix_report(docs.repartition(7), p).collect()
    assert sorted(map(tuple, first), key=key) == sorted(map(tuple, again), key=key)
    # the mix itself: whole blocks per slot, and the same words as the report
    pieces = mixing.mix(docs, p)
    assert pieces.agg(F.sum("words")).first()[0] == sum(r.taken for r in first)
    assert pieces.groupBy("source", "slot").agg(F.sum("words").alias("w"), F.count_distinct("block").alias("b")).filter(
        f"w > {p.block_words} or b > 1").count() == 0


def test_mix_of_nothing(spark):
    assert mixing.mix_report(empty_docs(spark)).count() == 0
    rows = mixing.mix_report(docs_frame(spark, [(1, None, "a"), (2, "", None), (3, " \n", "b")])).collect()
    assert [(r.size, r.taken, r.target) for r in rows] == [(0, 0, 0.0)] * 3
