"""Phrase mining, the conversation trie and MinHash fingerprints against plain Python."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import minhash, phrases, prefix_trie, queries
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.cases import awkward_docs, docs_frame, empty_docs


def table(spark, name):
    return spark.read.parquet(f"{SF001}/{name}.parquet")


# --- phrases ----------------------------------------------------------------

def chatter():
    rng = random.Random(3)
    words = "red green blue sky sea sun Moon ÉTÉ a".split()
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\t", ".", "\n"])
                                                            for _ in range(rng.randrange(60)))) for _ in range(900)]
    rows += [("en", "new york city hall")] * 40 + [("en", "a a a a a a")] * 30 + [("fr", None), ("fr", ""), ("it", ".,;")]
    return rows + [("en", "sun sea " * 30000), ("en", "A\x01 A\x01 " * 50), ("pt", "\x85nb\xa0sp x　y " * 40)]


@pytest.mark.parametrize("p", [phrases.PhraseParams(), phrases.PhraseParams(bits=7, block_bytes=500), phrases.PhraseParams(filter_bits=1 << 15)])
def test_phrases_match_brute_force(spark, p):
    rows = chatter()
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "lang string, text string, phrase string, n int")
    got = sorted(map(tuple, phrases.mine_phrases(docs, p).collect()))
    assert got == sorted(brute.phrases(rows)) and {r[0] for r in got} >= {"en", "de", "und"}


def test_colliding_fingerprints_are_found_and_counted_by_words(spark):
    docs = spark.createDataFrame(chatter(), "lang string, text string")
    p = phrases.PhraseParams(bits=7)
    assert phrases.frequent_fingerprints(docs, p).filter("clash").count() > 0
    assert phrases.frequent_fingerprints(docs, phrases.PhraseParams()).filter("clash").count() == 0


def test_only_the_best_phrases_are_kept_and_none_of_nothing(spark):
    docs = spark.createDataFrame(chatter(), "lang string, text string")
    got = sorted(map(tuple, phrases.mine_phrases(docs, phrases.PhraseParams(top=5, least=10)).collect()))
    assert got == sorted(brute.phrases(chatter(), top=5, least=10))
    assert phrases.mine_phrases(empty_docs(spark)).count() == 0


def test_blocks_hash_the_same_phrase_alike_wherever_it_stands():
    one = phrases.Block([b"x y z", b"q,  X\ty z! ", b""], ["en", "en", "en"])
    at = one.places(3)
    fp, check = one.hashed(at, 3, 0), one.hashed(at, 3, 1)
    assert [one.phrase(k, 3) for k in at] == ["x y z", "x y z"] and fp[0] == fp[1] and check[0] == check[1] and fp[0] != check[0]
    assert [one.phrase(k, 1) for k in one.places(1)] == ["x", "y", "z", "q", "x", "y", "z"]
    other = phrases.Block([b"x y z"], ["de"])
    assert other.hashed(other.places(3), 3, 0)[0] != fp[0]
    assert len(phrases.Block([], []).places(1)) == len(phrases.Block([b" .. "], ["en"]).places(1)) == 0


# --- the trie ---------------------------------------------------------------

def logged():
    rng = random.Random(1)
    rows = [(rng.randrange(60), rng.choice([None, 1, 2, 3, 4, 5]), rng.choice(["user", "bot", None]),
             rng.choice(["a b", "c", None, "d e f"])) for _ in range(220)]
    rows += [(100 + k, j, "u", f"t{j}") for k in range(60) for j in range(1 + k % 3)]   # copies and prefixes of each other
    rows += [(300 + k, 1, "u", "hot") for k in range(80)] + [(400, j, "u", "long " * 50) for j in range(700)]
    return rows + [(None, 1, "u", "x"), (500, None, None, None), (-7, 1, "u", ""), (2 ** 62, 1, "u", "w " * 9000)]


@pytest.mark.parametrize("piece", [1 << 18, 300, 1])
def test_trie_matches_brute_force_however_it_is_cut(spark, piece):
    rows = logged()
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, depth string, place int")
    nodes = prefix_trie.prefix_trie(prefix_trie.share_openings(prefix_trie.turn_sequences(frame)), prefix_trie.TrieParams(piece_turns=piece))
    assert sorted(map(tuple, nodes.collect()), key=str) == sorted(brute.trie(rows), key=str)


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(c, 1, "u", "x") for c in range(61, 80)]  # no conversation 60: those with h > 0 lose their only turn
    got = prefix_trie.prefix_trie(prefix_trie.share_openings(prefix_trie.turn_sequences(spark.createDataFrame(rows, schema))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute.trie(rows), key=str)
    assert prefix_trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0


def test_range_minima_and_extents():
    rng = np.random.default_rng(5)
    lcp = np.r_[-1, rng.integers(0, 4, 70)]
    levels = prefix_trie.sparse_table(lcp)
    left, right = (np.sort(rng.integers(0, 71, (2, 300)), axis=0))
    assert (prefix_trie.range_min(levels, left, right) == [lcp[a:b + 1].min() for a, b in zip(left, right)]).all()
    at, depth = rng.integers(0, 71, 300), rng.integers(0, 4, 300)
    for p, d, lo, hi in zip(at, depth, *prefix_trie.extents(levels, at, depth)):
        assert (lcp[lo + 1:hi + 1] >= d).all() and (lo == 0 or lcp[lo] < d) and (hi == 70 or lcp[hi + 1] < d) and lo <= p <= hi


# --- fingerprints -----------------------------------------------------------

@pytest.mark.parametrize("p", [minhash.MinHashParams(), minhash.MinHashParams(bins=64, bits=4, probes=2, bucket_rows=5, max_cells=4),
                               minhash.MinHashParams(shingle=2, bins=64, bits=1, probes=0, bucket_rows=7)])
def test_edits_match_brute_force(spark, p):
    rows = [(i, t) for i, t, _ in awkward_docs() if i != 207]
    rows += [(300, "one of many copies " * 9)] * 30 + [(301, f"same id, text {k} " * 4) for k in range(40)] + [(None, f"no id {k}") for k in range(9)]
    want = brute.edits(rows, shingle=p.shingle, bins=p.bins, bits=p.bits, probes=p.probes)
    docs = docs_frame(spark, [(i, t, "a") for i, t in rows]).repartition(5)
    got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, minhash.edit_report(docs, p).collect())]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_text_and_clashing_columns(spark):
    docs = docs_frame(spark)
    out = minhash.add_fingerprints(docs, "text", "fp").filter("doc_id = 207")
    assert set(out.columns) == set(docs.columns)  # the clashing column is replaced
    want = brute.packed(brute.minhash(dict((i, t) for i, t, _ in awkward_docs())[207]))
    assert out.select(minhash.hex_words(F.col("fp"))).first()[0] == want


def test_likeness_is_near_the_true_similarity(spark):
    """Over sf0.001: mean error against the Jaccard similarity of the five-word shingles, and equal texts."""
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(brute.LOW))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    rows = [(r.doc_id, r.text or "") for r in table(spark, "documents").collect()]
    rows.sort()
    got = {r.doc_id: r for r in queries.op13_minhash(spark, SF001).collect()}
    errors = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        for other, near in ((edited, got[i].near_edited), (after, got[i].near_next)):
            a, b = shingles(t), shingles(other)
            errors.append(near - len(a & b) / len(a | b))
    assert len(got) == len(rows) and abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.035 and np.abs(errors).max() < 0.15


def test_fingerprints_of_nothing(spark):
    assert minhash.edit_report(empty_docs(spark)).count() == 0
    one = minhash.edit_report(docs_frame(spark, [(1, "just one text here", "a")])).first()
    assert one.near_next == 1.0
    only_null = minhash.edit_report(docs_frame(spark, [(None, None, None)])).first()
    assert (only_null.n_chars, only_null.near_edited) == (0, 1.0)
