"""Operators over embeddings, pages and conversations; components; registration."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from marquee.llm import chat, topk, url_filter, warc
from marquee.llm.components import connected_components
from tests.conftest import SF001
from tests.llm import brute
from tests.oracle_check import compare, duck

OPS = [n for n in queries() if re.match(r"op\d+_", n)]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", [n for n in OPS if n in oracle_sql()])
def test_query_matches_oracle(spark, con, name):
    res = compare(queries()[name](spark, SF001), oracle_sql()[name], con)
    assert res["match"], res


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in OPS) == list(range(1, 14)) and "pipeline" in queries()


# --- components -------------------------------------------------------------

def test_components_of_chains_stars_and_nothing(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parts = {}
    for node, root in found.items():
        parts.setdefault(root, set()).add(node)
    assert sorted(map(sorted, parts.values())) == [list(range(301)), list(range(1000, 1200)), [5000, 5001]]
    assert all(root in part for root, part in parts.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- top-k ------------------------------------------------------------------

def vectors():
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(0, 0.3, 6)]) for k in range(300)]
    rows += [(1000 + k, [0.5] * 6) for k in range(60)]  # one vector many times: ties by id
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, [0.1] * 6),
             (2020, [1.0, 2.0]), (2021, [3.0, 1.0]), (2040, []), (2041, []), (20, [9.0] * 6), (7, rows[7][1]), (2060, [1e9] * 6)]
    return rows


@pytest.mark.parametrize("p", [topk.TopKParams(), topk.TopKParams(k=5, shard_rows=40, leaf_rows=4, block_rows=3)])
def test_top_k_matches_brute_force(spark, p):
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>").withColumn("shard", F.lit("x")).withColumn("id", F.lit(1))
    got = sorted(map(tuple, topk.top_k(frame, F.col("id") % 20 == 0, p).collect()))
    usable = {(i, tuple(int(np.floor(64 * x)) for x in v)) for i, v in vectors()
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted({i for i, _ in usable if i % 20 == 0}):
        best = {}
        for i, v in usable:
            for j, u in usable:
                if i == q and j != q and len(u) == len(v):
                    s = sum(a * b for a, b in zip(u, v))
                    best[j] = max(s, best.get(j, s))
        want += [(q, r, j, s) for r, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:p.k], 1)]
    assert got == sorted(want)


def test_top_k_counts_an_id_found_at_two_lengths_once(spark):
    """Candidates with vectors of both lengths must not raise the carried score, nor one hot id fill a shard."""
    rng = np.random.default_rng(6)
    rows = [(20, [0.5] * 4), (20, [0.5] * 2)]
    rows += [(k, [float(x) for x in rng.normal(0, 0.4, d)]) for k in range(200, 440) for d in (4, 2)]
    rows += [(777, [float(x) for x in rng.normal(0, 0.4, 4)]) for _ in range(150)] + [(778, [0.3] * 4)] * 200
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    p = topk.TopKParams(k=5, shard_rows=60, leaf_rows=4, block_rows=3)
    got = sorted(map(tuple, topk.top_k(frame, F.col("id") == 20, p).collect()))
    usable = {(i, tuple(int(np.floor(64 * x)) for x in v)) for i, v in rows}
    best = {}
    for i, v in usable:
        for j, u in usable:
            if i == 20 and j != 20 and len(u) == len(v):
                s = sum(a * b for a, b in zip(u, v))
                best[j] = max(s, best.get(j, s))
    assert got == [(20, r, j, s) for r, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5], 1)]


def test_top_k_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, F.col("id") % 20 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>"), F.col("id") % 20 == 0).count() == 0


def test_box_bounds_and_pruning():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(-9, 9, (200, 4)) + c for c in (0, 100, -100)]).astype(np.int64)
    tree = topk.build_tree(np.arange(600), rows, 16)
    for node in range(len(tree.first)):
        part = tree.rows[tree.first[node]:tree.last[node]]
        assert (part.min(axis=0) == tree.low[node]).all() and (part.max(axis=0) == tree.high[node]).all()
    q = np.array([[1, 1, 1, 1]])
    _, ids, scores = topk.search_block(tree, np.array([-1]), q, 3, np.array([topk.LEAST]))
    assert sorted(scores)[::-1] == sorted((rows @ q[0]).tolist())[::-1][:3]
    # a floor that nothing reaches leaves nothing; ties with the floor stay
    top = int((rows @ q[0]).max())
    assert len(topk.search_block(tree, np.array([-1]), q, 3, np.array([top + 1]))[0]) == 0
    assert len(topk.search_block(tree, np.array([-1]), q, 3, np.array([top]))[0]) >= 1


# --- WARC -------------------------------------------------------------------

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def web_pages():
    rows = [(k, f"http://h{k}.example/ä b?x=1\r\nEvil: 1", f"<p>{k % 7} é</p>" * (k % 5 + 1)) for k in range(40)]
    rows += [(50, "http://a/", INNER * 3), (51, "http://b/", "text WARC/1.1\r\nWARC/1.1\r\n" + INNER), (52, None, None), (53, "http://c/", ""),
             (54, "http://d/", INNER * 3), (55, "http://e/", "x" * 300000 + INNER + "\r\n\r\n" * 50), (None, "http://f/", "only"),
             (56, "http://g/", "only"), (57, "u", "rep"), (57, "u", "rep"), (58, "v", "rep")]
    return rows


def warc_want(rows, least=0):
    import base64
    import hashlib

    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in data:
        if i is not None and len(b) >= least:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, b in data:
        back = first.get(b) if len(b) >= least and sum(x == b for _, x in data) > 1 else None
        back = None if back == i else back
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if back is not None else "response", back))
    return out


@pytest.mark.parametrize("p", [warc.WarcParams(), warc.WarcParams(min_bytes=20, range_bytes=777)])
def test_warc_round_trip(spark, p):
    frame = spark.createDataFrame(web_pages(), "page_id long, url string, html string").withColumn("payload_digest", F.lit("x"))
    folder = warc.archive_folder(spark)
    warc.write_warc(frame, folder, p)
    got = warc.read_warc(spark, folder, p).withColumn("page_id", warc.page_of(F.col("record_id"))).withColumn(
        "back", warc.page_of(F.col("refers_to"))).collect()
    sort = lambda rows: sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
    want = warc_want(web_pages(), p.min_bytes)
    assert sort((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.back) for r in got) == sort(want)
    texts = {i: (h or "").encode() for i, _, h in web_pages()}
    assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload) == texts[r.page_id] for r in got)


def test_warc_of_nothing(spark):
    folder = warc.archive_folder(spark)
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_warc(spark, folder).count() == 0


@pytest.mark.parametrize("p", [warc.WarcParams(), warc.WarcParams(range_bytes=777, header_bytes=64)])
def test_warc_headers_of_any_length(spark, p):
    magic = "WARC/1.1\r\nA: b\r\n"
    rows = [(1, "é" * 30_000, "first"), (2, "http://b/" + "x" * 200_000, magic * 40 + "\r\n"), (3, "http://c/", "last" + magic)]
    folder = warc.archive_folder(spark)
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder, p)
    got = warc.read_warc(spark, folder, p).withColumn("page_id", warc.page_of(F.col("record_id"))).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, h) for i, _, h in rows]
    assert {r.page_id: len(r.target) for r in got} == {1: 180_000, 2: 200_009, 3: 9}


@pytest.mark.parametrize("cut", ["end", "start"])
def test_warc_chain_must_reach_the_end(spark, tmp_dir, cut):
    folder = warc.archive_folder(spark)
    warc.write_warc(spark.createDataFrame(web_pages(), "page_id long, url string, html string").coalesce(1), folder)
    raw = bytes(spark.read.format("binaryFile").load(folder).first().content)
    with open(f"{tmp_dir}/a.warc", "wb") as f:
        f.write(raw[:-20] if cut == "end" else raw[20:])
    with pytest.raises(Exception, match="do not reach its end"):
        warc.read_warc(spark, "file://" + tmp_dir).count()


def test_pointer_jumping_in_a_range():
    off, nxt = np.array([0, 10, 12, 30, 50, 60]), np.array([10, 30, 30, 50, 60, 99])
    assert warc.follow(off, nxt, 0).tolist() == [True, True, False, True, True, True]
    assert warc.follow(off, nxt, 12).tolist() == [False, False, True, True, True, True]
    assert not warc.follow(off, nxt, 11).any() and not warc.follow(off[:0], nxt[:0], 0).any()
    assert warc.exits(off, nxt, 80).tolist() == [99] * 6
    assert warc.exits(off, np.array([10, 31, 30, 50, 60, 99]), 80).tolist() == [-1, -1, 99, 99, 99, 99]
    chain = np.arange(0, 5000, 5)
    assert warc.follow(chain, chain + 5, 0).all() and (warc.exits(chain, chain + 5, 5000) == 5000).all()


def test_archives_are_scanned_and_read_by_many_tasks(spark):
    """Under AQE's own settings; candidates of one file meet by range only."""
    rows = [(k, f"http://h/{k}", f"page {k} " + "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * (k % 4) + "y" * (k % 977)) for k in range(1500)]
    folder = warc.archive_folder(spark)
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    p = warc.WarcParams(range_bytes=20_000, task_bytes=50_000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    try:
        spots, tasks = warc.record_offsets(spark, folder, p)
        read = warc.read_warc(spark, folder, p)
        used = read.select(F.spark_partition_id().alias("p"), "record_id").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    assert tasks > 8 and len(used) > 5 and max(r["count"] for r in used) < 500
    assert sorted(r.page_id for r in read.select(warc.page_of(F.col("record_id")).alias("page_id")).collect()) == [k for k, _, _ in rows]
    plan = spots._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInPandas [path" in plan and "start" in plan.split("FlatMapGroupsInPandas [", 1)[1].split("]", 1)[0]


# --- URL filter -------------------------------------------------------------

URLS = [(1, "http://A.Example.NET/en/x?y#z"), (2, "https://example.net/en"), (3, "http://net/"), (4, "http://xnet/a"), (5, "http://b.example.com/de/1"),
        (6, "http://example.org?q=/fr/"), (7, "http://x.org/fr/a?b"), (8, None), (9, "no scheme"), (10, "://"), (11, "ftp://ÀB.net#f"),
        (12, "http://a.net://b/"), (13, "http://a.example.com:80/de/"), (13, "http://a.example.com:80/de/"), (None, "http://net/x")]


def test_registered_domains_and_suffixes(spark):
    want = {"a.b.example.com": ("example.com", "com"), "www.shop.co.uk:8080": ("shop.co.uk", "co.uk"),
            "spam1.co.za": ("spam1.co.za", "co.za"), "x.spam2.com.mx": ("spam2.com.mx", "com.mx"), "co.za": ("co.za", "co.za"),
            "me.hosting.io": ("hosting.io", "io"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]": ("[::1]", "[::1]"),
            "localhost": ("localhost", "localhost"), "": ("", ""), "co.museum": ("co.museum", "museum")}
    frame = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r.host: (r.domain, r.suffix) for r in frame.select(
        "host", *(c.alias(n) for c, n in zip(url_filter.host_levels(F.col("host")), ("domain", "suffix")))).collect()}
    assert got == want
    domain, suffix = url_filter.host_levels(F.lit("me.hosting.io"), url_filter.Reputation(deep_suffixes=("hosting.io",)))
    assert tuple(frame.select(domain, suffix).first()) == ("me.hosting.io", "hosting.io")


def test_url_rules(spark):
    from marquee.llm.queries import RULES

    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("n", F.lit(0))
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, none, RULES).collect()}
    assert got == {
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.net", "/en", "net/", "block"), (3, "net", "/", "net/", "block"),
        (4, "xnet", "/a", None, "allow"), (5, "b.example.com", "/de/1", "example.com/de/", "block"), (6, "example.org", "", None, "allow"),
        (7, "x.org", "/fr/a", "org/fr/", "allow"), (8, "", "", None, "allow"), (9, "", "", None, "allow"), (10, "", "", None, "allow"),
        (11, "Àb.net", "", None, "allow"), (12, "a.net:", "//b/", None, "allow"), (13, "a.example.com:80", "/de/", None, "allow"),
        (None, "net", "/x", "net/", "block")}
    assert url_filter.judge_urls(pages.limit(0), none, RULES).count() == 0


def test_reputation_shrinks_and_blocks(spark):
    rows = [(k, f"http://{'bad' if k < 40 else 'good' if k < 80 else 'new'}.{'spam' if k < 40 or k == 90 else 'fine'}.io/{k}") for k in range(92)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([(k, int(k < 40)) for k in range(80)], "page_id long, bad int")
    out = {r.page_id: r for r in url_filter.judge_urls(pages, outcomes, []).collect()}
    assert out[0].verdict == "block" and out[50].verdict == "allow"
    assert out[90].rate > 0.8 > 0.2 > out[91].rate  # a new host leans to its domain
    assert all(r.lower <= r.rate for r in out.values())


# --- chat -------------------------------------------------------------------

def logged():
    rnd = random.Random(5)
    rows, conv = [], 0
    for _ in range(25):
        turns = [(rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "a<|im_end|>b", None, "", f"t{rnd.random()}"])) for _ in range(rnd.randint(1, 7))]
        for n in rnd.sample(range(1, len(turns) + 1), rnd.randint(1, len(turns))):
            rows += [(conv, k + 3 * (conv % 2), *turns[k]) for k in range(n)]
            conv += 1
    rows += rows[:5] + [(None, 0, "user", "lost"), (9000, None, "user", "no turn"), (9000, 1, "user", "turn"), (9000, 1, "user", "again")]
    return rows


@pytest.mark.parametrize("block", [4096, 2])
def test_snapshot_collapse_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    frame = spark.createDataFrame(logged(), "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("x")).withColumn("block", F.lit(0))
    got = {(r.conv_id, r.n_turns, r.n_copies, r.rendered) for r in chat.format_chats(frame).collect()}
    convs = {}
    low = lambda x: (x is not None, x or "")
    for c, t, role, text in sorted({r for r in logged() if r[0] is not None}, key=lambda r: (r[0], r[1] is None, r[1] or 0, low(r[2]), low(r[3]))):
        convs.setdefault(c, []).append((role or "unknown", text or ""))
    whole = {c: tuple(v) for c, v in convs.items()}
    snapshots = {v[:k] for v in whole.values() for k in range(1, len(v))}
    plain = lambda s: s.replace("<|im_start|>", "<| im_start|>").replace("<|im_end|>", "<| im_end|>")
    want = set()
    for v in set(whole.values()) - snapshots:
        ids = [c for c, x in whole.items() if x == v]
        want.add((min(ids), len(v), len(ids), "".join(f"<|im_start|>{plain(r)}\n{plain(t)}<|im_end|>\n" for r, t in v)))
    assert got == want
    assert chat.format_chats(frame.limit(0)).count() == 0
