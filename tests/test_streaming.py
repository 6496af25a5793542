"""Incremental ingest of landed API responses."""

import os

from marquee.streaming import current_api_records, ingest_api_responses


def _land(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_incremental_ingest_exactly_once(spark, tmp_dir):
    landing, table, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "table", "ckpt"))
    _land(landing, "a.json", [
        '{"id": "1", "status": 200, "body": "{\\"title\\": \\"A\\", \\"popularity\\": 1.5, \\"vote_average\\": 2.0}"}',
        '{"id": "2", "status": 404, "body": "{}"}',
        '{"id": "3", "error": "timeout"}',
    ])
    ingest_api_responses(spark, landing, table, ckpt).awaitTermination()
    assert sorted(r.id_pelicula_api for r in spark.read.parquet(table).collect()) == [1, 2]

    _land(landing, "b.json", [
        '{"id": "3", "status": 200, "body": "{\\"title\\": \\"C\\", \\"popularity\\": 9.0, \\"vote_average\\": 9.0}"}',
    ])
    ingest_api_responses(spark, landing, table, ckpt).awaitTermination()
    rows = spark.read.parquet(table).collect()
    assert sorted(r.id_pelicula_api for r in rows) == [1, 2, 3]  # a.json not re-ingested
    cur = {r.id_pelicula_api: r.titulo_api for r in current_api_records(spark, table).collect()}
    assert cur == {1: "A", 2: None, 3: "C"}


def _answer(seq, film, title):
    return f'{{"seq": {seq}, "id": "{film}", "status": 200, "body": "{{\\"title\\": \\"{title}\\"}}"}}'


def _titles(spark, base):
    from marquee.streaming import read_current_records
    return {r.id_pelicula_api: r.titulo_api for r in read_current_records(spark, base).collect()}


def test_current_records_take_an_earlier_response_that_lands_late(spark, tmp_dir):
    from marquee.streaming import fetched_ids, keep_current
    landing, base, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "current", "ckpt"))

    def run(**kind):
        keep_current(spark, landing, base, ckpt, **kind).awaitTermination()

    _land(landing, "a.json", [_answer(5, 1, "fifth"), _answer(7, 1, "seventh"), _answer(9, 2, "two"), '{"seq": 1, "id": "3", "error": "x"}',
                              _answer(1, "no id", "none")])
    run()
    assert _titles(spark, base) == {1: "fifth", 2: "two"}
    _land(landing, "b.json", [_answer(3, 1, "third"), _answer(11, 2, "later"), _answer(12, 4, "four")])
    run()  # a restart: the state comes from the checkpoint
    assert _titles(spark, base) == {1: "third", 2: "two", 4: "four"}
    assert sorted(r.id for r in fetched_ids(spark, base).collect()) == ["1", "2", "4"]
    run()  # nothing new
    assert _titles(spark, base) == {1: "third", 2: "two", 4: "four"}


def test_changes_are_folded_into_a_base_and_a_batch_run_again_changes_nothing(spark, tmp_dir):
    import shutil

    from marquee.streaming import compact, keep_current
    landing, base, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "current", "ckpt"))
    want = {}
    for n in range(5):
        _land(landing, f"{n}.json", [_answer(100 - n, 1, f"one {n}"), _answer(n, 2, f"two {n}"), _answer(n, 10 + n, "own")])
        keep_current(spark, landing, base, ckpt, compact_every=2).awaitTermination()
        want |= {1: f"one {n}", 2: "two 0", 10 + n: "own"}
        assert _titles(spark, base) == want
    left = os.listdir(f"{base}/changes")
    assert len(left) <= 2 and len([x for x in os.listdir(f"{base}/base") if x.startswith("version=")]) == 2
    # change files that a crash left behind after their batch was folded in are not read
    newest = sorted(left)[-1] if left else None
    kept = f"{tmp_dir}/copy"
    if newest:
        shutil.copytree(f"{base}/changes/{newest}", kept)
        compact(spark, base, int(newest.split("=")[1]))
        shutil.copytree(kept, f"{base}/changes/{newest}")
    assert _titles(spark, base) == want


def test_current_records_of_nothing(spark, tmp_dir):
    from marquee.streaming import read_current_records
    assert read_current_records(spark, f"{tmp_dir}/none").count() == 0
