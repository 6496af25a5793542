"""Version log, leases, clean-up, and the stored table's layout."""

import os
import time

import pytest
from pyspark.sql import functions as F

from marquee import storage
from marquee.operators import serve
from marquee.sinks.curated import read_current, write_curated
from marquee.sinks.versions import (CommitConflict, commit, committed, current_number, current_version, leased_version, new_version,
                                    prune)
from marquee.sources.curated import file_index
from tests.test_sources_sinks import _curated

DAY = 24 * 3600


def age(path, seconds=3 * DAY):
    then = time.time() - seconds
    os.utime(path, (then, then))


def plain(spark, path, ids):
    _curated(spark, ids).write.parquet(path)


# --- commits ----------------------------------------------------------------

def test_the_later_commit_is_current_whoever_began_first(spark, tmp_dir):
    base = f"{tmp_dir}/dw"
    with new_version(spark, base) as early:
        plain(spark, early, [1])
        with new_version(spark, base) as late:
            plain(spark, late, [2])
            commit(spark, late, keep=1)
        assert current_version(spark, base) == late
        commit(spark, early, keep=1)  # pruning meanwhile has not touched the folder in the making
    assert current_version(spark, base) == early and read_current(spark, base).first().id_pelicula == 1
    assert [n for n, _ in committed(spark, base)] == [2] and not os.path.exists(late)


def test_a_number_taken_meanwhile_is_not_taken_twice(spark, tmp_dir, monkeypatch):
    from marquee.sinks import versions
    base, real, rivals = f"{tmp_dir}/dw", storage.create_file, []

    def raced(session, path, text):
        if not rivals:  # another writer commits between this one's look and its own commit
            rivals.append("version=rival")
            real(session, path, "version=rival")
        real(session, path, text)

    monkeypatch.setattr(versions, "create_file", raced)
    with new_version(spark, base) as mine:
        plain(spark, mine, [1])
        assert commit(spark, mine) == 2
    assert [f for _, f in committed(spark, base)] == ["version=rival", mine.rsplit("/", 1)[1]]


def test_a_load_made_from_an_old_version_can_refuse_to_replace_a_newer_one(spark, tmp_dir):
    base = f"{tmp_dir}/dw"
    write_curated(_curated(spark, [1]), base, expect=0)
    seen = current_number(spark, base)
    write_curated(_curated(spark, [2]), base, expect=seen)
    with pytest.raises(CommitConflict):
        write_curated(_curated(spark, [3]), base, expect=seen)
    assert read_current(spark, base).first().id_pelicula == 2
    assert len([n for n in os.listdir(base) if n.startswith("version=")]) == 2  # the refused one's files are gone


def test_a_number_without_a_folder_is_passed_over(spark, tmp_dir):
    base = f"{tmp_dir}/dw"
    first = write_curated(_curated(spark, [1]), base)
    storage.create_file(spark, f"{base}/_log/{2:020d}", "")  # its writer died before naming a folder
    assert current_version(spark, base) == first
    second = write_curated(_curated(spark, [2]), base)
    assert current_version(spark, base) == second and current_number(spark, base) == 3


# --- leases -----------------------------------------------------------------

def test_pruning_spares_leased_versions_and_running_writers(spark, tmp_dir):
    base = f"{tmp_dir}/dw"
    write_curated(_curated(spark, [1]), base)
    with leased_version(spark, base) as held:
        for n in range(2, 6):
            write_curated(_curated(spark, [n]), base, keep=1)
        assert spark.read.parquet(held).first().id_pelicula == 1
    dead = f"{base}/version=dead"
    plain(spark, dead, [9])  # a crashed writer's, without a lease
    prune(spark, base, keep=1)
    assert not os.path.exists(held) and not os.path.exists(dead) and len(committed(spark, base)) == 1


def test_a_lease_runs_out_when_nobody_renews_it(spark, tmp_dir):
    base = f"{tmp_dir}/dw"
    write_curated(_curated(spark, [1]), base)
    with leased_version(spark, base) as held:
        write_curated(_curated(spark, [2]), base, keep=1)
        lease = os.path.join(base, "_leases", os.listdir(f"{base}/_leases")[0])
        age(lease)
        storage._KEEPER.renew()  # the background renewal, brought forward
        prune(spark, base, keep=1)
        assert os.path.exists(held)
        storage._KEEPER.drop(next(p for p in storage._KEEPER.held if p.endswith(os.path.basename(lease))))
        age(lease)
        storage._KEEPER.renew()
        prune(spark, base, keep=1)
        assert not os.path.exists(held)


def test_clean_up_leaves_folders_of_a_living_run(spark, tmp_dir):
    for name in ("old", "held", "new"):
        os.makedirs(f"{tmp_dir}/runs/{name}")
    storage.hold(spark, f"{tmp_dir}/runs/held")
    for name in ("old", "held"):
        age(f"{tmp_dir}/runs/{name}")
    storage.remove_older(spark, f"{tmp_dir}/runs", hours=24)
    assert not os.path.exists(f"{tmp_dir}/runs/old") and os.path.exists(f"{tmp_dir}/runs/held") and os.path.exists(f"{tmp_dir}/runs/new")
    storage._KEEPER.drop(f"{tmp_dir}/runs/_lease.held")
    age(f"{tmp_dir}/runs/_lease.held")
    storage.remove_older(spark, f"{tmp_dir}/runs", hours=24)
    assert os.listdir(f"{tmp_dir}/runs") == ["new"]


def test_create_file_does_not_replace(spark, tmp_dir):
    storage.create_file(spark, f"{tmp_dir}/a/x", "ñ")
    with pytest.raises(FileExistsError):
        storage.create_file(spark, f"{tmp_dir}/a/x", "other")
    assert storage.read_text(spark, f"{tmp_dir}/a/x") == "ñ"


# --- layout -----------------------------------------------------------------

@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """A version of many files; ids in no order, one class in few of them."""
    base = str(tmp_path_factory.mktemp("wide"))
    ids = [(k * 7919) % 4001 for k in range(4001)]
    rows = _curated(spark, ids).withColumn("clasificacion_edad_local", F.when(F.col("id_pelicula") < 40, "18").otherwise("TE"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return write_curated(rows.repartition(3), base, expected_rows=4001)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_files_are_ranges_of_ids(spark, wide):
    index = file_index(spark, wide).orderBy("desde").collect()
    assert len(index) >= 6 and sum(r.filas for r in index) == 4001 == index[0].total
    assert all(a.hasta < b.desde and a.antes + a.filas == b.antes for a, b in zip(index, index[1:]))


def test_a_lookup_opens_one_file(spark, wide):
    found = serve.lookup_film(spark, wide, 1234)
    assert [r.id_pelicula for r in found.collect()] == [1234] and len(found.inputFiles()) == 1
    assert serve.lookup_film(spark, wide, 99999).count() == 0


def test_a_rare_class_opens_few_files(spark, wide):
    found = serve.films_of_class(spark, wide, "18")
    assert found.count() == 40 and len(found.inputFiles()) < file_index(spark, wide).count()
    assert serve.films_of_class(spark, wide, None).count() == 4001 and serve.films_of_class(spark, wide, "no such").count() == 0


def test_the_listing_has_places_and_total_without_a_sort(spark, wide):
    listed = serve.numbered_films(spark, wide)
    assert sorted((r.id_pelicula, r.posicion, r.total_registros) for r in listed.collect()) == [
        (k, k + 1, 4001) for k in range(4001)]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan


def test_a_page_opens_only_its_files(spark, wide):
    page = serve.film_page(spark, wide, 2001, 10)
    assert [(r.id_pelicula, r.posicion) for r in page.collect()] == [(k, k + 1) for k in range(2000, 2010)]
    assert len([f for f in page.inputFiles() if "_index" not in f]) <= 2
    assert serve.film_page(spark, wide, 5000, 10).count() == 0


def test_an_empty_version_serves_empty_answers(spark, tmp_dir):
    version = write_curated(_curated(spark, []), f"{tmp_dir}/dw", expected_rows=0)
    assert serve.numbered_films(spark, version).count() == 0 and serve.lookup_film(spark, version, 1).count() == 0
