"""A numbered log of table versions: written aside, committed by one file, pruned with respect for readers.

A version is a folder of its own. It becomes one by a commit: the next number's
file is created in ``_log`` with the folder's name in it, and creating fails if
another writer took the number first; the loser looks again and takes the next.
So numbers follow the order of the commits, whoever began first, and the highest
number is current. A load that was made from a certain version can ask for that
version to be still current, and fails otherwise (``CommitConflict``).

Readers that hold a version lease it; writers lease the folder they write.
Pruning keeps the newest versions, leased ones, and folders being written.
Leases are small files renewed in the background and run out when their
process is gone.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from marquee.storage import (LEASE_HOURS, create_file, folder_names, live_leases, read_text, release_lease, remove,
                             take_lease, unique_name)

LOG, LEASES, FOLDER = "_log", "_leases", "version="


class CommitConflict(RuntimeError):
    pass


def _entry(base: str, number: int) -> str:
    return f"{base}/{LOG}/{number:020d}"


def committed(spark: SparkSession, base_path: str) -> list[tuple[int, str]]:
    """(number, folder name) of the versions, oldest first. A number whose writer died before naming a folder is skipped."""
    base = base_path.rstrip("/")
    names = [n for n in folder_names(spark, f"{base}/{LOG}") if n.isdigit()]
    out = ((int(n), read_text(spark, f"{base}/{LOG}/{n}")) for n in names)
    return [(n, folder) for n, folder in out if folder]


def current_number(spark: SparkSession, base_path: str) -> int:
    """The newest version's number; 0 if there is none."""
    return max((n for n, _ in committed(spark, base_path)), default=0)


@contextmanager
def new_version(spark: SparkSession, base_path: str) -> Iterator[str]:
    """A folder to write a version into, leased meanwhile. Without a commit it is removed, also on an error."""
    base = base_path.rstrip("/")
    folder = FOLDER + unique_name()
    lease = take_lease(spark, f"{base}/{LEASES}/{folder}.{unique_name()}")
    try:
        yield f"{base}/{folder}"
    finally:
        if folder not in {f for _, f in committed(spark, base)}:
            remove(spark, f"{base}/{folder}")
        release_lease(spark, lease)


def commit(spark: SparkSession, path: str, keep: int = 3, expect: int | None = None) -> int:
    """Make a written folder the current version, then prune; returns its number.

    ``expect`` is the number that must still be current (0: none yet).
    """
    base, folder = path.rstrip("/").rsplit("/", 1)
    while True:
        newest = current_number(spark, base)
        if expect is not None and newest != expect:
            raise CommitConflict(f"version {newest} of {base} was committed after {expect}")
        # numbers taken without a folder are passed over too
        taken = [int(n) for n in folder_names(spark, f"{base}/{LOG}") if n.isdigit()]
        number = max([newest, *taken]) + 1
        try:
            create_file(spark, _entry(base, number), folder)
        except FileExistsError:
            continue
        prune(spark, base, keep)
        return number


def prune(spark: SparkSession, base_path: str, keep: int, hours: float = LEASE_HOURS) -> None:
    """Remove versions older than the newest ``keep`` that nobody leases, and folders left by dead writers."""
    base = base_path.rstrip("/")
    versions = committed(spark, base)
    leased = {name.rsplit(".", 1)[0] for name in live_leases(spark, f"{base}/{LEASES}", hours)}
    for number, folder in versions[:-keep]:
        if folder not in leased:
            remove(spark, _entry(base, number))
            remove(spark, f"{base}/{folder}")
    known = {f for _, f in committed(spark, base)} | leased
    for name in folder_names(spark, base):
        # looked up again: a writer may have taken its lease or committed meanwhile
        if name.startswith(FOLDER) and name not in known and name not in {f for _, f in committed(spark, base)} | {
                x.rsplit(".", 1)[0] for x in live_leases(spark, f"{base}/{LEASES}", hours)}:
            remove(spark, f"{base}/{name}")


def current_version(spark: SparkSession, base_path: str) -> str:
    """The path of the version committed last."""
    versions = committed(spark, base_path)
    if not versions:
        raise FileNotFoundError(f"no version under {base_path}")
    return f"{base_path.rstrip('/')}/{versions[-1][1]}"


@contextmanager
def leased_version(spark: SparkSession, base_path: str) -> Iterator[str]:
    """The current version's path, kept from pruning until the block ends."""
    base = base_path.rstrip("/")
    while True:
        path = current_version(spark, base)
        folder = path.rsplit("/", 1)[1]
        lease = take_lease(spark, f"{base}/{LEASES}/{folder}.{unique_name()}")
        if folder in {f for _, f in committed(spark, base)}:
            break
        release_lease(spark, lease)  # pruned before the lease was there: take the newer one
    try:
        yield path
    finally:
        release_lease(spark, lease)
