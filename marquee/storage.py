"""Shared-storage helpers through Hadoop's file systems: listings, markers, clean-up.

Only names and sizes reach the driver, never contents. Paths may be on any
file system Spark can open.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid

from pyspark.sql import SparkSession

# A folder is left alone for this long after it was last changed or its lease renewed.
LEASE_HOURS = 24.0
RENEW_SECONDS = 600.0
_LEASE = "_lease."


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of the files under ``path`` (a file or a folder), sorted; [] if missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out, todo = [], [p]
    while todo:
        for st in fs.listStatus(todo.pop()):
            name = st.getPath().getName()
            if st.isDirectory():
                todo.append(st.getPath())
            elif not name.startswith(("_", ".")):
                out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(out)


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A short name for the present contents of ``paths``: changes when a file is added, removed or rewritten."""
    text = repr([listing(spark, p) for p in paths])
    return hashlib.sha1(text.encode()).hexdigest()[:16]


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; [] if missing."""
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; FileExistsError if it is there. Of several writers the file system lets one succeed."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Exception as failed:
        if fs.exists(p):
            raise FileExistsError(path) from failed
        raise
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def remove_older(spark: SparkSession, folder: str, hours: float = LEASE_HOURS) -> None:
    """Delete the entries of ``folder`` that nobody has changed, or renewed the lease of, for ``hours``."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return
    limit = (time.time() - hours * 3600) * 1000
    entries = {st.getPath().getName(): st for st in fs.listStatus(p)}
    for name, st in entries.items():
        lease = entries.get(_LEASE + name)
        if max(st.getModificationTime(), lease.getModificationTime() if lease else 0) < limit:
            fs.delete(st.getPath(), True)
            if lease:
                fs.delete(lease.getPath(), True)


# --- leases -----------------------------------------------------------------

class _Keeper:
    """Renews this process's leases from a background thread, as long as their sessions live."""

    def __init__(self):
        self.held: dict[str, SparkSession] = {}
        self.lock = threading.Lock()
        self.thread: threading.Thread | None = None

    def add(self, spark: SparkSession, path: str) -> None:
        with self.lock:
            self.held[path] = spark
            if self.thread is None or not self.thread.is_alive():
                self.thread = threading.Thread(target=self.run, name="marquee-leases", daemon=True)
                self.thread.start()

    def drop(self, path: str) -> None:
        with self.lock:
            self.held.pop(path, None)

    def run(self) -> None:
        while True:
            time.sleep(RENEW_SECONDS)
            self.renew()

    def renew(self) -> None:
        with self.lock:
            now = list(self.held.items())
        for path, spark in now:
            if spark.sparkContext._jsc is None:  # the session has ended, and its leases run out
                self.drop(path)
                continue
            try:
                _touch(spark, path)
            except Exception:  # one failed renewal is made up by the next, long before the lease runs out
                continue


_KEEPER = _Keeper()


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def take_lease(spark: SparkSession, path: str) -> str:
    """Create a lease file and renew it until it is released or the session ends."""
    _touch(spark, path)
    _KEEPER.add(spark, path)
    return path


def release_lease(spark: SparkSession, path: str) -> None:
    _KEEPER.drop(path)
    remove(spark, path)


def hold(spark: SparkSession, folder: str) -> str:
    """Keep ``folder`` (which need not exist yet) from ``remove_older`` while this session lives; returns it.

    The lease lies beside the folder, so the folder can be written and replaced freely.
    """
    parent, name = folder.rstrip("/").rsplit("/", 1)
    take_lease(spark, f"{parent}/{_LEASE}{name}")
    return folder


def live_leases(spark: SparkSession, folder: str, hours: float = LEASE_HOURS) -> set[str]:
    """Names of the lease files directly under ``folder`` that were renewed within ``hours``."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return set()
    limit = (time.time() - hours * 3600) * 1000
    return {st.getPath().getName() for st in fs.listStatus(p) if st.getModificationTime() >= limit}


def unique_name() -> str:
    return uuid.uuid4().hex
