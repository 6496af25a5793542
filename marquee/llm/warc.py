"""WARC archives: writing with payload revisits, reading by boundary chains.

Writing: a record per page; of pages with equal payloads of at least
``min_bytes`` the one with the smallest id is a ``response``, the others are
``revisit`` records that refer to it and carry no payload. Spark's text writer
puts the records into plain ``.warc`` files, with its commit protocol.

Reading: the files are cut into byte ranges. A task looks for the record magic
in its range and emits a candidate for each: its offset, by its Content-Length
the offset where its successor must begin, and the exit: where the chain from it
leaves the range. Payloads may contain the magic, so candidates prove nothing by
themselves. Pointer jumping by joins, over the few offsets where some chain
enters a range, finds those reached from the file's start; inside a range the
chain from its entry is followed. Only what is reached is a record, and no task
or group holds more than a range. A file whose chain does not reach its end is an
error. Payloads are then read by offset, range by range.

How many tasks read is stated from the listed bytes: rows are some bytes each,
whatever they stand for, so a partition count drawn from their size would be one.

Archives are opened through pyarrow's file systems (local or mounted folders,
HDFS, S3, GCS); the listing comes from Spark.

Null html is an empty payload, null url an empty target. Line breaks and other
control characters in urls are percent-encoded in the header. Pages whose id is
null are archived; as a group's first they are taken only if all its ids are
null. Rows that repeat the smallest id of a payload are responses too. An empty
table gives no archive and no rows. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import heavy_cut, prepare
from marquee.session import scratch_path
from marquee.storage import hold, remove_older

# Fixed values of the format.
MAGIC = b"WARC/1.1\r\n"
BREAK = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

# Payload groups are found by three base32 digits of their digests: at most 32,768 rows to broadcast.
PREFIX = 3


@dataclass(frozen=True)
class WarcParams:
    min_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"
    range_bytes: int = 8 << 20
    task_bytes: int = 32 << 20   # of archive that one task scans or reads, about
    max_tasks: int = 20_000
    header_bytes: int = 1 << 16


# --- writing ----------------------------------------------------------------

def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of the payload's SHA-1: four groups of 40 bits, eight digits each."""
    sha = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(sha, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), DIGITS32, BASE32)


def page_payloads(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("payload_bytes"),
                        payload_digest(html.cast("binary")).alias("payload_digest"))


def mark_revisits(payloads: DataFrame, p: WarcParams) -> DataFrame:
    """Add ``refers_to``: the response's page_id for revisits, else null.

    Only digests that occur more than once are joined, and only pages whose
    digest begins like one of them are shuffled for it; the beginnings are few
    by construction and broadcast. Page contents stay where they are otherwise.
    """
    shared = (payloads.filter(F.col("payload_bytes") >= p.min_bytes).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").checkpoint())
    begin = F.substring("payload_digest", 1, PREFIX)
    few = F.broadcast(shared.select(begin.alias("begin")).distinct().withColumn("maybe", F.lit(True)))
    flagged = payloads.withColumn("begin", begin).join(few, "begin", "left").drop("begin")
    alone = flagged.filter("maybe is null").withColumn("first_id", F.lit(None).cast(payloads.schema["page_id"].dataType))
    # digests of very many pages go to where these are; the others meet in a join
    cut = heavy_cut(shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])
    heavy = F.broadcast(shared.filter(F.col("n") > cut).select("payload_digest", "first_id", F.lit(True).alias("hot")))
    met = flagged.filter("maybe").join(heavy, "payload_digest", "left")
    light = shared.filter(F.col("n") <= cut).select("payload_digest", "first_id")
    cool = met.filter("hot is null").drop("first_id").join(light, "payload_digest", "left")
    both = alone.unionByName(met.filter("hot").drop("hot")).unionByName(cool.drop("hot")).drop("maybe")
    follows = (F.col("payload_bytes") >= p.min_bytes) & F.col("first_id").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")))
    return both.withColumn("refers_to", F.when(follows, F.col("first_id"))).drop("first_id")


def warc_record(p: WarcParams) -> Column:
    """The record's text up to the blank lines that end it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(BREAK))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    # control characters, blanks and non-ASCII never reach the header as they are
    safe = F.url_encode("url")
    for code, char in (("+", "%20"), ("%3A", ":"), ("%2F", "/"), ("%3F", "?"), ("%3D", "="), ("%26", "&"), ("%23", "#")):
        safe = F.replace(safe, F.lit(code), F.lit(char))
    target = F.when(F.col("url").rlike(r"^[\x21-\x7E]*$"), F.col("url")).otherwise(safe)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    return F.concat(
        F.lit(MAGIC.decode() + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {p.date}\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            name(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(BREAK), block)


def write_warc(pages: DataFrame, path: str, p: WarcParams = WarcParams()) -> None:
    """Write the pages as WARC files into a new folder."""
    marked = mark_revisits(page_payloads(pages), p)
    marked.select(warc_record(p).alias("value")).write.option("lineSep", BREAK).text(path)


# --- reading ----------------------------------------------------------------

def open_file(uri: str):
    """A seekable pyarrow file of a path as Spark names it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


HEADER_FIELD = re.compile(rb"(?im)^([A-Za-z-]+):[ \t]*([^\r\n]*)")


def header_fields(head: bytes) -> dict[str, str]:
    return {k.decode().lower(): v.decode("utf-8", "replace").strip() for k, v in HEADER_FIELD.findall(head)}


def candidates(path: str, start: int, end: int, p: WarcParams) -> Iterator[tuple[int, int]]:
    """(offset, successor offset) of every well-formed record header that begins in [start, end).

    A header is read to its blank line however long it is, ``header_bytes`` beyond the range at first,
    twice as far each time after. A line that is no field ends the attempt.
    """
    with open_file(path) as f:
        f.seek(start)
        data = f.read(end - start + p.header_bytes)
        at = data.find(MAGIC)
        stop, length, length_at, after = -1, b"", -1, -1  # of the lines read last, which end before ``after``
        while 0 <= at < end - start:
            if at >= after:  # else its lines are the last ones of those
                stop, length, length_at, after = -1, b"", -1, at + len(MAGIC)
                while True:
                    eol = data.find(b"\r\n", after)
                    while eol < 0:
                        seen = len(data)
                        more = f.read(max(p.header_bytes, seen - at))
                        if not more:
                            break
                        data += more
                        eol = data.find(b"\r\n", max(after, seen - 1))
                    line = data[after:eol] if eol >= 0 else b""
                    if eol == after:
                        stop = eol
                    if not line or not (b":" in line or line[:1] in b" \t"):
                        break
                    name, _, value = line.partition(b":")
                    if name.lower() == b"content-length":
                        length, length_at = value.strip(), after
                    after = eol + 2
            if stop >= 0 and at < length_at and length.isdigit() and len(length) < 19:
                yield start + at, start + stop + 2 + int(length) + 4
            at = data.find(MAGIC, at + 1)


def exits(offsets: np.ndarray, successors: np.ndarray, end: int) -> np.ndarray:
    """Where the chain from each candidate of a range leaves it (at ``end`` or beyond); -1 where it breaks off. Ascending offsets."""
    n = len(offsets)
    place = np.searchsorted(offsets, successors)
    hit = (place < n) & (offsets[np.minimum(place, max(n - 1, 0))] == successors) if n else np.zeros(0, bool)
    out = np.where(successors >= end, successors, -1)
    jump = np.where((successors < end) & hit, place, np.arange(n))  # successors lie further on; the others stand still
    for _ in range(int(n).bit_length()):
        jump = jump[jump]
    return out[jump]


def follow(offsets: np.ndarray, successors: np.ndarray, entry: int) -> np.ndarray:
    """Which candidates of a range the chain from ``entry`` reaches, by pointer jumping (log2 rounds). Ascending offsets."""
    n = len(offsets)
    place = np.searchsorted(offsets, successors)
    jump = np.append(np.where((place < n) & (offsets[np.minimum(place, n - 1)] == successors), place, n), n)  # n: nowhere
    seen = offsets == entry
    seen = np.append(seen, False)
    for _ in range(max(1, int(n).bit_length())):
        seen[jump[seen]] = True
        jump = jump[jump]
    return seen[:n]


def chain_entries(found: DataFrame, files: DataFrame, rounds: int) -> DataFrame:
    """(path, offset): the offsets where each file's true chain enters a range, and its end; an error if one has none.

    Nodes are the offsets at which the chain from any candidate enters a range:
    about one a range. Every round doubles how many ranges a jump spans.
    """
    goals = found.filter("exit >= 0").select("path", F.col("exit").alias("offset")).distinct()
    jump = (found.join(goals.unionByName(files.select("path", F.lit(0).cast("long").alias("offset"))).distinct(), ["path", "offset"])
            .filter("exit >= 0").select("path", "offset", F.col("exit").alias("to")).checkpoint())
    reached = files.select("path", F.lit(0).cast("long").alias("offset"))
    for turn in range(rounds):
        reached = (reached.unionByName(reached.join(jump, ["path", "offset"]).select("path", F.col("to").alias("offset")))
                   .distinct().checkpoint())
        if turn + 1 == rounds:
            break
        further = jump.select("path", F.col("offset").alias("to"), F.col("to").alias("far"))
        jump = jump.join(further, ["path", "to"]).select("path", "offset", F.col("far").alias("to")).checkpoint()
    lost = files.join(reached.withColumnRenamed("offset", "length"), ["path", "length"], "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"the records of {lost[0]['path']} do not reach its end")
    return reached


def record_offsets(spark: SparkSession, path: str, p: WarcParams) -> tuple[DataFrame, int]:
    """(path, offset, next) of the verified records of all files of a folder, and the tasks that reading them takes."""
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0").checkpoint()
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("all"), F.coalesce(F.max("length"), F.lit(0)).alias("most")).first()
    tasks = max(1, min(p.max_tasks, -(-size["all"] // p.task_bytes)))
    ranges = files.select("path", "length", F.explode(F.expr(f"sequence(0L, length - 1, {p.range_bytes}L)")).alias("start"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, length, start in zip(*(b.column(i).to_pylist() for i in range(3))):
                end = min(length, start + p.range_bytes)
                got = np.array(list(candidates(name, start, end, p)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(got), pa.string()), pa.array(np.full(len(got), start)), pa.array(got[:, 0]), pa.array(got[:, 1]),
                     pa.array(exits(got[:, 0], got[:, 1], end))], ["path", "start", "offset", "next", "exit"])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        return pdf[follow(pdf["offset"].to_numpy(), pdf["next"].to_numpy(), int(pdf["entry"].iloc[0]))][["path", "offset", "next"]]

    found = (ranges.repartition(tasks, "path", "start")
             .mapInArrow(find, "path string, start long, offset long, next long, exit long").checkpoint())
    # the true chain enters a range at most once, and after as many jumps as there are ranges it is at the end
    rounds = (max(1, -(-size["most"] // p.range_bytes))).bit_length()
    reached = chain_entries(found, files, rounds)
    entries = reached.join(files, "path").filter("offset < length").select("path", (F.col("offset") - F.col("offset") % p.range_bytes).alias("start"), F.col("offset").alias("entry"))
    # two integers and a path a candidate, of one range at a time
    inside = found.join(entries, ["path", "start"]).groupBy("path", "start").applyInPandas(chain, "path string, offset long, next long")
    return inside, tasks


def read_warc(spark: SparkSession, path: str, p: WarcParams = WarcParams(), payloads: bool = True) -> DataFrame:
    """The archive's records: path, offset, record_type, record_id, target, refers_to, payload_bytes, payload_digest, payload.

    Length and digest of a response are taken from its payload as read; a
    revisit has them from its header. ``payloads=False`` leaves payloads out.
    """
    spots, tasks = record_offsets(spark, path, p)
    out = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
                     ("target", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("payload", pa.binary())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f = None, None
        for b in batches:
            held, rows = 0, []
            for path_, at, nxt in zip(*(b.column(i).to_pylist() for i in range(3))):
                if path_ != name:
                    name, f = path_, open_file(path_)
                f.seek(at)
                raw = f.read(nxt - at - 4)
                head, _, block = raw[len(MAGIC):].partition(BREAK.encode())
                fields = header_fields(head)
                http, _, payload = block.partition(BREAK.encode())
                if fields.get("warc-type") == "revisit":
                    size = int(header_fields(http).get("content-length") or 0)
                    digest, payload = fields.get("warc-payload-digest", "").removeprefix("sha1:"), None
                else:
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                rows.append((path_, at, fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-target-uri"),
                             fields.get("warc-refers-to"), size, digest, payload if payloads else None))
                held += len(head) + (len(payload or b"") if payloads else 0)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)
                    held, rows = 0, []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    near = F.floor(F.col("offset") / p.range_bytes)
    return (spots.repartition(tasks, "path", near).sortWithinPartitions("path", "offset")
            .mapInArrow(load, "path string, offset long, record_type string, record_id string, target string, "
                              "refers_to string, payload_bytes long, payload_digest string, payload binary"))


def page_of(record_id: Column) -> Column:
    """The page id in a record's name."""
    return F.regexp_extract(record_id, r"urn:page:([^>]*)>", 1).try_cast("bigint")


def archive_folder(spark: SparkSession, hours: float = 24.0) -> str:
    """A new folder for archives under the shared checkpoint folder; those nobody holds for ``hours`` are cleared."""
    remove_older(spark, scratch_path(spark, "llm", "warc"), hours)
    return hold(spark, scratch_path(spark, "llm", "warc", unique=True))
