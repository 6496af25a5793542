"""The API records in force, kept up to date by the stream itself.

Which response of a film counts is a keyed state: the smallest by (sequence,
landing time), one row per film in the state store. A batch emits the films it
touched; they are written as that batch's change files. Readers see a compacted
base, one row per film, and the changes since, so neither a batch nor a reader
goes through the history of responses, and an earlier response that lands late
still takes its place.

Change files are named by the batch and written whole, so a batch that runs again
after a failure writes the same files. Now and then the changes are folded into
a new base, committed through the version log; the base says up to which batch
it reaches, so change files left over by a crash are not read twice.

The films of this table are also the index of what has been fetched: candidates
are looked up in its id column, not in the landing zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.dedup import first_per_key
from marquee.sinks.versions import commit, committed, new_version
from marquee.sources.api import parse_detail
from marquee.storage import create_file, folder_names, read_text, remove
from marquee.streaming.landing import response_stream

KEY = "id_pelicula_api"
ORDER = ("ord", "landed_at")
FIELDS = ("titulo_api", "popularidad_api", "votos_promedio_api")
SCHEMA = ("id_pelicula_api bigint, ord bigint, landed_at timestamp, titulo_api string, popularidad_api double, "
          "votos_promedio_api double")
UPTO = "_upto"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _changes(base: str, batch: int) -> str:
    return f"{base}/changes/batch={batch:020d}"


def _base_version(spark: SparkSession, base: str) -> tuple[str | None, int]:
    """(path, last batch in it) of the compacted base; (None, -1) before the first."""
    versions = committed(spark, f"{base}/base")
    if not versions:
        return None, -1
    path = f"{base}/base/{versions[-1][1]}"
    return path, int(read_text(spark, f"{path}/{UPTO}"))


def _pending(spark: SparkSession, base: str, after: int) -> list[int]:
    found = (int(n.split("=", 1)[1]) for n in folder_names(spark, f"{base}/changes") if n.startswith("batch="))
    return sorted(b for b in found if b > after)


def _read(spark: SparkSession, base: str, upto: int | None = None) -> DataFrame:
    path, last = _base_version(spark, base)
    batches = [b for b in _pending(spark, base, last) if upto is None or b <= upto]
    parts = [spark.read.schema(SCHEMA).parquet(path)] if path else []
    if batches:
        parts.append(spark.read.schema(SCHEMA).parquet(*[_changes(base, b) for b in batches]))
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # the base alone has one row per film already
    return both if path and not batches else first_per_key(both, KEY, ORDER)


def compact(spark: SparkSession, base_path: str, upto: int, keep: int = 2) -> None:
    """Fold the changes up to a batch into a new base, then remove their files."""
    base = base_path.rstrip("/")
    with new_version(spark, f"{base}/base") as path:
        _read(spark, base, upto).write.mode("errorifexists").parquet(path)
        create_file(spark, f"{path}/{UPTO}", str(upto))
        commit(spark, path, keep)
    for batch in _pending(spark, base, -1):
        if batch <= upto:
            remove(spark, _changes(base, batch))


def keep_current(spark: SparkSession, landing_path: str, base_path: str, checkpoint: str, compact_every: int = 20,
                 available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start the stream from landed responses to the current records under ``base_path``.

    A restart goes on from ``checkpoint``. Films live in a RocksDB state store,
    on disk beyond the executors' memory.
    """
    base = base_path.rstrip("/")
    parsed = parse_detail(response_stream(spark, landing_path, max_files_per_trigger), keep=("landed_at",))
    rest = F.struct(*ORDER, *FIELDS)
    first = (parsed.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min(rest).alias("first"))
             .select(KEY, "first.*"))

    def apply(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(_changes(base, batch))
        _, last = _base_version(spark, base)
        if batch - last >= compact_every:
            compact(spark, base, batch)

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    writer = first.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(apply)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_current_records(spark: SparkSession, base_path: str) -> DataFrame:
    """One record per film: the first by sequence, then by landing time."""
    return _read(spark, base_path.rstrip("/")).drop("landed_at")


def fetched_ids(spark: SparkSession, base_path: str) -> DataFrame:
    """(id) of the films that have a record, as text: the id column of the table alone."""
    return _read(spark, base_path.rstrip("/")).select(F.col(KEY).cast("string").alias("id"))
