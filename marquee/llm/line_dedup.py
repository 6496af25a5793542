"""Line de-duplication across documents, with DataFrame functions only.

Lines become 128-bit hashes of their keys. The hashes are range-partitioned
with a secondary sort by document and position, and each run of equal hashes is
streamed in that order: where the document changes a new document is counted,
and the run's first line is its first occurrence. What comes back per document
is a run-length coded keep bitmap, not text.

Hashes that hold over 1/1000 of all lines, or over 500,000, would make long
runs in one task. There are few of them by construction (``heavy_cut``). They
are counted by a map-side combined aggregate instead and reach their lines by a
broadcast.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with
A-Z lower-cased; keys shorter than ``min_chars`` code points are never dropped.
A document is a (doc_id, text) pair: rows repeated exactly count once, rows
that share an id but not the text count apart, null ids are an id like any
other. Null or empty text is one empty line. An empty table gives no rows. Only
doc_id and text are read, so extra columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import hash128, heavy_values, lower_ascii

BLANKS = " \t\n\x0b\x0c\r"
DOC = ("doc_id", "text_hash")


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def document_key(df: DataFrame) -> DataFrame:
    """Add text_hash; with doc_id it stands for the document."""
    return df.withColumn("text_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, n_lines, pos, h1, h2) of every line whose key is long enough."""
    own = document_key(docs.select("doc_id", "text")).select(*DOC, text_lines(F.col("text")).alias("lines"))
    lines = own.select(*DOC, F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keys = lines.select(*DOC, "n_lines", "pos", lower_ascii(F.btrim("line", F.lit(BLANKS))).alias("key"))
    h1, h2 = hash128(F.col("key"))
    return (keys.filter(F.char_length("key") >= max(1, min_chars))
            .select(*DOC, "n_lines", "pos", h1.alias("h1"), h2.alias("h2")))


def mark_runs(lines: DataFrame) -> DataFrame:
    """Range-partitioned runs of equal hashes: n_docs of the run, and whether a line is its first."""
    ranged = lines.repartitionByRange("h1", "h2")
    run = Window.partitionBy("h1", "h2")
    order = run.orderBy(*DOC, "pos")
    last = F.lag(F.struct(*DOC)).over(order)
    opened = F.when(last.isNull() | ~last.eqNullSafe(F.struct(*DOC)), 1).otherwise(0)
    # rows repeated in the table stand side by side here: one document, and all of them first
    first = F.first(F.struct(*DOC, "pos")).over(order)
    return (ranged.withColumn("opened", opened).withColumn("is_first", F.struct(*DOC, "pos").eqNullSafe(first))
            .withColumn("n_docs", F.sum("opened").over(run))
            .select(*DOC, "n_lines", "pos", "n_docs", "is_first"))


def mark_heavy(lines: DataFrame, heavy: DataFrame) -> DataFrame:
    """The same for the lines of heavy hashes, by aggregates that combine before the shuffle."""
    own = lines.join(F.broadcast(heavy), ["h1", "h2"])
    per_doc = own.groupBy("h1", "h2", *DOC).agg(F.min("pos").alias("pos"))
    stats = per_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"),
                                            F.min(F.struct(*DOC, "pos")).alias("first"))
    # one row per heavy hash: few by construction
    return own.join(F.broadcast(stats), ["h1", "h2"]).select(
        *DOC, "n_lines", "pos", "n_docs", F.struct(*DOC, "pos").eqNullSafe(F.col("first")).alias("is_first"))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """Sorted dropped positions -> runs of kept lines as (start, length), the compressed keep bitmap."""
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))
    runs = F.transform(F.sequence(F.lit(0), F.size(dropped)), lambda i: F.struct(
        (F.get(edges, i) + 1).alias("start"),
        (F.get(edges, i + 1) - F.get(edges, i) - 1).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                 keep_first: bool = False) -> DataFrame:
    """The keep bitmap of every document that loses lines: doc_id, text_hash, n_lines, n_dropped, keep_runs.

    Lines whose key at least ``min_docs`` documents have go; ``keep_first`` spares
    the first occurrence of each. A document that keeps all lines has no row.
    """
    lines = line_hashes(docs, min_chars).checkpoint()
    total = lines.count()
    counts = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    heavy = heavy_values(counts, total).select("h1", "h2").checkpoint()
    marked = (mark_runs(lines.join(F.broadcast(heavy), ["h1", "h2"], "left_anti"))
              .unionByName(mark_heavy(lines, heavy)))
    drop = F.col("n_docs") >= min_docs
    if keep_first:
        drop = drop & ~F.col("is_first")
    gone = marked.filter(drop).groupBy(*DOC).agg(F.max("n_lines").alias("n_lines"),
                                                 F.array_sort(F.collect_set("pos")).alias("dropped"))
    return gone.select(*DOC, "n_lines", F.size("dropped").alias("n_dropped"),
                       keep_runs(F.col("dropped"), F.col("n_lines")).alias("keep_runs"))


ADDED = ("n_lines", "n_dropped", "keep_runs", "kept_text")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                keep_first: bool = False) -> DataFrame:
    """The documents with n_lines, n_dropped, keep_runs (the bitmap) and kept_text added.

    Rows, their number and every other column stay as they are; a column that
    has one of the added names is replaced.
    """
    maps = line_bitmaps(docs, min_docs, min_chars, keep_first).select(
        F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), "n_dropped", "keep_runs")
    kept_columns = [c for c in docs.columns if c not in ADDED]
    # other columns travel in a struct, so that none of their names can clash; the text travels once
    others = F.struct(*[f"`{c}`" for c in kept_columns if c != "text"])
    own = document_key(docs.select("doc_id", F.col("text").alias("text"), others.alias("row")))
    lines = text_lines(F.col("text"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").alias("length")))
    out = (own.join(maps, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("text_hash") == F.col("g_hash")), "left")
           .select("row", "text", F.size(lines).alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "keep_runs")
           .withColumn("keep_runs", F.coalesce("keep_runs", whole)))
    kept = F.array_join(F.flatten(F.transform("keep_runs", lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
    kept = F.when(F.col("n_dropped") == 0, F.coalesce(F.col("text"), F.lit(""))).otherwise(kept)
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in kept_columns],
                      "n_lines", "n_dropped", "keep_runs", kept.alias("kept_text"))
