"""File sinks: CSV with header, JSON lines, plain text. Distributed writes
(one file per partition); nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> str:
    """UTF-8 CSV with a header row; leading/trailing blanks are kept as data, quotes are doubled."""
    (df.write.mode(mode)
       .option("header", True).option("sep", sep).option("encoding", "UTF-8")
       .option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
    return path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One JSON object per line; null fields omitted."""
    df.write.mode(mode).json(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Single string column -> one line per row."""
    df.write.mode(mode).text(path)
    return path
