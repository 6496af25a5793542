"""Schema guards (driver metadata only, no job)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    """Raise when any of ``names`` is absent; returns ``df`` for chaining."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"{what} is missing columns: {missing}")
    return df


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns) — the per-step shape report; one count job."""
    return df.count(), len(df.columns)
