"""The batch ETL as one lazy plan: clean -> consolidate -> integrate -> rule -> project.

Catalyst sees the whole chain. Three shuffles carry the work, one per source,
each keyed by the film id (staging consolidation, API de-duplication,
restrictions de-duplication); the two left joins reuse that partitioning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marquee.config import DEFAULT_CONFIG, CatalogConfig
from marquee.operators.clean import clean_api, clean_restrictions, clean_staging
from marquee.operators.consolidate import consolidate
from marquee.operators.final import final_projection
from marquee.operators.integrate import integrate
from marquee.operators.rules import apply_rules
from marquee.sources.fixtures import Fixtures


class EtlFrames:
    """Every intermediate of one run, each built on first use (all lazy).

    A query that needs one branch (say the consolidated staging rows) plans
    only that branch: building a DataFrame costs driver round trips, so the
    API and restrictions frames are not constructed unless asked for.
    """

    def __init__(self, staging_raw: DataFrame | Callable[[], DataFrame],
                 restrictions_raw: DataFrame | Callable[[], DataFrame],
                 api_raw: DataFrame | Callable[[], DataFrame],
                 cfg: CatalogConfig = DEFAULT_CONFIG, run_ts: dt.datetime | None = None,
                 tap: Callable[[str, DataFrame], DataFrame] | None = None):
        self._sources = {"staging_raw": staging_raw, "restrictions_raw": restrictions_raw,
                         "api_raw": api_raw}
        self.cfg = cfg
        self.run_ts = run_ts
        self._tap = tap or (lambda name, df: df)

    def _source(self, name: str) -> DataFrame:
        src = self._sources[name]
        return self._tap(name, src if isinstance(src, DataFrame) else src())

    @cached_property
    def staging_raw(self) -> DataFrame:
        return self._source("staging_raw")

    @cached_property
    def restrictions_raw(self) -> DataFrame:
        return self._source("restrictions_raw")

    @cached_property
    def api_raw(self) -> DataFrame:
        return self._source("api_raw")

    @cached_property
    def staging_clean(self) -> DataFrame:
        return self._tap("staging_clean", clean_staging(self.staging_raw, self.cfg))

    @cached_property
    def consolidated(self) -> DataFrame:
        return self._tap("consolidated", consolidate(self.staging_clean))

    @cached_property
    def restrictions(self) -> DataFrame:
        return self._tap("restrictions", clean_restrictions(self.restrictions_raw, self.cfg))

    @cached_property
    def api(self) -> DataFrame:
        return self._tap("api", clean_api(self.api_raw))

    @cached_property
    def integrated(self) -> DataFrame:
        return self._tap("integrated", integrate(self.consolidated, self.api, self.restrictions))

    @cached_property
    def ruled(self) -> DataFrame:
        return self._tap("ruled", apply_rules(self.integrated, self.cfg))

    @cached_property
    def final(self) -> DataFrame:
        return self._tap("final", final_projection(self.ruled, self.run_ts))


# Stages whose row counts a run reports (name in the frames -> reported name).
COUNTED_STAGES = {
    "staging_raw": "staging", "restrictions_raw": "restricciones", "api_raw": "api",
    "staging_clean": "staging_limpio", "consolidated": "consolidado",
    "restrictions": "restricciones_limpio", "api": "api_limpio",
    "integrated": "integrado", "ruled": "final",
}


class StageCounter:
    """Row counts of every ETL stage, observed while the run executes: for monitoring.

    Each counted stage carries a ``Dataset.observe`` count, so the numbers come
    out of the one job that runs the ETL. They are approximate: where a lost
    executor makes tasks run again, their rows count again. Exact counts are
    ``source_counts``. Use a child session (``spark.newSession()``): in Spark
    4.1 a session that has served an ``Observation`` can't be serialized, which
    breaks models that hold a training summary.
    """

    def __init__(self):
        self._obs: dict[str, Observation] = {}

    def tap(self, name: str, df: DataFrame) -> DataFrame:
        if name not in COUNTED_STAGES:
            return df
        obs = self._obs[name] = Observation(f"filas_{name}")
        return df.observe(obs, F.count(F.lit(1)).alias("filas"))

    def counts(self) -> list[tuple[str, int]]:
        """(stage, rows) in pipeline order; call after the run's action."""
        return [(label, int(self._obs[name].get["filas"]))
                for name, label in COUNTED_STAGES.items() if name in self._obs]


def build_etl(staging_raw: DataFrame | Callable[[], DataFrame],
              restrictions_raw: DataFrame | Callable[[], DataFrame],
              api_raw: DataFrame | Callable[[], DataFrame],
              cfg: CatalogConfig = DEFAULT_CONFIG, run_ts: dt.datetime | None = None,
              tap: Callable[[str, DataFrame], DataFrame] | None = None) -> EtlFrames:
    """The ETL over three sources (frames, or zero-argument builders of them).

    ``tap(stage, df)`` may wrap each stage as it is built (see ``StageCounter``).
    """
    return EtlFrames(staging_raw, restrictions_raw, api_raw, cfg, run_ts, tap)


# Fixed run timestamp for reproducible query results (the live load uses now()).
FIXED_RUN_TS = dt.datetime(2026, 1, 1, 0, 0, 0)


def etl_from_fixtures(fx: Fixtures, cfg: CatalogConfig = DEFAULT_CONFIG,
                      run_ts: dt.datetime | None = FIXED_RUN_TS,
                      tap: Callable[[str, DataFrame], DataFrame] | None = None) -> EtlFrames:
    return build_etl(lambda: fx.staging, lambda: fx.restrictions, lambda: fx.api, cfg, run_ts, tap)


def run_etl(staging_raw: DataFrame, restrictions_raw: DataFrame, api_raw: DataFrame,
            target: str | None = None, load: bool = True, cfg: CatalogConfig = DEFAULT_CONFIG,
            run_ts: dt.datetime | None = None,
            counter: StageCounter | None = None) -> DataFrame | str:
    """Run the whole ETL; raise on any failure (no silent ``None``).

    With ``load`` the ETL runs once into a candidate, the constraints are
    checked on it, a new version is written under ``target``, verified and
    published, and its path is returned. Without it (dry run) the validated
    final frame is returned and nothing is written. A ``counter`` collects the
    per-stage row counts of the run.
    """
    from marquee.sinks.curated import load_curated, validate_before_load

    frames = build_etl(staging_raw, restrictions_raw, api_raw, cfg, run_ts,
                       counter.tap if counter else None)
    if not load:
        validate_before_load(frames.ruled)
        return frames.final
    if not target:
        raise ValueError("target path required when load=True")
    return load_curated(frames.ruled, target, run_ts)
