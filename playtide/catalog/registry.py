"""The registry itself, and the frames the queries start from."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.catalog.sql import with_base
from playtide.operators import alerts, rollups, sessions
from playtide.operators.ingest import only_version
from playtide.plans import player
from playtide.session import configure
from playtide.sources import star_tables

# The sample users act a few times a day, so the stateful rules also run with a wider setting that finds more.
WIDE_GAP_MS = 6 * 3_600_000
WIDE_WINDOW_MS = 86_400_000
WIDE_COUNT = 3


class Tables:
    """Lazy frames over one sample folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    @cached_property
    def raw(self) -> DataFrame:
        return star_tables.raw_events(self.spark, self.folder)

    @cached_property
    def events(self) -> DataFrame:
        return star_tables.game_events(self.raw)

    @cached_property
    def current(self) -> DataFrame:
        return only_version(self.events)

    @cached_property
    def legacy(self) -> DataFrame:
        return star_tables.legacy_events(self.raw)

    @cached_property
    def redelivered(self) -> DataFrame:
        return star_tables.redelivered(self.current)

    @cached_property
    def daily(self) -> DataFrame:
        return rollups.daily_user_summary(self.current)

    @cached_property
    def stage_parts(self) -> DataFrame:
        return rollups.stage_difficulty(self.current)

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions.session_summary(self.current, WIDE_GAP_MS)

    @cached_property
    def alerts(self) -> DataFrame:
        return alerts.detect_anomalies(self.current, window_ms=WIDE_WINDOW_MS, threshold=WIDE_COUNT)

    @cached_property
    def leaderboard(self) -> DataFrame:
        return star_tables.leaderboard(self.events)

    @cached_property
    def users(self) -> DataFrame:
        return star_tables.users(self.spark, self.folder)

    @cached_property
    def rounds(self) -> DataFrame:
        return player.round_summary(self.events)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _portable(df: DataFrame) -> DataFrame:
    """Days and times as text, so every engine prints them alike."""
    formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss"}
    columns = {f.name: formats[f.dataType.simpleString()] for f in df.schema.fields if f.dataType.simpleString() in formats}
    return df.withColumns({name: F.date_format(name, pattern) for name, pattern in columns.items()}) if columns else df


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``oracle`` is the SQL after the shared WITH clause."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, folder: _portable(fn(Tables(spark, folder)))
        if oracle is not None:
            _ORACLES[name] = with_base(oracle)
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
