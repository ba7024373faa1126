"""Routing dictionaries: TOML files read on the driver, patterns used as literals."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CONFIG_DIR = Path(__file__).resolve().parent.parent / "config"
ROUTE_FILES = {"char": "characterization.toml", "prop": "property.toml", "proc": "process.toml"}


@dataclass(frozen=True)
class RouteConfig:
    route: str
    titles: dict[str, tuple[str, ...]]
    keywords: dict[str, tuple[str, ...]]
    exclude: tuple[str, ...] = ()
    comparative: tuple[str, ...] = ()
    segment_patterns: dict[str, tuple[str, ...]] | None = None
    segment_phrases: dict[str, tuple[str, ...]] | None = None
    preferences: dict[str, tuple[str, ...]] | None = None

    @property
    def labels(self) -> list[str]:
        return list(self.keywords)


@lru_cache(maxsize=None)
def route_config(route: str, path: str | None = None) -> RouteConfig:
    """Settings of one route, from the packaged file or from ``path``."""
    raw = tomllib.loads(Path(path or CONFIG_DIR / ROUTE_FILES[route]).read_text(encoding="utf-8"))

    def lists(section: str, change=str) -> dict[str, tuple[str, ...]]:
        return {k: tuple(change(str(v)) for v in vs) for k, vs in raw.get(section, {}).items()}

    return RouteConfig(
        route=route,
        titles=lists("section_titles", str.upper),
        keywords=lists("keywords"),
        exclude=tuple(p for ps in lists("exclude_keywords").values() for p in ps),
        comparative=lists("comparative_patterns").get("side_mention", ()),
        segment_patterns=lists("segment_title_patterns"),
        segment_phrases=lists("segment_title_contains", lambda s: s.lower().strip()),
        preferences=lists("form_group_property_preferences") or lists("form_group_upstream_preferences"),
    )


def load_routing_config(spark: SparkSession, route: str, path: str | None = None) -> DataFrame:
    """The dictionary as a table (route, section, label, ord, pattern)."""
    config = route_config(route, path)
    groups: list[tuple[str, dict[str, tuple[str, ...]]]] = [
        ("title", config.titles),
        ("keyword", config.keywords),
        ("exclude", {"exclude": config.exclude}),
        ("comparative", {"side_mention": config.comparative}),
        ("segment_pattern", config.segment_patterns or {}),
        ("segment_phrase", config.segment_phrases or {}),
        ("preference", config.preferences or {}),
    ]
    rows = [
        (route, section, label, i, pattern)
        for section, entries in groups
        for label, patterns in entries.items()
        for i, pattern in enumerate(patterns)
    ]
    return spark.createDataFrame(rows, "route string, section string, label string, ord int, pattern string")
