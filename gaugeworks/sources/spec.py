"""Description of a source: where it is, how it is read and which rules hold.

A new source is a new :class:`SourceSpec`; no code changes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from gaugeworks.functions.text import NULL_TOKENS
from gaugeworks.schemas import SOURCE_COLUMNS

# Rules that hold when a source names none.
REQUIRED = ["unique_id", "indicator_id", "name", "geo_type_name", "geo_place_name", "start_date"]
REQUIRED_INTEGERS = ["unique_id", "indicator_id"]
OPTIONAL_INTEGERS = ["geo_join_id"]
NUMERIC = ["data_value"]
DATES = ["start_date"]
DEDUP_KEYS = ["unique_id", "indicator_id", "start_date", "geo_place_name"]


@dataclass(frozen=True)
class RuleSet:
    """Validation rules. An empty list means the default list."""

    required: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)
    required_integers: list[str] = field(default_factory=lambda: list(REQUIRED_INTEGERS))
    optional_integers: list[str] = field(default_factory=lambda: list(OPTIONAL_INTEGERS))
    lenient_int: bool = False

    def __post_init__(self) -> None:
        for name, default in (("required", REQUIRED), ("numeric", NUMERIC), ("dates", DATES)):
            object.__setattr__(self, name, list(getattr(self, name) or default))

    @property
    def integers(self) -> list[str]:
        return [*self.required_integers, *self.optional_integers]


@dataclass(frozen=True)
class SourceSpec:
    """One file source.

    ``path`` may be a file, a folder or a glob. ``mapping`` is source column (after
    header normalization) to target column. ``multiline`` lets quoted fields hold
    line breaks, at the price of files that cannot be split; ``quoted_breaks`` lets them
    in splittable CSV files in UTF-8 with RFC 4180 quotes (:mod:`gaugeworks.sources.records`).
    """

    path: str
    name: str = "source"
    format: str = "csv"
    delimiter: str = ","
    encoding: str = "utf-8"
    has_header: bool = True
    multiline: bool = False
    quoted_breaks: bool = False
    mapping: Mapping[str, str] = field(default_factory=lambda: {c: c for c in SOURCE_COLUMNS})
    null_tokens: list[str] | None = None
    rules: RuleSet = field(default_factory=RuleSet)
    dedup_keys: list[str] = field(default_factory=lambda: list(DEDUP_KEYS))

    def __post_init__(self) -> None:
        if self.format not in ("csv", "json"):
            raise ValueError(f"unknown source format: {self.format}")
        if self.null_tokens is None:
            object.__setattr__(self, "null_tokens", list(NULL_TOKENS) if self.format == "csv" else [])

    @property
    def key(self) -> str:
        """Name of the source that differs between paths, also where names are equal."""
        return f"{re.sub(r'[^A-Za-z0-9._-]', '_', self.name)}-{hashlib.sha256(self.path.encode()).hexdigest()[:12]}"

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> SourceSpec:
        """Spec from a parsed configuration with the sections ``data_source``,
        ``schema_mapping``, ``validation`` and ``deduplication``."""
        source = config["data_source"]
        checks = config.get("validation", {})
        dedup = config.get("deduplication", {})
        options = {key: source[key] for key in ("format", "delimiter", "encoding", "has_header") if key in source}
        if config.get("schema_mapping"):
            options["mapping"] = dict(config["schema_mapping"])
        if not dedup.get("enabled", True):
            options["dedup_keys"] = []
        elif dedup.get("keys"):
            options["dedup_keys"] = list(dedup["keys"])
        return cls(
            path=source["path"],
            name=config.get("app", {}).get("name", "source"),
            rules=RuleSet(
                required=checks.get("required_fields") or [],
                numeric=checks.get("numeric_fields") or [],
                dates=checks.get("date_fields") or [],
            ),
            **options,
        )
