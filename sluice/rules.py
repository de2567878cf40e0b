"""Declarative per-column rules (H1).

A rule set is an ordered list of :class:`ColumnRule`; the order is the
output column order of every validated frame. Rule sets load from the
JSON shape ``{"COLUMN": {"required": true, "regex": "...", ...}, ...}``
(key order kept) or are built in Python. Loading is driver-side metadata
only: no rows are touched.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Rule keys that change behaviour. Anything else (role, description, type
# values other than date/timestamp) is carried along as metadata.
_KNOWN_KEYS = {
    "required",
    "regex",
    "allowed_values",
    "type",
    "date_format",
    "timestamp_format",
    "cast_to",
    "aliases",
    "description",
    "role",
}


@dataclass(frozen=True)
class ColumnRule:
    name: str
    required: bool = False
    regex: str | None = None
    allowed_values: tuple[Any, ...] | None = None
    type: str | None = None
    date_format: str | None = None
    timestamp_format: str | None = None
    cast_to: str | None = None
    aliases: tuple[str, ...] = ()
    description: str | None = None
    role: str | None = None
    extra: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, name: str, spec: Mapping[str, Any]) -> "ColumnRule":
        if not isinstance(spec, Mapping):
            raise ValueError(f"rule for column {name!r} must be an object, got {type(spec).__name__}")
        allowed = spec.get("allowed_values")
        return cls(
            name=name,
            required=bool(spec.get("required", False)),
            regex=spec.get("regex"),
            allowed_values=None if allowed is None else tuple(allowed),
            type=spec.get("type"),
            date_format=spec.get("date_format"),
            timestamp_format=spec.get("timestamp_format"),
            cast_to=spec.get("cast_to"),
            aliases=tuple(spec.get("aliases", ())),
            description=spec.get("description"),
            role=spec.get("role"),
            extra={k: v for k, v in spec.items() if k not in _KNOWN_KEYS},
        )

    @property
    def checks_date(self) -> bool:
        return self.type == "date" and self.date_format is not None

    @property
    def checks_timestamp(self) -> bool:
        return self.type == "timestamp" and self.timestamp_format is not None

    @property
    def has_checks(self) -> bool:
        return (
            self.required
            or self.regex is not None
            or self.allowed_values is not None
            or self.checks_date
            or self.checks_timestamp
        )


@dataclass(frozen=True)
class TableRules:
    name: str
    columns: tuple[ColumnRule, ...]

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate column in rule set {self.name!r}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def __iter__(self):
        return iter(self.columns)

    def __len__(self) -> int:
        return len(self.columns)

    def __getitem__(self, name: str) -> ColumnRule:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def with_aliases(self, aliases: Mapping[str, Iterable[str]]) -> "TableRules":
        """Attach header variants, e.g. ``{"CONTRACT_ID": ["CONTRAT_ID"]}``."""
        cols = []
        for c in self.columns:
            extra = tuple(a for a in aliases.get(c.name, ()) if a not in c.aliases)
            cols.append(replace(c, aliases=c.aliases + extra))
        return TableRules(self.name, tuple(cols))

    @classmethod
    def from_dict(cls, name: str, spec: Mapping[str, Any]) -> "TableRules":
        if not spec:
            raise ValueError(f"empty rule set: {name}")
        return cls(name, tuple(ColumnRule.from_dict(k, v) for k, v in spec.items()))

    @classmethod
    def from_json(cls, source: str | Path | Mapping[str, Any], name: str | None = None) -> "TableRules":
        """Load from a JSON file path, a URI of storage that Spark reads, a JSON
        string, or an already parsed dict.

        Missing file -> FileNotFoundError; empty or malformed JSON -> ValueError.
        """
        if isinstance(source, Mapping):
            return cls.from_dict(name or "rules", source)
        text: str
        path = Path(source) if not str(source).lstrip().startswith("{") else None
        if path is not None and re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", str(source)):
            text = _read_uri(str(source))
            if name is None:
                name = path.stem.removesuffix("_validation")
        elif path is not None:
            if not path.exists():
                raise FileNotFoundError(f"rule file not found: {path}")
            text = path.read_text(encoding="utf-8")
            if name is None:
                name = path.stem.removesuffix("_validation")
        else:
            text = str(source)
        if not text.strip():
            raise ValueError(f"empty rule file: {source}")
        try:
            spec = json.loads(text)
        except json.JSONDecodeError as e:
            raise ValueError(f"malformed JSON in rule file {source}: {e}") from e
        if not isinstance(spec, dict):
            raise ValueError("rule file must hold a JSON object of column -> rule")
        return cls.from_dict(name or "rules", spec)


def _read_uri(uri: str) -> str:
    """A small text file by its URI, through Spark's own file systems."""
    spark = SparkSession.builder.getOrCreate()
    try:
        rows = spark.read.text(uri, wholetext=True).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raise FileNotFoundError(f"rule file not found: {uri}") from e
    return rows[0].value if rows else ""
