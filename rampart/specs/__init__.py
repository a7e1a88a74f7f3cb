"""Declarative parser specs.

A spec names a log source, says how its lines are cut into tokens and which token
feeds which canonical field.  Specs live on the driver only; the operators turn
them into Column expressions once per query.
"""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from rampart.specs.patterns import JavaPattern, to_java
from rampart.specs.shipped import DEFAULT_KEYS, FALLBACK, SHIPPED


@dataclass(frozen=True)
class ParserSpec:
    id: str
    name: str = "Unknown Parser"
    vendor: str = FALLBACK["vendor"]
    product: str = FALLBACK["product"]
    version: str = FALLBACK["version"]
    format: str = FALLBACK["format"]
    pattern: JavaPattern | None = None
    columns: tuple[str, ...] = ()
    delimiter: str = ","
    mapping: Mapping[str, Any] = field(default_factory=dict)
    value_maps: Mapping[str, Mapping[Any, Any]] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> ParserSpec:
        """Build from the keys used in spec files; raises on a bad pattern."""
        options = config.get("parser_config") or {}
        texts = {
            key: str(config[key])
            for key in ("name", "vendor", "product", "version", "format")
            if config.get(key) is not None
        }
        pattern = None
        if texts.get("format") == "regex" and "pattern" in options:
            pattern = to_java(options["pattern"])
        return cls(
            id=str(config["id"]),
            pattern=pattern,
            columns=tuple(options.get("columns") or ()),
            delimiter=options.get("delimiter", ","),
            mapping=config.get("mapping") or {},
            value_maps=config.get("value_maps") or {},
            **texts,
        )

    def source_keys(self, canonical: str) -> tuple[list[str], bool]:
        """Keys feeding one canonical field, and whether it is a single-key rule.

        A single-key rule uses up its key even when the value is missing; a list
        moves on to the next key.
        """
        rule = self.mapping.get(canonical, DEFAULT_KEYS[canonical])
        if isinstance(rule, str):
            return [rule], True
        if isinstance(rule, (list, tuple)):
            return [str(key) for key in rule], False
        return [], False


class SpecSet:
    """Specs by id; a later spec with the same id replaces the earlier one."""

    def __init__(self, specs: Iterable[ParserSpec | Mapping[str, Any]] = ()):
        self._by_id: dict[str, ParserSpec] = {}
        for spec in specs:
            self.register(spec)

    def __iter__(self) -> Iterator[ParserSpec]:
        return iter(self._by_id.values())

    def __len__(self) -> int:
        return len(self._by_id)

    def __contains__(self, parser_id: object) -> bool:
        return parser_id in self._by_id

    def get(self, parser_id: str) -> ParserSpec | None:
        return self._by_id.get(parser_id)

    def register(self, spec: ParserSpec | Mapping[str, Any]) -> SpecSet:
        """Add or replace one spec."""
        if not isinstance(spec, ParserSpec):
            spec = ParserSpec.from_dict(spec)
        self._by_id[spec.id] = spec
        return self

    def load(self, directory: str) -> SpecSet:
        """Add every spec file (YAML or JSON) of a directory.

        Specs already known but no longer on disk stay; unreadable files are
        reported and skipped.
        """
        files = [p for p in sorted(Path(directory).iterdir()) if re.search(r"\.(y.*ml|json)$", p.name)]
        for file in files:
            try:
                config = _read_config(file)
                if isinstance(config, Mapping) and "id" in config:
                    self.register(config)
            except Exception as problem:  # noqa: BLE001 - one bad file must not stop the rest
                warnings.warn(f"parser spec {file} skipped: {problem}", stacklevel=2)
        return self

    def ids(self, *formats: str) -> list[str]:
        return [s.id for s in self if not formats or s.format in formats]


def _read_config(file: Path) -> Any:
    text = file.read_text(encoding="utf-8")
    if file.suffix == ".json":
        return json.loads(text)
    import yaml  # optional: only YAML specs need it

    return yaml.safe_load(text)


def shipped_specs() -> SpecSet:
    """A fresh set holding the supported log sources."""
    return SpecSet(SHIPPED)


def parser_catalog(spark: SparkSession, specs: SpecSet | None = None) -> DataFrame:
    """The known parsers as a table."""
    rows = [
        (s.id, s.name, s.vendor, s.product, s.format, s.version)
        for s in (shipped_specs() if specs is None else specs)
    ]
    return spark.createDataFrame(
        rows, "id string, name string, vendor string, product string, format string, version string"
    )


__all__ = ["ParserSpec", "SpecSet", "shipped_specs", "parser_catalog", "DEFAULT_KEYS", "FALLBACK"]
