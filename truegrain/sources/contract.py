"""Data contracts: columns, freshness and quality thresholds of a table.

A contract is a short document read on the driver before any job starts.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T

# What a contract must hold.
REQUIRED_KEYS = ("name", "version", "owner", "schema", "sla", "quality")

# The column types a contract may name.
TYPES: Mapping[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: bool


@dataclass(frozen=True)
class Contract:
    name: str
    version: str
    owner: str
    columns: Sequence[ContractColumn]
    freshness_hours: float
    delivery_time: str
    timezone: str
    completeness_threshold: float
    accuracy_threshold: float
    uniqueness_columns: Sequence[str]
    breaking_change: bool = False
    previous_version: str = ""

    def required_columns(self) -> list[str]:
        return [c.name for c in self.columns]

    def non_nullable_columns(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def quality_thresholds(self) -> dict:
        return {
            "completeness_threshold": self.completeness_threshold,
            "accuracy_threshold": self.accuracy_threshold,
            "uniqueness_columns": list(self.uniqueness_columns),
        }

    def struct_type(self) -> T.StructType:
        """The contract's columns as a Spark schema."""
        return T.StructType([T.StructField(c.name, TYPES[c.type], c.nullable) for c in self.columns])

    def breaking_change_notice(self) -> str | None:
        """A warning to show before the run, or None."""
        if not self.breaking_change:
            return None
        return (
            f"WARNING: BREAKING CHANGE DETECTED in {self.name}: "
            f"{self.previous_version} -> {self.version}; review downstream systems"
        )


def contract_from_dict(raw: Mapping) -> Contract:
    """Check and build a contract from the document's ``contract`` section."""
    absent = [key for key in REQUIRED_KEYS if key not in raw]
    if absent:
        raise ValueError(f"contract lacks required keys: {', '.join(absent)}")
    for spec in raw["schema"]:
        if spec["type"] not in TYPES:
            raise ValueError(
                f"column {spec['name']!r} has type {spec['type']!r}; use one of {', '.join(TYPES)}"
            )
    return Contract(
        name=raw["name"],
        version=str(raw["version"]),
        owner=raw["owner"],
        columns=[ContractColumn(s["name"], s["type"], bool(s["nullable"])) for s in raw["schema"]],
        freshness_hours=raw["sla"]["freshness_hours"],
        delivery_time=raw["sla"]["delivery_time"],
        timezone=raw["sla"]["timezone"],
        completeness_threshold=raw["quality"]["completeness_threshold"],
        accuracy_threshold=raw["quality"]["accuracy_threshold"],
        uniqueness_columns=list(raw["quality"]["uniqueness_columns"]),
        breaking_change=bool(raw.get("breaking_change", False)),
        previous_version=str(raw.get("previous_version", "")),
    )


def load_contract(path: str) -> Contract:
    """Read a JSON or YAML document; YAML needs the optional ``yaml`` package."""
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"contract file not found: {path}")
    text = file.read_text(encoding="utf-8")
    if file.suffix == ".json":
        document = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as absent:
            raise ImportError("reading a YAML contract needs the yaml package; JSON works without") from absent
        document = yaml.safe_load(text)
    return contract_from_dict((document or {}).get("contract", {}))
